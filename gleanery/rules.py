"""Scoring rules: which annotation columns count, how labels become numbers,
and how the numbers fold to one score per id.

Rules live on the driver. They are turned into Catalyst expressions by
:mod:`gleanery.functions.scores`; nothing here touches data.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

# Different scores that are listed to bound their number.
FOLDED = 1 << 18
AGGREGATIONS = ("weighted_mean", "weighted_sum", "min", "product")

RULES_SCHEMA = (
    "property string, label string, score double, weight double, default_score double"
)

# The two bundled rule sets, as
# property -> (weight, default score, {label: score}).
_QUALITY = {"excellent": 1.0, "good": 0.75, "adequate": 0.4, "poor": 0.1, "unacceptable": 0.0}
_BUNDLED = {
    "default": {
        "content_quality": (1.0, 0.0, _QUALITY),
    },
    "all_properties": {
        "content_quality": (3.0, 0.5, _QUALITY),
        "content_safety": (5.0, 0.5, {
            "safe": 1.0, "mild_concerns": 0.5, "nsfw": 0.0, "harmful": 0.0, "illegal": 0.0}),
        "educational_value": (2.0, 0.5, {
            "high": 1.0, "moderate": 0.7, "basic": 0.4, "minimal": 0.15, "none": 0.0}),
        "reasoning_indicators": (1.5, 0.5, {
            "analytical": 1.0, "explanatory": 0.7, "basic_reasoning": 0.4, "minimal": 0.15, "none": 0.0}),
        "content_integrity": (2.0, 0.5, {
            "complete": 1.0, "mostly_complete": 0.7, "fragment": 0.2, "severely_degraded": 0.0}),
        "information_density": (1.0, 0.5, {
            "dense": 1.0, "adequate": 0.7, "moderate": 0.4, "thin": 0.15, "empty": 0.0}),
        "commercial_bias": (1.5, 0.5, {
            "none": 1.0, "minimal": 0.8, "moderate": 0.4, "heavy": 0.1, "pure_marketing": 0.0}),
    },
}


def _require_finite(value, what: str) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
        raise ValueError(f"{what} must be a finite number, got {value!r}")


@dataclass(frozen=True)
class ColumnScoring:
    """Rule for one annotation column. A label that is not listed, a NULL, or a
    label mapped to ``None`` gets ``default_score``."""

    category_scores: Mapping
    weight: float = 1.0
    default_score: float = 0.5

    def __post_init__(self):
        _require_finite(self.weight, "weight")
        _require_finite(self.default_score, "default_score")
        for label, score in self.category_scores.items():
            if score is not None:
                _require_finite(score, f"score of label {label!r}")


@dataclass(frozen=True)
class ScoringConfig:
    """A complete rule set. Column order is the order of the fold."""

    columns: Mapping[str, ColumnScoring]
    aggregation: str = "weighted_mean"
    missing_id_score: float = 0.0
    normalize: bool = True

    def __post_init__(self):
        if self.aggregation not in AGGREGATIONS:
            raise ValueError(
                f"Unknown aggregation: {self.aggregation} (one of {', '.join(AGGREGATIONS)})"
            )
        _require_finite(self.missing_id_score, "missing_id_score")

    @classmethod
    def from_dict(cls, raw: Mapping) -> ScoringConfig:
        """Build from the plain mapping a YAML file holds; absent keys take the
        dataclass defaults."""
        columns = {
            name: ColumnScoring(**{
                key: rule[key]
                for key in ("category_scores", "weight", "default_score")
                if key in rule
            })
            for name, rule in (raw.get("columns") or {}).items()
        }
        options = {
            key: raw[key]
            for key in ("aggregation", "missing_id_score", "normalize")
            if key in raw
        }
        return cls(columns=columns, **options)

    @classmethod
    def from_file(cls, path: str | Path) -> ScoringConfig:
        return cls.from_dict(yaml.safe_load(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def from_name(cls, name: str) -> ScoringConfig:
        if name not in _BUNDLED:
            raise FileNotFoundError(
                f"No bundled config named '{name}'. Available: {sorted(_BUNDLED)}"
            )
        return cls(columns={
            prop: ColumnScoring(labels, weight, default)
            for prop, (weight, default, labels) in _BUNDLED[name].items()
        })

    @classmethod
    def resolve(cls, spec: str | None) -> ScoringConfig:
        """``None`` -> the default rules, an existing file -> that file, anything
        else -> a bundled name."""
        if spec is None:
            return DEFAULT_SCORING_CONFIG
        return cls.from_file(spec) if Path(spec).is_file() else cls.from_name(spec)

    def score_combinations(self, present: Collection[str] | None = None) -> int:
        """Upper bound on the number of different scores these rules can give over the
        ``present`` columns (all if None). Folded values that are equal count once, as long
        as there are at most FOLDED of them; further columns multiply."""
        values: set[float] = set()
        combinations = 1
        for name, rule in self.columns.items():
            if present is not None and name not in present:
                continue
            own = {float(s) for s in rule.category_scores.values() if s is not None} | {float(rule.default_score)}
            if combinations > FOLDED:
                combinations *= len(own)
                continue
            values = self._folded(values or {None}, own, float(rule.weight))
            combinations = len(values)
        return combinations + 1  # the missing-id score

    def _folded(self, values: set, own: set[float], weight: float) -> set[float]:
        """All results of one more step of the fold, in its own arithmetic."""
        if self.aggregation == "min":
            return {b if a is None else min(a, b) for a in values for b in own}
        if self.aggregation == "product":
            return {b if a is None else a * b for a in values for b in own}
        return {b * weight if a is None else a + b * weight for a in values for b in own}


DEFAULT_SCORING_CONFIG = ScoringConfig.from_name("default")


def rules_frame(spark: SparkSession, config: ScoringConfig) -> DataFrame:
    """The rules as a small dimension table, for joins and audits."""
    rows = [
        (prop, str(label), None if score is None else float(score),
         float(rule.weight), float(rule.default_score))
        for prop, rule in config.columns.items()
        for label, score in rule.category_scores.items()
    ]
    return spark.createDataFrame(rows, RULES_SCHEMA)
