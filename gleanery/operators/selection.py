"""Selection modes over ``(source_pos, score)``."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.draws import draw_with_replacement
from gleanery.operators.race import race_draw
from gleanery.operators.stats import Profile, weight_column

log = logging.getLogger(__name__)

THRESHOLD = "threshold"
WITHOUT_REPLACEMENT = "sample_without_replacement"
WITH_REPLACEMENT = "sample_with_replacement"
# Copies of one row beyond which its draws are spread over several tasks.
HOT_DRAWS = 1_000_000
MODES = (THRESHOLD, WITHOUT_REPLACEMENT, WITH_REPLACEMENT)


@dataclass(frozen=True)
class Selection:
    """Chosen positions. ``rows`` has ``(source_pos, score)`` and, in the sampling
    modes, ``draw_pos``; a threshold selection is in source order by nature.
    ``size`` is None while unknown. ``hot`` lists positions with very many draws."""

    rows: DataFrame
    size: int | None
    may_repeat: bool
    has_draw_order: bool
    hot: tuple[int, ...] = ()


def check_arguments(mode: str, n_samples: int | None, max_duplications: int | None) -> None:
    if mode not in MODES:
        raise ValueError(f"Unknown mode: {mode} (one of {', '.join(MODES)})")
    if max_duplications is not None:
        if mode != WITH_REPLACEMENT:
            raise ValueError(
                f"max_duplications is only valid with mode='{WITH_REPLACEMENT}', got mode='{mode}'"
            )
        if max_duplications < 1:
            raise ValueError("max_duplications must be >= 1")
    if n_samples is not None and n_samples < 0:
        raise ValueError(f"n_samples must not be negative, got {n_samples}")


def select_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows with ``score >= threshold``; a NaN score never passes."""
    score = F.col("score")
    return scored.where((score >= F.lit(float(threshold))) & ~F.isnan(score)).select("source_pos", "score")


def _nothing(scored: DataFrame) -> DataFrame:
    return scored.select("source_pos", F.lit(0).cast("bigint").alias("draw_pos"), "score").limit(0)


def hot_positions(scored: DataFrame, n: int, found: Profile, draws: int = HOT_DRAWS) -> tuple[int, ...]:
    """Rows with more than ``draws`` expected draws: at most ``n / draws`` of them."""
    many = weight_column() > F.lit(found.weight_sum * draws / n)
    return tuple(row["source_pos"] for row in scored.where(many).select("source_pos").collect())


def select_sample(
    scored: DataFrame, mode: str, n: int, seed: int, found: Profile,
    max_duplications: int | None = None, holding: list | None = None, hot_draws: int = HOT_DRAWS,
) -> Selection:
    """Weighted sample of ``n`` rows, fewer when the eligible rows run out."""
    if found.eligible == 0:
        raise ValueError(
            "All scores are zero: there is nothing to sample. Adjust the scoring rules."
        )
    cap = 1 if mode == WITHOUT_REPLACEMENT else max_duplications
    if cap is not None and n > cap * found.eligible:
        log.warning(
            "n_samples %d lowered to %d: %d rows score above zero, each drawn at most %d times",
            n, cap * found.eligible, found.eligible, cap,
        )
        n = cap * found.eligible
    if n == 0:
        drawn = _nothing(scored)
    elif cap is None:
        drawn = draw_with_replacement(scored, n, seed, found)
    else:
        drawn = race_draw(scored, n, seed, cap, found, mode == WITH_REPLACEMENT, holding)
    hot = hot_positions(scored, n, found, hot_draws) if n and (cap or n) > hot_draws else ()
    return Selection(drawn, n, may_repeat=cap != 1, has_draw_order=True, hot=hot)


def select_rows(
    scored: DataFrame, mode: str, found: Profile, *, threshold: float = 0.5,
    n_samples: int | None = None, seed: int = 42, max_duplications: int | None = None,
    holding: list | None = None,
) -> Selection:
    """Dispatch on ``mode``; ``n_samples`` defaults to the dataset size."""
    check_arguments(mode, n_samples, max_duplications)
    if mode == THRESHOLD:
        return Selection(select_threshold(scored, threshold), None, may_repeat=False, has_draw_order=False)
    if found.rows == 0:
        return Selection(_nothing(scored), 0, may_repeat=False, has_draw_order=True)
    n = found.rows if n_samples is None else n_samples
    return select_sample(scored, mode, n, seed, found, max_duplications, holding)
