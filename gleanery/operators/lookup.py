"""Scores per id, and their lookup for every dataset row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.scores import composite_score
from gleanery.rules import ScoringConfig

# Ids held by more than this share of the rows are joined apart from the others.
HOT_SHARE = 0.002
_HOT_SAMPLE_ROWS = 1_000_000


def raw_scores(
    annotations: DataFrame, config: ScoringConfig, id_col: str = "id", order_col: str | None = None
) -> DataFrame:
    """``(id, score[, order])`` per annotation row, before normalisation."""
    order = [F.col(order_col)] if order_col else []
    ready, score = composite_score(annotations, config)
    return ready.select(F.col(id_col).alias("id"), score.alias("score"), *order)


def rescaled(lo: Column, hi: Column) -> Column:
    """Min-max normalisation of ``score``. Constant scores stay raw: a zero span makes
    the quotient NULL."""
    return F.coalesce((F.col("score") - lo) / F.nullif(hi - lo, F.lit(0.0)), F.col("score"))


def compute_scores(
    annotations: DataFrame, config: ScoringConfig, id_col: str = "id", order_col: str | None = None
) -> DataFrame:
    """``(id, score[, order])`` per annotation row. Min-max normalisation uses the
    bounds over all rows through a scalar subquery: lazy, and no join."""
    raw = raw_scores(annotations, config, id_col, order_col)
    if not config.normalize:
        return raw
    bounds = raw.agg(
        F.struct(F.min("score").alias("lo"), F.max("score").alias("hi")).alias("bounds")
    ).scalar()
    return raw.withColumn("score", rescaled(bounds.getField("lo"), bounds.getField("hi")))


def with_bounds(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``raw`` scores, whose extremes the first action over them reports on the way: no
    second scan. A task that runs twice reports the same, which extremes do not mind."""
    seen = Observation()
    return raw.observe(seen, F.min("score").alias("lo"), F.max("score").alias("hi")), seen


def latest_scores(scores: DataFrame, order_col: str | None = None) -> DataFrame:
    """One score per id: the last row in ``order_col`` wins. Without an order the
    largest score is taken, so that the lookup never fans out. The aggregation
    combines map-side, so a heavily repeated id costs no extra shuffle."""
    # in a struct a NULL order is the lowest, not absent
    best = F.max_by("score", F.struct(order_col)) if order_col else F.max("score")
    return scores.groupBy("id").agg(best.alias("score"))


def hot_ids(rows: DataFrame, total: int) -> list:
    """Non-NULL ids that hold more than ``HOT_SHARE`` of the rows, judged on a
    sample; ``total`` must be the number of ``rows`` themselves. The list only steers the
    plan, never the result. It has at most ``1 / HOT_SHARE`` entries; no more ids can
    hold such a share."""
    fraction = min(1.0, _HOT_SAMPLE_ROWS / max(total, 1))
    sample = rows.select("id").where("id IS NOT NULL").sample(fraction=fraction, seed=0)
    share = F.lit(HOT_SHARE * total * fraction)
    hot = sample.groupBy("id").count().where(F.col("count") > share)
    return [row["id"] for row in hot.orderBy(F.desc("count")).limit(int(1 / HOT_SHARE)).collect()]


def attach_scores(
    rows: DataFrame, scores: DataFrame, missing: float, skewed: Sequence | None = None
) -> DataFrame:
    """Left lookup on ``id``. Adds ``score`` (``missing`` when unmatched, applied
    after normalisation) and ``matched``. ``scores`` has unique ids and no NULL score.

    ``skewed=None`` is one plain join: Catalyst and AQE choose broadcast or
    sort-merge. With a list, rows under those ids and rows with a NULL id stay
    out of the id shuffle: they look up the at most ``len(skewed)`` scores of these
    ids by broadcast.
    """
    left, right = rows.schema["id"].dataType, scores.schema["id"].dataType
    if left != right:
        if not (isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType)):
            raise TypeError(
                "Dataset and annotation ids have different types: "
                f"{left.simpleString()} and {right.simpleString()}"
            )
        rows = rows.withColumn("id", F.col("id").cast("bigint"))
        scores = scores.withColumn("id", F.col("id").cast("bigint"))
    scores = scores.withColumn("_found", F.lit(True))
    if skewed is None:
        joined = rows.join(scores, "id", "left")
    else:
        apart = F.col("id").isNull()
        few = scores.where(F.lit(False))
        if skewed:
            apart = apart | F.col("id").isin(list(skewed))
            few = scores.where(F.col("id").isin(list(skewed)))
        joined = rows.where(~apart).join(scores, "id", "left").unionByName(
            rows.where(apart).join(F.broadcast(few), "id", "left")
        )
    return joined.withColumns({
        "matched": F.coalesce("_found", F.lit(False)),
        "score": F.coalesce(F.col("score"), F.lit(float(missing))),
    }).drop("_found")
