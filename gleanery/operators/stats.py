"""Score statistics, the match-rate gate and sampling totals.

Everything is computed from a score histogram: rows are counted per distinct score
with map-side combine, so only distinct scores (a few per rule set, whatever the
number of rows) travel to the final aggregate.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.operators.quantiles import exact_percentiles
from gleanery.runtime import held

log = logging.getLogger(__name__)

LOWEST_MATCH_RATE = 0.2
USUAL_MATCH_RATE = 0.9
PERCENTS = (10, 25, 50, 75, 90)
DISTRIBUTION = ("mean", "median", "std", "min", "max", *(f"p{p}" for p in PERCENTS))
# Up to so many different scores, a task's statistics may hold all of them.
OBSERVED_DISTINCT = 1 << 16
# The final ``percentile`` holds each distinct score once, in one task. Rule sets
# that could give more distinct scores take the multi-pass way instead.
ONE_TASK_DISTINCT = 2_000_000


def weight_column(score: Column | str = "score") -> Column:
    """Sampling weight: negative (and NaN) scores count as zero."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when((score > 0) & ~F.isnan(score), score).otherwise(F.lit(0.0))


def distribution_metrics(score: str = "score") -> list[Column]:
    """The DISTRIBUTION as plain aggregates, which keep every different score of a task:
    for frames whose number of different scores is known to be small."""
    at = F.percentile(score, F.array(*[F.lit(p / 100) for p in PERCENTS]))
    return [F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"), at.alias("at")]


def distribution_frame(spark: SparkSession, metrics: Mapping) -> DataFrame:
    """The one row of :func:`score_distribution` from known ``distribution_metrics``."""
    at = metrics["at"] or [None] * len(PERCENTS)
    row = {**{name: metrics[name] for name in ("mean", "std", "min", "max")}, **{f"p{p}": v for p, v in zip(PERCENTS, at)}}
    row["median"] = row["p50"]
    return spark.createDataFrame([tuple(row[name] for name in DISTRIBUTION)], ", ".join(f"{name} double" for name in DISTRIBUTION))


def score_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("score").agg(F.count(F.lit(1)).alias("rows"))


def _total() -> Column:
    return F.nullif(F.sum("rows").cast("double"), F.lit(0.0))


def score_distribution(scored: DataFrame, distinct_bound: int | None = None) -> DataFrame:
    """One row: mean, median, population deviation, extremes and interpolated
    percentiles; all NULL for an empty input. ``distinct_bound`` is a proven upper bound
    on the number of different scores, as the rules give it; without one, or above
    ``ONE_TASK_DISTINCT``, the multi-pass way is taken. Both give the same numbers."""
    histogram = score_histogram(scored)
    if distinct_bound is not None and distinct_bound <= ONE_TASK_DISTINCT:
        # The histogram fits one task, so the mean can be set beside every row there:
        # the deviation needs no second pass over the data.
        whole = Window.partitionBy()
        center = F.sum(F.col("score") * F.col("rows")).over(whole) / F.sum("rows").over(whole)
        histogram = histogram.withColumn("center", center)
        at = F.percentile("score", F.array(*[F.lit(p / 100) for p in PERCENTS]), F.col("rows"))
    else:
        histogram = held(histogram, None)
        mean = histogram.agg(F.sum(F.col("score") * F.col("rows")) / _total()).first()[0]
        histogram = histogram.withColumn("center", F.lit(mean).cast("double"))
        values = exact_percentiles(histogram, [p / 100 for p in PERCENTS])
        at = F.array(*[F.lit(value).cast("double") for value in values])
    deviation = F.col("score") - F.col("center")
    row = histogram.agg(
        at.alias("at"),
        F.first("center").alias("mean"),
        F.sqrt(F.sum(deviation * deviation * F.col("rows")) / _total()).alias("std"),
        F.min("score").alias("min"),
        F.max("score").alias("max"),
    )
    shown = {f"p{p}": F.col("at")[index] for index, p in enumerate(PERCENTS)}
    shown["median"] = shown["p50"]
    return row.select(*[shown.get(name, F.col(name)).alias(name) for name in DISTRIBUTION])


def match_rate(scored: DataFrame) -> DataFrame:
    """``(rows, matched, match_rate)``; an empty dataset has rate 0."""
    totals = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("matched").alias("matched")
    )
    rate = F.coalesce(F.col("matched") / F.nullif(F.col("rows"), F.lit(0)), F.lit(0.0))
    return totals.withColumn("match_rate", rate)


def weight_totals(scored: DataFrame) -> DataFrame:
    """``(weight_sum, eligible)``: total sampling weight and rows that can be drawn."""
    weight = weight_column()
    return scored.agg(
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("weight_sum"),
        F.count_if(weight > 0).alias("eligible"),
    )


def selection_summary(selection: DataFrame, source_rows: int) -> DataFrame:
    """``(source_rows, selected_rows, ratio)``."""
    ratio = F.col("selected_rows") / F.lit(float(source_rows)) if source_rows else F.lit(None).cast("double")
    return selection.agg(
        F.lit(source_rows).cast("bigint").alias("source_rows"),
        F.count(F.lit(1)).alias("selected_rows"),
    ).withColumn("ratio", ratio)


@dataclass(frozen=True)
class Profile:
    """What the gate and the samplers need to know about a scored dataset."""

    rows: int
    matched: int
    eligible: int
    weight_sum: float
    weight_max: float
    distribution: Mapping | None = None

    @property
    def match_rate(self) -> float:
        return self.matched / self.rows if self.rows else 0.0


def profile(scored: DataFrame, distinct_bound: int | None = None) -> Profile:
    """The totals, in one action that brings one row to the driver; with them the score
    distribution, if there are few different scores."""
    weight = weight_column()
    few = distinct_bound is not None and distinct_bound <= OBSERVED_DISTINCT
    row = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("matched").alias("matched"),
        F.count_if(weight > 0).alias("eligible"),
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("weight_sum"),
        F.coalesce(F.max(weight), F.lit(0.0)).alias("weight_max"),
        *(distribution_metrics() if few else []),
    ).first().asDict()
    totals = [row.pop(name) for name in ("rows", "matched", "eligible", "weight_sum", "weight_max")]
    return Profile(*totals, row if few else None)


def check_match_rate(found: Profile, missing_score: float, force: bool = False) -> None:
    """Stop (or, with ``force``, warn) when few ids have annotations."""
    percent = f"{found.match_rate * 100:.1f}% of dataset IDs have annotations"
    if found.match_rate < LOWEST_MATCH_RATE:
        message = f"Only {percent}; do the annotations belong to this dataset?"
        if not force:
            raise ValueError(message)
        log.warning("%s Going on because of force.", message)
    elif found.match_rate < USUAL_MATCH_RATE:
        log.warning(
            "%s; the other %d rows score %s.", percent, found.rows - found.matched, missing_score
        )
