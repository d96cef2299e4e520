"""Approximate score distribution from mergeable sketches.

A KLL sketch of a few KB stands for any number of scores. Sketches of shards, days or
sources can be kept in a table and merged later in any grouping; quantiles are then read
without touching the scores again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.stats import PERCENTS

# Sketches of this size place a quantile within RANK_ERROR of its rank, as a
# share of all rows (0.5 % with 99 % confidence, so twice that practically always).
SKETCH_SIZE, RANK_ERROR = 1000, 0.01


def score_sketches(scored: DataFrame, *by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``(by, sketch, low, high, total)`` per group; NULL and NaN scores are left out."""
    score = F.when(~F.isnan("score"), F.col("score"))
    return scored.groupBy(*by).agg(
        F.kll_sketch_agg_double(score, F.lit(size)).alias("sketch"), F.min(score).alias("low"), F.max(score).alias("high"),
        F.sum(score).alias("total"))


def merged_sketches(sketches: DataFrame, *by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"))


def approximate_distribution(sketches: DataFrame, *by: str) -> DataFrame:
    """``(by, rows, mean, median, min, max, p10...)`` of each sketch. Mean and extremes are
    exact, percentiles are scores within RANK_ERROR of their rank; NULL without scores."""
    rows = F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0)).alias("rows")
    at = lambda p: F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)))
    counted = sketches.select("*", rows)
    return counted.select(
        *by, "rows", (F.col("total") / F.nullif(F.col("rows"), F.lit(0))).alias("mean"), at(50).alias("median"), F.col("low").alias("min"),
        F.col("high").alias("max"), *[at(p).alias(f"p{p}") for p in PERCENTS])
