"""Global positions without a single-task sort.

Rows fall into buckets that are ordered like the rows. Counting rows per bucket
(map-side combine, one row per bucket to the driver) gives where each bucket starts;
``row_number`` inside a bucket does the rest. Callers choose a bucket expression
that is monotone in the order and provably balanced, so no sampling pass is needed
and the result does not depend on partitioning.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.runtime import BUCKET_ROWS, checkpointed, small_frame

BUCKET_BYTES = 64


def bucket_counts(df: DataFrame, bucket: Column) -> list[tuple[int, int]]:
    """``(bucket, rows)`` in bucket order."""
    rows = df.groupBy(bucket.cast("bigint").alias("bucket")).count().collect()
    return sorted((row["bucket"], row["count"]) for row in rows)


def starts_frame(spark: SparkSession, counts: Sequence[tuple[int, int]], key: str) -> DataFrame:
    """Where each bucket starts, as ``(key, _start)``."""
    ends = list(itertools.accumulate(rows for _, rows in counts))
    columns = {key: [bucket for bucket, _ in counts], "_start": [0, *ends[:-1]]}
    return small_frame(spark, columns, BUCKET_BYTES)


def position_by_bucket(
    df: DataFrame, order_by: Sequence[Column], bucket: Column, name: str = "pos",
    counts: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """0-based position in ``order_by`` (a total order that ``bucket`` follows)."""
    counts = bucket_counts(df, bucket) if counts is None else counts
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by)) - 1
    placed = df.withColumn("_bucket", bucket.cast("bigint")).withColumn("_within", within.cast("bigint"))
    if len(counts) <= 1:
        return placed.withColumn(name, F.col("_within")).drop("_bucket", "_within")
    starts = starts_frame(df.sparkSession, counts, "_bucket")
    return (
        placed.join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_bucket", "_start", "_within")
    )


def global_position(df: DataFrame, order_by: Sequence[Column], name: str = "pos", rows: int | None = None) -> DataFrame:
    """0-based position for an arbitrary total order. Rows are range-partitioned
    and sorted once; the row's partition and place in it, both in
    ``monotonically_increasing_id``, are checkpointed before they are used."""
    rows = df.count() if rows is None else rows
    parts = max(1, -(-rows // BUCKET_ROWS))
    ordered = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    placed = checkpointed(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = bucket_counts(placed, part)
    if len(counts) <= 1:
        return placed.withColumn(name, within).drop("_place")
    starts = starts_frame(df.sparkSession, counts, "_part")
    return (
        placed.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + within)
        .drop("_place", "_part", "_start")
    )


def unique_position(df: DataFrame, keys: Sequence[str], name: str = "pos") -> tuple[DataFrame, int]:
    """0-based position in the order of ``keys``, and the number of rows. Keys must be
    unique and not NULL: equal ones lie in one range and meet there, so the sort that
    places the rows shows them too."""
    rows = df.count()
    parts = max(1, -(-rows // BUCKET_ROWS))
    order = [F.col(key) for key in keys]
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    missing = functools.reduce(operator.or_, [key.isNull() for key in order])
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = checkpointed(
        ordered.withColumn("_fault", F.when(missing, 1).when(copies > 1, 2).otherwise(0).cast("tinyint"))
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", 33)
    found = placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("_fault") == 1).alias("missing"), F.max(F.col("_fault") == 2).alias("repeated")).collect()
    if any(row["missing"] for row in found):
        raise ValueError(f"row_key {list(keys)} has NULLs")
    if any(row["repeated"] for row in found):
        raise ValueError(f"row_key {list(keys)} is not unique")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((row["part"], row["rows"]) for row in found)
    starts = starts_frame(df.sparkSession, counts, "_part")
    positioned = placed.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_start") + within)
    positioned = positioned.drop("_place", "_part", "_start", "_fault")
    positioned._checkpoint_path = placed._checkpoint_path  # released with it
    return positioned, rows


def n_smallest(
    df: DataFrame, n: int, order_by: Sequence[Column], bucket: Column,
    counts: Sequence[tuple[int, int]],
) -> DataFrame:
    """The ``n`` first rows of ``order_by`` as a set. Buckets before the cut are kept
    whole; only the one bucket that holds the cut is sorted."""
    at, edge = 0, None
    for number, rows in counts:
        if at + rows > n:
            edge = number
            break
        at += rows
    if edge is None:
        return df
    numbered = df.withColumn("_bucket", bucket.cast("bigint"))
    below = numbered.where(F.col("_bucket") < edge).drop("_bucket")
    boundary = numbered.where(F.col("_bucket") == edge).drop("_bucket")
    return below.unionByName(boundary.orderBy(*order_by).limit(n - at))
