"""Gather of the caller's own positions: rows of a dataset by number, in a given order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.gather import RESERVED, gather_ordered
from gleanery.operators.selection import Selection
from gleanery.runtime import PAYLOAD_ROWS, held
from gleanery.sources.dataset import read_dataset
from gleanery.sources.positions import attach_positions, file_offsets, unfiltered


def checked_selection(positions: DataFrame, source_rows: int, order_col: str | None) -> Selection:
    """The positions as a selection. One aggregate counts them and checks that each exists
    and that the order has no gap, repeat or NULL."""
    order = [F.col(order_col).cast("bigint").alias("draw_pos")] if order_col else []
    slim = held(positions.select(F.col("source_pos").cast("bigint").alias("source_pos"), F.lit(None).cast("double").alias("score"), *order), None)
    checks = [F.count_distinct("draw_pos").alias("places"), F.min("draw_pos").alias("first"), F.max("draw_pos").alias("last")] if order_col else []
    found = slim.agg(
        F.count(F.lit(1)).alias("rows"), F.count("source_pos").alias("known"), F.min("source_pos").alias("low"),
        F.max("source_pos").alias("high"), *checks,
    ).first()
    if found["known"] < found["rows"]:
        raise IndexError(f"{found['rows'] - found['known']} positions are NULL")
    if found["rows"] and (found["low"] < 0 or found["high"] >= source_rows):
        raise IndexError(f"Position out of range: {found['low']}..{found['high']}, source rows: {source_rows}")
    if order_col and found["rows"] and (found["places"], found["first"], found["last"]) != (found["rows"], 0, found["rows"] - 1):
        raise ValueError(f"{order_col} must number the {found['rows']} positions from 0 without gap or repeat")
    return Selection(slim, found["rows"], True, order_col is not None)


def gather_positions(
    dataset: DataFrame | str, positions: DataFrame, order_col: str | None = None, per_shard: int = PAYLOAD_ROWS,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Rows of a folder of parquet files, or of an unfiltered parquet-backed frame, at
    ``positions`` (``source_pos`` from 0, repeats allowed): the dataset's columns,
    ``source_pos`` and ``out_pos``, which numbers the output. The output is in the order of
    ``order_col`` (dense from 0), or of the source without one; partition i holds output
    rows ``i * per_shard`` onwards, sorted. A position that does not exist is an
    IndexError, before any row is read."""
    table = dataset if isinstance(dataset, DataFrame) else read_dataset(spark or SparkSession.active(), dataset)
    taken = RESERVED.intersection(table.columns)
    if taken:
        raise ValueError(f"Rename these dataset columns first: {sorted(taken)}")
    offsets = file_offsets(unfiltered(table))
    rows = sum(count for _, _, count in offsets)
    chosen = checked_selection(positions, rows, order_col)
    source = attach_positions(table, offsets, "source_pos")
    gathered, _, _ = gather_ordered(source, chosen, per_shard, "draw" if order_col else "source", rows)
    return gathered.select(*table.columns, "source_pos", "out_pos")
