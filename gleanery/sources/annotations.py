"""Annotation scan: one parquet file or a folder, pruned to the rules' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.rules import ScoringConfig
from gleanery.sources.positions import attach_positions, file_offsets


def prune_annotations(
    df: DataFrame, config: ScoringConfig, id_col: str = "id", order_col: str | None = None
) -> DataFrame:
    """``id``, the configured columns that exist and, if named, the order column."""
    keep = [name for name in config.columns if name in df.columns]
    order = [F.col(order_col)] if order_col else []
    return df.select(F.col(id_col).alias("id"), *keep, *order)


def scan_annotations(
    spark: SparkSession, path: str, config: ScoringConfig, id_col: str = "id"
) -> DataFrame:
    """Pruned scan plus ``annotation_pos``, the row's place in the sorted-file
    concatenation: it decides which of several rows for one id is the last."""
    files = spark.read.parquet(path)
    table = attach_positions(files, file_offsets(files), "annotation_pos")
    return prune_annotations(table, config, id_col, "annotation_pos")
