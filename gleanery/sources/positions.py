"""Row positions in the concatenation of a table's files in name order.

``position = rows in earlier files + row index within the file``. The row index
comes from the scan (``_metadata.row_index``), and the rows per file from parquet
footers, so no data column is read, nothing is shuffled, and splitting a file over
many tasks does not matter.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.runtime import small_frame


def file_offsets(df: DataFrame) -> list[tuple[str, int, int]]:
    """``(file, first position, rows)`` per non-empty file, in name order: one row
    per file, about what the driver's own file index already holds."""
    counts = df.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()
    offsets, start = [], 0
    for row in sorted(counts, key=lambda row: unquote(row["file"])):
        offsets.append((row["file"], start, row["count"]))
        start += row["count"]
    return offsets


def attach_positions(df: DataFrame, offsets: list[tuple[str, int, int]], name: str) -> DataFrame:
    row_index = F.col("_metadata.row_index")
    if len(offsets) <= 1:
        return df.select("*", row_index.alias(name))
    starts = small_frame(
        df.sparkSession,
        {"_file": [file for file, _, _ in offsets], "_start": [start for _, start, _ in offsets]},
        row_bytes=max(len(file) for file, _, _ in offsets) + 64,
    )
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), row_index.alias("_row"))
    return placed.join(starts, "_file").select(
        *[placed[column] for column in df.columns], (F.col("_start") + F.col("_row")).alias(name)
    )


def only_files(df: DataFrame, files: Iterable[str]) -> DataFrame:
    """Restrict a parquet-backed frame to some of its files; the others are pruned
    from the scan, not read."""
    return df.where(F.col("_metadata.file_path").isin(list(files)))


def files_of(offsets: list[tuple[str, int, int]], positions: Iterable[int]) -> set[str]:
    """The files that hold the given positions."""
    starts = [start for _, start, _ in offsets]
    return {offsets[bisect.bisect_right(starts, position) - 1][0] for position in positions}


def unfiltered(df: DataFrame) -> DataFrame:
    """All rows of the files behind a frame."""
    return df.sparkSession.read.parquet(*[unquote(file) for file in df.inputFiles()])


def with_source_pos(df: DataFrame, name: str = "source_pos") -> DataFrame:
    """Add positions to a parquet-backed frame. A frame already filtered keeps the
    positions of the full source table."""
    return attach_positions(df, file_offsets(unfiltered(df)), name)
