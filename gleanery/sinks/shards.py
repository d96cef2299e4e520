"""Sharded parquet output: ``data/train-00000-of-00004.parquet`` and so on."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gleanery.sinks.files import Folder

JOURNAL = "_journal.json"
_RENAME_THREADS = 32
_TIMESTAMPS = "spark.sql.parquet.outputTimestampType"


def rows_per_shard(source_rows: int, source_files: int) -> int:
    """About the row count of a source file."""
    return max(1, source_rows // max(1, source_files))


def shard_name(shard: int, shards: int) -> str:
    return f"train-{shard:05d}-of-{shards:05d}.parquet"


@contextmanager
def _plain_timestamps(spark: SparkSession) -> Iterator[None]:
    """Write timestamps as parquet's standard type, not the legacy 96-bit one, so
    that the output schema equals the source schema."""
    before = spark.conf.get(_TIMESTAMPS)
    spark.conf.set(_TIMESTAMPS, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(_TIMESTAMPS, before)


def check_free(spark: SparkSession, output_dir: str, overwrite: bool = False) -> None:
    data = Folder(spark, f"{output_dir}/data")
    if data.names("*.parquet") and not overwrite:
        raise FileExistsError(f"{data.path} already holds parquet files")


def stage_shards(rows: DataFrame, shards: int, output_dir: str) -> dict:
    """Write one file per partition of ``rows`` (partition i is shard i, sorted) to a
    staging folder: ``{"staging": folder, "parts": file of each shard}``."""
    spark = rows.sparkSession
    name = f"_staging-{uuid.uuid4().hex}"
    staging = Folder(spark, f"{output_dir}/{name}")
    with _plain_timestamps(spark):
        writer = rows.write.option("compression", "snappy").option("maxRecordsPerFile", 0)
        writer.parquet(staging.path)
    # part-<task partition>-<job>-...: the partition number is the shard number.
    parts = {int(name.split("-")[1]): name for name in staging.names("part-*")}
    if sorted(parts) != list(range(shards)):
        raise RuntimeError(f"Expected {shards} shards, the job wrote partitions {sorted(parts)}")
    return {"staging": name, "parts": [parts[shard] for shard in range(shards)]}


def seal(spark: SparkSession, output_dir: str, staged: dict, **facts) -> dict:
    """The journal of a publication: what is staged, which old shards it replaces, and
    ``facts`` of the caller. It appears in one rename; from then on the publication can be
    finished by anyone who reads it."""
    root = Folder(spark, output_dir)
    journal = {**staged, "replaced": Folder(spark, f"{output_dir}/data").names("*.parquet"), **facts}
    root.write_text(f"{JOURNAL}.new", json.dumps(journal))
    root.move(f"{JOURNAL}.new", f"{root.path}/{JOURNAL}")
    return journal


def pending(spark: SparkSession, output_dir: str) -> dict | None:
    """The journal of a publication that was not finished."""
    root = Folder(spark, output_dir)
    return json.loads(root.read_text(JOURNAL)) if root.exists(JOURNAL) else None


def publish(spark: SparkSession, output_dir: str, journal: dict) -> None:
    """Carry out a journal. Every step looks at what is there, so that it may be broken off
    anywhere and run again: old shards step aside first and are deleted last, then each
    staged file gets its name, then the card is written and the journal goes."""
    root, data = Folder(spark, output_dir), Folder(spark, f"{output_dir}/data")
    staging, aside = Folder(spark, f"{output_dir}/{journal['staging']}"), Folder(spark, f"{output_dir}/_replaced")
    shards = len(journal["parts"])
    staged, here = set(staging.names("part-*")), set(data.names("*.parquet"))
    waiting = {shard_name(i, shards): part for i, part in enumerate(journal["parts"]) if part in staged}
    old = here.intersection(journal["replaced"]) if len(waiting) == shards else set()
    if old:  # no staged file has its name yet, so these are the old shards
        aside.make()
        for name in sorted(old):
            data.move(name, f"{aside.path}/{name}")
    data.make()
    with ThreadPoolExecutor(_RENAME_THREADS) as pool:
        list(pool.map(lambda name: staging.move(waiting[name], f"{data.path}/{name}"), sorted(waiting)))
    missing = {shard_name(i, shards) for i in range(shards)}.difference(data.names("*.parquet"))
    if missing:
        raise RuntimeError(f"Shards are neither staged nor published: {sorted(missing)[:3]}")
    if "card" in journal:
        root.write_text("README.md", journal["card"])
    aside.remove()
    root.remove(JOURNAL)
    for name in root.names("_staging-*"):  # this one, and any that was never sealed
        root.remove(name)


def write_shards(rows: DataFrame, shards: int, output_dir: str, overwrite: bool = False, **facts) -> int:
    """Stage, seal and publish. A failed job leaves no half-written shard behind; one that
    failed after sealing is finished by :func:`publish`. An empty frame gives one file with
    the schema and no rows."""
    spark = rows.sparkSession
    check_free(spark, output_dir, overwrite)
    publish(spark, output_dir, seal(spark, output_dir, stage_shards(rows, shards, output_dir), **facts))
    return shards
