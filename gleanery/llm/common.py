"""Helpers of this subpackage: scratch tables, streaming over sorted groups, text batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import gleanery
from gleanery.runtime import ensure_checkpoint_dir

# Characters of text that a task holds as Python objects at a time.
CHUNK_CHARS = 4 << 20
SMALL_BYTES = 1 << 20


class Scratch:
    """Tables in the folder of ``spark.checkpoint.dir``. They cut lineage, outlive lost
    executors and are deleted by ``drop`` as soon as a later table replaces them."""

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        self.spark = spark
        self.root = f"{spark.sparkContext.getCheckpointDir()}/llm-{uuid.uuid4().hex}"
        self.made = 0
        self.kept: list[str] = []

    def path(self) -> str:
        self.made += 1
        self.kept.append(f"{self.root}/{self.made}")
        return self.kept[-1]

    def keep(self, df: DataFrame, **options: str) -> DataFrame:
        path = self.path()
        df.write.options(**options).parquet(path)
        return self.read(path, df)

    def read(self, path: str, like: DataFrame) -> DataFrame:
        frame = self.spark.read.schema(like.schema).parquet(path)
        frame._scratch_path = path
        return frame

    def drop(self, *frames: DataFrame | None) -> None:
        for frame in frames:
            if frame is not None and frame.__dict__.get("_scratch_path") in self.kept:
                self._delete(frame.__dict__["_scratch_path"])

    def sweep(self, *frames: DataFrame) -> None:
        """Delete all tables but these."""
        needed = {frame.__dict__["_scratch_path"] for frame in frames}
        for path in [p for p in self.kept if p not in needed]:
            self._delete(path)

    def _delete(self, path: str) -> None:
        self.kept.remove(path)
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, as ``--py-files`` would, once per context."""
    context = spark.sparkContext
    if not getattr(context, "_gleanery_shipped", False):
        parent = Path(gleanery.__file__).parent.parent
        bundle = f"{tempfile.mkdtemp(prefix='gleanery-')}/gleanery.zip"  # on the driver; Spark hands it out
        with zipfile.ZipFile(bundle, "w") as archive:
            for file in sorted(parent.glob("gleanery/**/*.py")):
                archive.write(file, file.relative_to(parent))
        context.addPyFile(bundle)
        context._gleanery_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(text_column: str = "text"):
    """Text with null as the empty text."""
    return F.coalesce(F.col(text_column), F.lit("")).alias(text_column)


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` characters, one row at least. What a
    slice has freed goes back before the next one."""
    sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last
        release_unused()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, in their order, from a partition that is sorted by
    ``keys``. A group may span batches; only the open one is carried over."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks() if held else pa.Table.from_batches([batch])
        starts = group_starts(table, keys)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last)
        held = table.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def share_text(spark: SparkSession, path: str):
    """A small fixed file (a tokenizer) as a broadcast, so workers need not hold it."""
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files of this kind: a printable
    Latin-1 character is itself, the others follow from U+0100 on."""
    kept = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


def flatten(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i] : starts[i] + counts[i]``, one after another."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


_BUILT: dict[str, object] = {}


def built_once(value: object, build: Callable):
    """What ``build`` makes of a value (a broadcast one, a seed, a tokenizer's text), made
    once per worker. A worker lives through many stages: the model of the last one is
    let go, and its memory given back, before the next is built."""
    if _BUILT.get("build") is not build or (_BUILT["value"] is not value and (isinstance(value, dict) or _BUILT["value"] != value)):
        _BUILT.clear()
        give_back()
        _BUILT.update(build=build, value=value, made=build(value))
    return _BUILT["made"]


def give_back() -> None:
    """Return all freed memory to the system, that of unreachable objects too."""
    gc.collect()
    release_unused()


def release_unused() -> None:
    """Return what Arrow and the C library hold of freed memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # of glibc alone
        ctypes.CDLL(None).malloc_trim(0)


def mapped(frame: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``frame.mapInArrow(run, schema)`` whose tasks give back what they freed: workers
    live on, and idle ones would otherwise hold the most that any task has needed. What a
    task of less than SMALL_BYTES held is left to the next one."""

    def whole(batches):
        read = 0

        def counted():
            nonlocal read
            for batch in batches:
                read += batch.nbytes
                yield batch

        try:
            yield from run(counted())
        finally:
            if read >= SMALL_BYTES:
                give_back()

    return frame.mapInArrow(whole, schema)


def scored(docs: DataFrame, model: object, build: Callable, add: str, score: Callable, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``add`` (a schema) that ``score(built, texts)`` returns
    for each slice of texts, null text as empty. Columns of the same names are replaced."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [part.split()[0] for part in add.split(", ")]
    names = [n for n in docs.columns if n not in added]
    schema = StructType([*docs.select(*names).schema.fields, *StructType.fromDDL(add).fields])

    def run(batches):
        for batch in batches:
            for part in chunks(batch, text):
                built = built_once(shared.value, build)
                made = score(built, pa.compute.fill_null(part.column(text), ""))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *map(pa.array, made)], names=[*names, *added])

    return mapped(docs.select(*names), run, schema)
