"""Small helpers around Spark: materialising a frame, and bounded broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Nothing larger than this is ever broadcast; beyond it every caller has a
# shuffle plan. Well under spark.driver.maxResultSize's default of 1 GiB.
BROADCAST_BYTES = 256 << 20
# Frames up to this many slim rows are cached; larger ones are checkpointed, so
# that losing an executor does not re-run the joins behind them.
CACHE_ROWS = 50_000_000
# Target rows of one sorted bucket or block: slim rows, some 20 MB of them.
BUCKET_ROWS = 1 << 20
# Rows with their payload in one sorted shard, where the caller names no number: 256 MB
# of a task's memory at 4 KB a row.
PAYLOAD_ROWS = 1 << 16


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's ``spark.checkpoint.dir``. Only a local master without one
    gets a temporary folder; a cluster must name a shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="gleanery-checkpoint-")
    context.setCheckpointDir(configured)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a parquet table in the checkpoint folder: unlike a
    checkpointed RDD it keeps column pruning and known sizes."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/gleanery-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._checkpoint_path = path
    return table


def held(df: DataFrame, rows: int | None) -> DataFrame:
    """Materialise a slim frame that several jobs read. ``rows`` is its expected size,
    None if unknown."""
    if rows is not None and rows <= CACHE_ROWS:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return checkpointed(df)


def release(*frames: DataFrame) -> None:
    """Drop cached frames, and delete the tables of checkpointed ones."""
    for frame in frames:
        frame.unpersist()
        path = frame.__dict__.pop("_checkpoint_path", None)
        if path is not None:
            context = frame.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def small_frame(
    spark: SparkSession, columns: Mapping[str, Sequence], row_bytes: int
) -> DataFrame:
    """A driver-made lookup table (a local relation, so no job runs for it), marked for
    broadcast only if its size allows."""
    table = pa.table({
        name: pa.array(values, pa.string() if values and isinstance(values[0], str) else pa.int64())
        for name, values in columns.items()
    })
    frame = spark.createDataFrame(table)
    return F.broadcast(frame) if table.num_rows * row_bytes <= BROADCAST_BYTES else frame
