"""Token ids in Parquet files (operator 9).

Layout: one row per document, in ascending order of ``doc_id`` within and across files:
``doc_id``, ``shard`` and ``place`` (file and row), ``n_tokens`` and the list column
``ids``. Spark's own writer makes the files with the second page format, so ids are
dictionary coded while that pays and delta coded otherwise; row groups and pages have
fixed sizes and the footer holds page indexes. A reader that wants metadata alone never
touches the ids; one that wants some documents skips row groups and pages by ``doc_id``.

Null text is the empty text: its document holds the end id only. Rows that repeat a
``doc_id`` stay, ordered by their text's hash. A null ``doc_id`` sorts first. Other
columns are not carried. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, chunks, read_table, share_text
from gleanery.llm.word_tokens import SLICE_CHARS, word_ids

FILE_SCHEMA = "doc_id bigint, shard int, place bigint, n_tokens bigint, ids array<int>"
ROW_GROUP_BYTES, PAGE_BYTES = 32 << 20, 256 << 10


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows of the file format, partitions in ascending order of ``doc_id``."""
    model = share_text(docs.sparkSession, tokenizer)

    def run(batches):
        encoder, place = word_ids(model.value), 0
        for batch in batches:
            for part in chunks(batch, limit=SLICE_CHARS):
                ids, counts = encoder.encode(part.column("text"))
                lengths = counts + 1
                ends = np.cumsum(lengths)
                flat, own = np.full(int(lengths.sum()), end_id, np.int32), np.ones(int(lengths.sum()), bool)
                own[ends - 1] = False
                flat[own] = ids
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("shard"), pa.array(np.arange(place, place + n)),
                    pa.array(lengths), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat)),
                ], names=["doc_id", "shard", "place", "n_tokens", "ids"])
                place += n

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), bounded())
    ordered = texts.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    return ordered.select("doc_id", "text", F.spark_partition_id().alias("shard")).mapInArrow(run, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    encode_documents(docs, tokenizer, end_id).write.options(**{
        "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.size": str(PAGE_BYTES), "compression": "zstd",
    }).parquet(path)


def read_token_files(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns only; all without names."""
    frame = spark.read.schema(FILE_SCHEMA).parquet(path)
    return frame.select(*columns) if columns else frame


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, place, start): ids before each document, from the slim columns alone."""
    slim = read_token_files(spark, path, "shard", "place", "n_tokens")
    totals = slim.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before")
    )  # one row per file
    running = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("place"))
    return slim.withColumn("running", running).join(F.broadcast(before), "shard").select(
        "shard", "place", (F.col("before") + F.col("running") - F.col("n_tokens")).alias("start")
    )


def checksums(frame: DataFrame) -> DataFrame:
    """Adds ids_crc32, the unsigned crc32 of the ids as little-endian unsigned integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            cuts = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("place"), batch.column("doc_id"), batch.column("n_tokens"),
                 pa.array(sums, pa.int64())], names=["shard", "place", "doc_id", "n_tokens", "ids_crc32"])

    return frame.mapInArrow(run, "shard int, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = Scratch(spark).path()
    write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    sums = checksums(read_token_files(spark, path))
    return sums.join(token_starts(spark, path), ["shard", "place"]).select("doc_id", "start", "n_tokens", "ids_crc32")
