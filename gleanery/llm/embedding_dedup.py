"""Near-duplicate vectors by random-hyperplane hashing (operator 3).

Vectors are compared within a label only. Equal vectors of a label are one class (by a
128-bit hash); from here on only classes count, with their size. Each class has a key in
several tables: the signs of projections on random hyperplanes. Two vectors with cosine
0.98 agree on a sign with probability 0.936; the number of signs follows the number of
classes, so buckets stay small, and the number of tables follows the signs, so that a link
is missed with less than MISS.

All pairs of a bucket that no earlier table shares are compared in double precision,
in blocks: a bucket of many members is cut into blocks of about BLOCK, and each pair of
blocks is a group of its own, a matrix product. Pairs never become rows: a group returns
the number of links of each member, and a spanning forest of its links. Components come
from the forests.

Vectors that are null, empty, zero or hold null or non-finite components, and rows
without label, link with nothing. Vectors of different lengths are not compared. Rows
that share a vec_id each get a row; components join them. A null vec_id counts as the
smallest. An empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from gleanery.llm.common import Scratch, group_starts, read_table, ship_package, sorted_groups
from gleanery.llm.components import Forest, connected_components

SIMILAR, MISS, BLOCK = 0.98, 1e-6, 512
# A matrix product may differ from the exact cosine by this much; closer calls are settled
# pair by pair.
DOUBT = 1e-9
LOWEST = -(1 << 63)


def table_plan(classes: int) -> tuple[int, int]:
    """Signs per key and number of tables."""
    signs = min(30, max(6, math.ceil(math.log2(max(2, classes) / 64))))
    met = (1 - math.acos(SIMILAR) / math.pi) ** signs
    return signs, math.ceil(math.log(MISS) / math.log(1 - met))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def table_keys(units: np.ndarray, signs: int, tables: int, seed: int = 7) -> np.ndarray:
    """One key per vector and table."""
    planes = np.random.default_rng([seed, units.shape[1]]).standard_normal((units.shape[1], tables * signs))
    return (units @ planes > 0).reshape(len(units), tables, signs) @ (1 << np.arange(signs))


def _keyed(signs: int, tables: int):
    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            starts = lists.offsets.to_numpy()
            sizes, values = np.diff(starts), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            keys = np.zeros((batch.num_rows, tables), np.int32)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                keys[own] = table_keys(unit_vectors(values[starts[own][:, None] + np.arange(size)]), signs, tables)
            cuts = pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(cuts, pa.array(keys.ravel()))],
                names=["class", "size", "keys"])

    return run


def _linked(batches):
    """Per group (label, size, table, key, low, high): links of members, and a forest."""
    names = ["label", "size", "table", "key", "low", "high"]
    for table in sorted_groups(batches, names):
        starts = group_starts(table, names)
        classes, ids, copies = (table.column(n).to_numpy() for n in ("class", "first", "c"))
        block, of_table = table.column("block").to_numpy(), table.column("table").to_numpy()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        keys = np.stack(table.column("keys").to_numpy()).astype(np.int32)
        for first, last in zip(starts, [*starts[1:], table.num_rows]):
            if last - first < 2:
                continue
            units = unit_vectors(np.stack(table.column("vector").slice(first, last - first).to_numpy()).astype(np.float64))
            own, own_keys = ids[first:last], keys[first:last]
            same_block = low[first] == high[first]
            left = np.arange(len(own)) if same_block else np.flatnonzero(block[first:last] == low[first])
            right = left if same_block else np.flatnonzero(block[first:last] == high[first])
            cosine = units[left] @ units[right].T
            i, j = np.nonzero(cosine >= SIMILAR - DOUBT)
            i, j = left[i], right[j]
            if same_block:
                i, j = i[i < j], j[i < j]
            close = (units[i] * units[j]).sum(axis=1) / np.sqrt((units[i] ** 2).sum(axis=1) * (units[j] ** 2).sum(axis=1)) >= SIMILAR
            earlier = (own_keys[i, :of_table[first]] == own_keys[j, :of_table[first]]).any(axis=1)
            i, j = i[close & ~earlier], j[close & ~earlier]
            if not len(i):
                continue
            count = copies[first:last]
            links = np.bincount(i, count[j], len(own)) + np.bincount(j, count[i], len(own))
            forest, tree = Forest(), []
            for a, b in zip(own[i].tolist(), own[j].tolist()):
                if forest.join(a, b):
                    tree.append((a, b))
            some = np.flatnonzero(links)
            edges = np.array(tree, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([classes[first:last][some], edges[:, 0]])), pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(edges), np.int64)])),
                pa.array(np.concatenate([np.zeros(len(some), np.int64), edges[:, 1]])),
            ], names=["a", "links", "b"])


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector, label)."""
    ship_package(vectors.sparkSession)
    scratch = Scratch(vectors.sparkSession)
    whole = isinstance(vectors.schema["label"].dataType, IntegralType)
    label = F.col("label").cast("bigint" if whole else "string")  # both tell different labels of a type apart
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("bigint"), F.lit(LOWEST)).alias("id"), label.alias("label"), "vector")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("label").isNotNull() & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0)
    hashed = lambda seed: F.when(usable, F.xxhash64(F.lit(seed), "label", "vector"))
    rows = scratch.keep(rows.withColumns({"d1": hashed(1), "d2": hashed(2)}))
    classes = scratch.keep(
        rows.where("d1 IS NOT NULL").groupBy("d1", "d2")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))
        .withColumnRenamed("d1", "class"))
    signs, tables = table_plan(classes.count())
    keyed = scratch.keep(classes.select("class", "vector").mapInArrow(_keyed(signs, tables), "class bigint, size int, keys array<int>")
                         .join(classes, "class"))
    bucket = ["label", "size", "table", "key"]
    placed = keyed.select("class", "label", "size", F.posexplode("keys").alias("table", "key"))
    full = scratch.keep(placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n"))
    met = placed.join(full, bucket).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("class", *bucket, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    group = [*bucket, "low", "high"]
    # vectors join last, so up to here buckets move slim rows only
    complete = met.join(keyed.select("class", "first", "c", "vector", "keys"), "class").repartition(*group).sortWithinPartitions(*group)
    found = scratch.keep(complete.mapInArrow(_linked, "a bigint, links bigint, b bigint"))
    links = found.where("links > 0").groupBy(F.col("a").alias("d1")).agg(F.sum("links").alias("links"))
    counted = scratch.keep(classes.select(F.col("class").alias("d1"), "d2", "first", "c").join(links, "d1", "left"))
    member = rows.select("id", "d1", "d2").join(counted, ["d1", "d2"], "left")
    copies = member.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    of = connected_components(found.where("links = 0").select("a", "b").unionByName(copies), scratch).withColumnRenamed("node", "id")
    component = F.coalesce("component", "id")
    public = lambda c: F.when(c != LOWEST, c)
    return member.join(of, "id", "left").select(
        public(F.col("id")).alias("vec_id"), F.coalesce(F.col("c") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
        public(component).alias("component_id"), (F.col("id") == component).alias("kept"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label"))
