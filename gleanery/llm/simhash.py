"""SimHash fingerprints and search within a Hamming radius (operator 10), all as
DataFrame expressions.

Terms are pairs of neighbouring words of the lower-cased text, the last word alone; a
term's weight is its length, 16 at most, so pairs of short function words say little.
Every term's hash votes with its weight on each of 64 bits; a bit is set if more than
half of the weight says so. Votes of bits j and j + 32 share one sum, in its lower and
upper half, so 32 sums of a row-wise aggregation that combines on the map side hold all
64 (up to 2^28 terms a text).

Null text is the empty text; its fingerprint is 0. Rows that repeat both ``doc_id`` and
text count as one document, and each gets its result; a null ``doc_id`` counts as the
smallest. Documents with one id are ordered by their text's hash. An empty table gives
no rows; other columns are not carried.

The search for all fingerprints within a radius takes as queries the documents whose
``doc_id`` is divisible by ASKED, against all documents; ``n_near`` counts the other
documents found, and is null for documents that do not ask. A document repeated row by
row counts as often as it has rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, read_table

LANES = 32
RADIUS = 3  # bits in which near fingerprints may differ
BLOCKS = 6  # at a radius of 3: 20 tables with keys of 32 bits, the same at every size
ASKED = 100
KEY_ROWS = 4096  # stored fingerprints of one key that are compared in one piece
PAIR = 0x0000000100000001
LOWEST = -(1 << 63)


def terms(text: Column) -> Column:
    """Array of (a, b): each word and the next, null after the last."""
    words = F.array_remove(F.split(F.translate(F.lower(text), "\t\n\r\f\v", "     "), " "), "")
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"))


def fingerprints(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``fingerprint`` (64 bits as bigint) of each row's ``text``; rows that
    agree on ``keys`` are one text in pieces."""
    rows = texts.select(*keys, F.explode_outer(terms(F.col("text"))).alias("_t"))
    rows = rows.select(
        *keys, F.xxhash64("_t.a", "_t.b").alias("_vote"),
        F.least(F.coalesce(F.length("_t.a"), F.lit(0)) + F.coalesce(F.length("_t.b"), F.lit(0)), F.lit(16)).cast("bigint").alias("_weight"),
    )
    votes = [F.sum(F.shiftrightunsigned("_vote", j).bitwiseAND(F.lit(PAIR)) * F.col("_weight")).alias(f"v{j}") for j in range(LANES)]
    summed = rows.groupBy(*keys).agg(F.sum("_weight").alias("total"), *votes)

    def bit(votes_for: Column, place: int) -> Column:
        mask = 1 << place
        return F.when(2 * votes_for > F.col("total"), F.lit(mask - (1 << 64) if mask >> 63 else mask)).otherwise(F.lit(0))

    bits = [bit(F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF)), j) for j in range(LANES)]
    bits += [bit(F.shiftrightunsigned(f"v{j}", 32), j + 32) for j in range(LANES)]
    return summed.select(*keys, reduce(Column.bitwiseOR, (b.cast("bigint") for b in bits)).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def near_fingerprints(queries: DataFrame, stored: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """Every (fingerprint, near, distance) with ``near`` among the distinct fingerprints
    of ``stored`` and at most ``radius`` bits away from a distinct one of ``queries``.

    The 64 bits form ``blocks`` blocks. At most ``radius`` of them can differ, so a match
    agrees on all the others in at least one of the permuted tables, one per choice of
    agreeing blocks. A pair is kept by the first table that holds it. Equal fingerprints
    are one row on either side, so copies make no pairs; join them back by value. Only
    keys that a query has go on, and a key of many stored fingerprints is dealt over
    parts of about KEY_ROWS, to each of which its queries go."""
    blocks = blocks or radius + 2
    if not radius < blocks <= 16:
        raise ValueError("radius must be below blocks, at most 16")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    tables = [sum(masks[i] for i in kept) for kept in combinations(range(blocks), blocks - radius)]

    def literal(mask: int) -> Column:
        return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")

    def keyed(frame: DataFrame, name: str) -> DataFrame:
        distinct = frame.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.struct(F.lit(t).alias("table"), F.col(name).bitwiseAND(literal(m)).alias("key")) for t, m in enumerate(tables)])
        return distinct.select(name, F.explode(keys).alias("k")).select(name, "k.*")

    asked, held = keyed(queries, "fingerprint"), keyed(stored, "near")
    touched = held.join(asked.select("table", "key").distinct(), ["table", "key"], "left_semi")
    parts = touched.groupBy("table", "key").agg(F.ceil(F.count(F.lit(1)) / KEY_ROWS).cast("int").alias("parts"))
    dealt = touched.join(parts, ["table", "key"]).withColumn("part", F.pmod(F.xxhash64("near"), "parts").cast("int")).drop("parts")
    sent = asked.join(parts, ["table", "key"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    differ = F.col("fingerprint").bitwiseXOR(F.col("near"))
    first = reduce(
        lambda later, t: F.when(differ.bitwiseAND(literal(tables[t])) == 0, F.lit(t)).otherwise(later),
        reversed(range(len(tables))), F.lit(None),
    )
    distance = F.bit_count(differ)
    met = sent.join(dealt, ["table", "key", "part"]).where((distance <= radius) & (first == F.col("table")))
    return met.select("fingerprint", "near", distance.alias("distance"))


def near_counts(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(k, h, copy, n_near) of the asking rows of a table of rows (k, h, copy, f): how many
    other rows have a fingerprint at most ``radius`` bits away."""
    asking = prints.where((F.col("k") != LOWEST) & (F.col("k") % ASKED == 0)).select("k", "h", "copy", "f")
    per_print = prints.groupBy("f").agg(F.count(F.lit(1)).alias("c"))
    named = F.col("f").alias("fingerprint")
    pairs = near_fingerprints(asking.select(named), prints.select(named), radius, blocks)
    found = pairs.join(per_print, pairs["near"] == per_print["f"]).groupBy("fingerprint").agg(F.sum("c").alias("c"))
    return asking.join(found, asking["f"] == found["fingerprint"]).select("k", "h", "copy", (F.col("c") - 1).alias("n_near"))


def next_documents(slim: DataFrame, scratch: Scratch) -> DataFrame:
    """(k, h, need, next_k, next_h) of distinct documents (k, h, n): the next one in
    descending order, the first after the last. Ranges of ids are ordered each on its
    own; only their first rows, one per range, are ordered in one task."""
    ordered = scratch.keep(
        slim.distinct().repartitionByRange(F.desc("k"), F.desc("h")).withColumn("part", F.spark_partition_id())
    )
    heads = ordered.groupBy("part").agg(F.max(F.struct("k", "h")).alias("head"))
    by_part = Window.orderBy("part")
    following = heads.select(
        "part",
        F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"),
    )
    inside = Window.partitionBy("part").orderBy(F.desc("k"), F.desc("h"))
    linked = ordered.withColumn("following", F.lead(F.struct("k", "h")).over(inside))
    linked = linked.join(F.broadcast(following), "part")  # a row per shuffle partition
    then = F.coalesce("following", "after")
    return linked.select("k", "h", F.floor(F.col("n") / 2).cast("int").alias("need"), then["k"].alias("next_k"), then["h"].alias("next_h"))


def edited_documents(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Texts with their edited form (k, h, text, edited), and the slim links behind them."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("k"), bounded())
    texts = texts.withColumn("h", F.xxhash64("text"))
    links = scratch.keep(next_documents(texts.select("k", "h", F.length("text").alias("n")), scratch))
    copies = Window.partitionBy("k", "h").orderBy("k", "h")
    # a running count: a filtered row_number would give this and the plain table two exchanges
    once = texts.withColumn("copy", F.count(F.lit(1)).over(copies.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    asked = links.select(F.col("next_k").alias("nk"), F.col("next_h").alias("nh"), "k", "h", "need")
    starts = once.where("copy = 1").select(F.col("k").alias("nk"), F.col("h").alias("nh"), "text")
    heads = starts.join(asked, ["nk", "nh"]).select("k", "h", "need", F.expr("left(text, need)").alias("head"))
    edited = F.concat(F.expr("left(text, length(text) - need)"), "head")
    return once.join(heads, ["k", "h"]).select("k", "h", "copy", "text", edited.alias("edited")), links


def compared_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of rows (doc_id, text) and of their edited texts, how alike these and
    the next document's are, and the count of near documents for those that ask."""
    scratch = Scratch(docs.sparkSession)
    rows, links = edited_documents(docs, scratch)
    both = F.array(F.struct(F.lit(0).alias("edit"), F.col("text")), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text")))
    measures = rows.select(
        "k", "h", "copy", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(both).alias("v"),
    )
    keys = ("k", "h", "copy", "n_chars", "edited_sha256", "edit")
    found = fingerprints(measures.select("k", "h", "copy", "n_chars", "edited_sha256", "v.edit", "v.text"), *keys)
    side = lambda edit: F.max(F.when(F.col("edit") == edit, F.col("fingerprint")))
    prints = scratch.keep(found.groupBy("k", "h", "copy", "n_chars", "edited_sha256").agg(side(0).alias("f"), side(1).alias("e")))
    after = prints.where("copy = 1").select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("f").alias("g"))
    near = links.join(after, ["next_k", "next_h"]).select("k", "h", "g")
    text_of = lambda name: F.lower(F.lpad(F.hex(name), 16, "0"))
    counts = scratch.keep(near_counts(prints))  # a row per asking one
    return prints.join(near, ["k", "h"]).join(counts, ["k", "h", "copy"], "left").select(
        F.when(F.col("k") != LOWEST, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256",
        text_of("f").alias("fingerprint"), text_of("e").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("g")).alias("near_next"), "n_near",
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_documents(read_table(spark, sf_dir, "documents"))
