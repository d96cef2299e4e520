"""Near-duplicate groups by circulant MinHash and exact verification (operator 1).

A document's set holds the distinct runs of five words of its lower-cased text (A-Z;
words are separated by ASCII white space); a shorter text is one run of all its words.
Shingles are 64-bit hashes.

* Equal word sequences are one class, found by a 128-bit hash; from here on only classes
  count, so copies make no pairs.
* Signatures need two permutations of a universe of 2^22 places: the first spreads the
  shingles, the second gives their values, shifted by one place for each further
  coordinate. A shingle's values are one stretch of the second table.
* 32 bands of 4 coordinates: a pair with similarity 0.75 is missed with 5e-6.
* Pairs that met in a band are thinned by their sketches (a byte of each coordinate;
  what lies over five deviations below the threshold goes) and verified on the full
  shingle sets of the texts.

Buckets are never expanded into all pairs. First each member meets one hub of its bucket.
What these links join is one component. Then only buckets that still span components are
looked at again, in blocks: members outside the bucket's largest component against all
members, and of these pairs only ones between components, verified where they meet. Only
links that join components become rows, so no link between components is lost and no
group's pairs are listed.

Every row has a key of its own, and all of the above is on keys. Empty texts have no
shingles and no links. A null doc_id counts as the smallest id. Rows that share a doc_id
are one document: each row's text has its links, edges between the rows add them up, and
each row is returned. ``first_rows`` goes by texts alone. An empty table gives no rows;
other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, built_once, chunks, group_starts, mapped, read_table, sorted_groups
from gleanery.llm.components import Forest, connected_components
from gleanery.operators.gather import rows_at

SHINGLE, SIMILAR = 5, 75  # words; percent
PLACES, BANDS, BAND_ROWS = 1 << 22, 32, 4
COORDINATES = BANDS * BAND_ROWS
SLACK = 5  # deviations of a sketch's estimate
BLOCK = 512  # members of a bucket that meet in one group
LOWEST = -(1 << 63)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of each text's words."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in unique), np.uint64, len(unique))
    empty = pc.equal(pc.binary_length(pc.ascii_trim_whitespace(texts)), 0).to_numpy(zero_copy_only=False)
    words = hashes[coded.indices.to_numpy()]
    if empty.any():  # an empty text splits into one empty word
        words = words[np.repeat(~empty, sizes)]
        sizes = np.where(empty, 0, sizes)
    return words, sizes


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of one text's word hashes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(SHINGLE, len(words))
    last = len(words) - width + 1
    run = np.full(last, width, np.uint64)
    for i in range(width):
        run = mixed(run * MIX + words[i:last + i])
    return np.unique(run)


def sequence_key(words: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh128_digest(words.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class Circulant:
    """The two permutations; the second as windows of consecutive values."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.spread = rng.permutation(PLACES).astype(np.uint32)
        values = rng.permutation(PLACES).astype(np.uint32)
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:COORDINATES]]), COORDINATES)

    def signature(self, own: np.ndarray) -> np.ndarray:
        at = self.spread[own & np.uint64(PLACES - 1)]
        least = self.windows[at[:2048]].min(axis=0)
        for first in range(2048, len(at), 2048):
            least = np.minimum(least, self.windows[at[first:first + 2048]].min(axis=0))
        return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(BAND_ROWS):
        key = mixed(key * MIX + parts[:, :, i])
    return key.view(np.int64)


SIGNED = "id bigint, doc bigint, k1 bigint, k2 bigint, n bigint, bands array<bigint>, sketch binary"


def signed_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """One row per row (id, doc, text); without shingles the bands are empty."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                circulant = built_once(seed, Circulant)
                words, sizes = word_hashes(part.column("text"))
                ends = np.cumsum(sizes)
                own = [words[e - s:e] for s, e in zip(sizes, ends)]
                keys = np.array([sequence_key(w) for w in own], np.int64).reshape(-1, 2)
                sets = [shingles(w) for w in own]
                full = [i for i, s in enumerate(sets) if len(s)]
                signatures = np.stack([circulant.signature(sets[i]) for i in full]) if full else np.zeros((0, COORDINATES), np.uint32)
                low = (signatures & 0xFF).astype(np.uint8)
                sketch: list[bytes | None] = [None] * len(sets)
                for i, row in zip(full, low):
                    sketch[i] = row.tobytes()
                cuts = np.zeros(len(sets) + 1, np.int32)
                cuts[np.array(full, np.int64) + 1] = BANDS
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("doc"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(cuts).astype(np.int32)), pa.array(band_keys(signatures).ravel())),
                    pa.array(sketch, pa.binary()),
                ], names=["id", "doc", "k1", "k2", "n", "bands", "sketch"])

    return mapped(docs, run, SIGNED)


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    joined = b"".join(array.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, COORDINATES)


def least_agreement() -> int:
    """Equal bytes that two sketches of similar sets have but for SLACK deviations."""
    share = SIMILAR / 100
    return int(COORDINATES * (share - SLACK * (share * (1 - share) / COORDINATES) ** 0.5))


def _alike(batches):
    for batch in batches:
        same = (_sketches(batch.column("sketch_a")) == _sketches(batch.column("sketch_b"))).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(same >= least_agreement()))


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and 100 * common >= SIMILAR * (len(x) + len(y) - common)


def _verified(batches):
    for batch in batches:
        for part in chunks(batch, "text_a", 1 << 20):
            sets: dict[int, np.ndarray] = {}
            for side in "ab":
                ids = part.column(side).to_pylist()
                first = {i: row for row, i in reversed(list(enumerate(ids))) if i not in sets}
                words, sizes = word_hashes(part.column(f"text_{side}").take(pa.array(list(first.values()), pa.int64())))
                ends = np.cumsum(sizes)
                sets.update({i: shingles(words[e - s:e]) for i, s, e in zip(first, sizes, ends)})
            keep = []
            for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                keep.append(_similar(sets[a], sets[b]))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified_pairs(pairs: DataFrame, signed: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of the different pairs (a, b) that are similar on their full shingle sets."""
    side = lambda s: signed.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = sized.where(f"100 * least(n_a, n_b) >= {SIMILAR} * greatest(n_a, n_b)").select("a", "b", "sketch_a", "sketch_b")
    close = scratch.keep(mapped(sized, _alike, "a bigint, b bigint"))
    wanted = close.select(F.explode(F.array("a", "b")).alias("id"))
    texts = scratch.keep(rows_at(docs, wanted, "id"))  # texts of candidates only
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    links = scratch.keep(mapped(close.join(left, "a").join(right, "b"), _verified, "a bigint, b bigint"))
    scratch.drop(close, texts)
    return links


GROUP = ["key", "rest", "block"]


def _met(table: pa.Table) -> Iterator[Iterator[tuple[int, np.ndarray]]]:
    """For each group of two sides: rows of the inner side with those of the outer side
    that are in other components and alike by size and sketch. Each pair is looked at in
    the first band it shares only."""
    sketches, bands = _sketches(table.column("sketch")), np.stack(table.column("bands").to_numpy())
    parts, sizes, key = (table.column(c).to_numpy() for c in ("component", "n", "key"))
    inner = table.column("inner").to_numpy().astype(bool)

    def pairs(first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
        x, y = np.flatnonzero(inner[first:last]) + first, np.flatnonzero(~inner[first:last]) + first
        for row in x:
            fit = y[(parts[y] != parts[row]) & (100 * np.minimum(sizes[y], sizes[row]) >= SIMILAR * np.maximum(sizes[y], sizes[row]))]
            fit = fit[(sketches[fit] == sketches[row]).sum(axis=1) >= least_agreement()]
            if len(fit):
                same = bands[fit] == bands[row]
                yield row, fit[bands[row][same.argmax(axis=1)] == key[row]]

    starts = group_starts(table, GROUP)
    for first, last in zip(starts, [*starts[1:], table.num_rows]):
        yield pairs(first, last)


def _meeting(batches):
    """Rows of groups that have someone to be compared with there."""
    for table in sorted_groups(batches, GROUP):
        wanted = np.zeros(table.num_rows, bool)
        for pairs in _met(table):
            for row, fit in pairs:
                wanted[fit] = True
                wanted[row] |= len(fit) > 0
        yield from table.filter(pa.array(wanted)).to_batches()


def _across(batches):
    """Verified links between components in groups of two sides. A pair is not looked at
    once the group's links so far have joined its components."""
    for table in sorted_groups(batches, GROUP):
        ids, parts = table.column("id").to_numpy(), table.column("component").to_numpy()
        sets: dict[int, np.ndarray] = {}

        def shingles_of(row: int, table=table, ids=ids, sets=sets) -> np.ndarray:
            if ids[row] not in sets:
                sets[ids[row]] = shingles(word_hashes(table.column("text").slice(row, 1).combine_chunks())[0])
            return sets[ids[row]]

        out = []
        for pairs in _met(table):
            forest = Forest()
            sets.clear()
            for row, fit in pairs:
                for other in fit:
                    a, b = int(parts[row]), int(parts[other])
                    if forest.find(a) != forest.find(b) and _similar(shingles_of(row), shingles_of(other)):
                        forest.join(a, b)
                        out.append((ids[row], ids[other]))
        made = np.array(out, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])


def links_across(banded: DataFrame, of: DataFrame, signed: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that join components, from buckets of three or more that span some."""
    placed = scratch.keep(banded.join(of.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")))
    per_part = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    buckets = scratch.keep(
        per_part.groupBy("key").agg(F.sum("c").alias("size"), F.max(F.struct("c", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1 AND size > 2")
        .select("key", F.col("most.component").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
                F.ceil((F.col("size") - F.col("most.c")) / BLOCK).cast("int").alias("rests"))
    )
    members = placed.join(buckets, "key")
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    outer = members.withColumn("block", hashed("blocks")).withColumn("rest", F.explode(upto("rests"))).withColumn("inner", F.lit(False))
    inner = members.where("component <> main").withColumn("rest", hashed("rests")).withColumn("block", F.explode(upto("blocks"))).withColumn("inner", F.lit(True))
    columns = (*GROUP, "inner", "id", "component")
    rows = outer.select(*columns).unionByName(inner.select(*columns)).join(signed, "id")
    grouped = lambda frame: frame.repartition(*GROUP).sortWithinPartitions(*GROUP)
    # sketches go to all groups of a bucket, texts only to those where they may match
    meeting = scratch.keep(mapped(grouped(rows), _meeting, rows.schema))
    few = rows_at(texts, meeting.select("id"), "id")
    return mapped(grouped(meeting.join(few, "id")), _across, "a bigint, b bigint")


def doc_key():
    """The document of a row; a null doc_id is the smallest."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("doc")


def row_key():
    """A key of its own for each row, to be kept in a table before it is used."""
    return F.monotonically_increasing_id().alias("id")


def folded_documents(in_class: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): edges that join the different texts of one document."""
    ends = in_class.groupBy("doc").agg(F.min("first").alias("a"), F.max("first").alias("b"))
    several = scratch.keep(ends.where("a < b").select("doc", "a"))
    return scratch.keep(in_class.join(several, "doc").where("first <> a").select("a", F.col("first").alias("b")).distinct())


def grouped_rows(texts: DataFrame, scratch: Scratch, fold: bool) -> DataFrame:
    """(id, doc, n, k1, k2, root) of a table of rows (id, doc, text): rows of one root are
    linked by their texts and, if ``fold``, by their documents."""
    all_signed = scratch.keep(signed_documents(texts))
    classes = scratch.keep(all_signed.where("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    in_class = scratch.keep(all_signed.join(classes, ["k1", "k2"], "left").select(
        "id", "doc", "n", "k1", "k2", F.when(F.col("n") > 0, F.coalesce("first", "id")).otherwise(F.col("id")).alias("first"), "bands", "sketch"))
    scratch.drop(all_signed)
    signed = in_class.where("n > 0 AND id = first").select("id", "n", "bands", "sketch")
    plain = texts.select("id", "text")

    exploded = signed.select("id", F.explode("bands").alias("key"))
    hubs = scratch.keep(exploded.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    banded = scratch.keep(exploded.join(hubs, "key").select("key", "id", "hub"))
    pairs = scratch.keep(banded.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    links = verified_pairs(pairs, signed, plain, scratch)
    if fold:
        links = links.unionByName(folded_documents(in_class, scratch))
    of = connected_components(links, scratch)
    # what joins components now leaves no further pair to try
    more = scratch.keep(links_across(banded.select("key", "id"), of, signed, plain, scratch))
    if not more.isEmpty():  # components so far stand for their links
        so_far = of.select(F.col("node").alias("a"), F.col("component").alias("b"))
        of = connected_components(more.unionByName(so_far), scratch)
    joined = in_class.drop("bands", "sketch").join(of.withColumnRenamed("node", "first"), "first", "left")
    return scratch.keep(joined.select("id", "doc", "n", "k1", "k2", F.coalesce("component", "first").alias("root")))


def first_rows(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The id of one row of each group of similar texts in a table of rows (id, doc, text):
    of the smallest doc, then the fewest shingles, then the smallest hash of its words."""
    rows = grouped_rows(texts, scratch, fold=False)
    return scratch.keep(rows.groupBy("root").agg(F.min(F.struct("doc", "n", "k1", "k2", "id")).alias("least")).select("least.id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    texts = scratch.keep(docs.select(row_key(), doc_key(), bounded()))
    rows = grouped_rows(texts, scratch, fold=True)
    scratch.drop(texts)
    least = scratch.keep(rows.groupBy("root").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    scratch.sweep(rows, least)
    component = F.coalesce("least", "doc")
    public = lambda c: F.when(c != LOWEST, c)
    return rows.join(least, "root", "left").select(
        public(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), public(component).alias("component_id"),
        (F.col("doc") == component).alias("kept"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
