"""The prefix trie of rebuilt conversations, with subtree totals by time-forward processing
(operator 12).

Conversations are ordered by turn (null first; rows of one turn by a hash of role and
text). Conversation c is rebuilt from the first h turns of conversation c - c % 5 and its
own turns after its first h, h = crc32(c) % 9. Nodes are the distinct sequences of first
turns; they are told apart by their depth and two 62-bit sums of hashes of (turn, depth).

A node is named by its smallest member, ``rep``, and its depth. Along a conversation
members only get fewer, so what c is the smallest member of is one path down to c's last
turn, whose top hangs on a node of a smaller conversation. That gives every parent without
a join of nodes with nodes.

Totals of subtrees (leaves, saved bytes) go up in reverse level order. The *weight* of a
node, the turns that its members still have, bounds its subtree and falls along every
path. Nodes above a weight of 1/4096 of all turns are *heavy*, at most 4096 a level.

1. Subtrees of light nodes under heavy ones are dealt out whole; each task sorts its nodes
   by falling depth and hands totals to parents through a priority queue, which spills
   sorted runs. Shard roots report to their heavy parent, summed before the shuffle.
2. Heavy nodes are cut into pieces by bands of levels. Pieces are summed the same way, then
   the roots of pieces in one small pass (they are at most 1/65536 of the turns, or a few),
   then the pieces again with what the pieces below them have reported.

Rows without conv_id belong to no conversation and are left out. Null role or text is
empty; repeated rows are turns of their own. A conversation with very many turns is spread
by ranges of turns. The hash over a node's ending members must take them one after another:
ranges of members are joined to texts first, so the task of a node reads pieces of text.
An empty table has no nodes. Texts are hashed and measured whole; they are not carried,
nor are other columns.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, read_table
from gleanery.llm.running import MASK, running_sums

FAMILY, CYCLE = 5, 9  # conversations that share a start, bound of the turns shared
LIGHT_SHARE, LIGHT_LEAST = 12, 256  # light: up to 2^-12 of all turns, or 256
BAND_SHARE, BAND_LEAST = 16, 256  # levels of a band
QUEUE = 1 << 18  # messages that a queue holds in memory
TEXT_PIECE = 1 << 20  # characters of joined ids in a row


class SpillingQueue:
    """A priority queue of (level, rep, children, leaves, saved). What exceeds ``limit``
    goes to a sorted run in an unnamed file of the task, gone with it; runs are merged as
    they are read."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.heap.sort()
        merged: list[list] = []
        for entry in self.heap:
            if merged and merged[-1][0] == entry[0] and merged[-1][1] == entry[1]:
                merged[-1][2:] = [a + b for a, b in zip(merged[-1][2:], entry[2:])]
            else:
                merged.append(list(entry))
        for first in range(0, len(merged), 4096):
            pickle.dump([tuple(e) for e in merged[first:first + 4096]], file)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, run))

    def take(self, level: int, rep: int) -> tuple[int, int, int]:
        """Sums of all messages to a node; nodes must be asked for in order."""
        children = leaves = saved = 0
        while self.heap and self.heap[0][0] == level and self.heap[0][1] == rep:
            _, _, c, n, s = heapq.heappop(self.heap)
            children, leaves, saved = children + c, leaves + n, saved + s
        while self.heads and self.heads[0][0][0] == level and self.heads[0][0][1] == rep:
            (_, _, c, n, s), run = heapq.heappop(self.heads)
            children, leaves, saved = children + c, leaves + n, saved + s
            self._advance(run)
        return children, leaves, saved


SUMMED = "rep bigint, depth bigint, parent_rep bigint, n_convs bigint, inside boolean, n_children bigint, n_leaves bigint, saved bigint"


def time_forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Totals of nodes that come by falling depth, then rep. A node starts with its own
    ``n_children``, ``n_leaves`` and ``saved``; what ``inside`` holds for reports to its
    parent, which follows in the same partition."""
    queue = SpillingQueue(limit)
    for batch in batches:
        reps, depths, parents, inside, *own = (
            batch.column(c).to_pylist() for c in ("rep", "depth", "parent_rep", "inside", "n_children", "n_leaves", "saved"))
        children, leaves, saved = own
        for row, (rep, depth) in enumerate(zip(reps, depths)):
            c, n, s = queue.take(-depth, rep)
            children[row] += c
            leaves[row] += n
            saved[row] += s
            if inside[row]:
                queue.push((1 - depth, parents[row], 1, leaves[row], saved[row]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("rep", "depth", "parent_rep", "n_convs", "inside")), *(pa.array(c, pa.int64()) for c in (children, leaves, saved))],
            names=["rep", "depth", "parent_rep", "n_convs", "inside", "n_children", "n_leaves", "saved"])


def summed(nodes: DataFrame, *shard: str) -> DataFrame:
    dealt = nodes.repartition(*shard).sortWithinPartitions(F.desc("depth"), "rep")
    return dealt.select("rep", "depth", "parent_rep", "n_convs", "inside", "n_children", "n_leaves", "saved").mapInArrow(time_forward, SUMMED)


def masked(*values) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit(MASK))


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, i, t1, t2, bytes): place, hashes of the content and size of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = scratch.keep(conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(FAMILY), text, role).alias("t2"),
        F.octet_length(text).cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("row"), F.lit(1).cast("bigint").alias("one")))
    return scratch.keep(running_sums(slim, "conv", ["turn", "t1", "t2", "row"], {"i": "one"}, scratch).select("conv", "i", "t1", "t2", "bytes"))


def rebuilt_sizes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, base, h, shared, size) of every conversation: the turns it replaces, those it
    gets instead, and its turns once rebuilt."""
    sizes = scratch.keep(turns.groupBy("conv").agg(F.max("i").alias("own")))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % CYCLE
    asked = sizes.select("conv", "own", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), h.alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    joined = asked.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("there", F.lit(0).cast("bigint"))))
    return scratch.keep(joined.select("conv", "base", "h", "shared", (F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")))


def prefixes(turns: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, depth, size, bytes, k1, k2): every first d turns of every rebuilt
    conversation, d from 1."""
    own = turns.join(sizes.select("conv", "h", "shared", "size"), "conv").where("i > h").select(
        "conv", (F.col("i") - F.col("h") + F.col("shared")).alias("depth"), "size", "bytes", "t1", "t2")
    start = turns.where(F.col("i") < CYCLE).withColumnRenamed("conv", "base")
    lent = sizes.where("shared > 0").join(start, "base").where("i <= shared").select("conv", F.col("i").alias("depth"), "size", "bytes", "t1", "t2")
    rebuilt = scratch.keep(own.unionByName(lent).select(
        "conv", "depth", "size", "bytes", masked("t1", "depth", "t2").alias("m1"), masked("t2", "t1", "depth").alias("m2")))
    return scratch.keep(running_sums(rebuilt, "conv", ["depth"], {"k1": "m1", "k2": "m2"}, scratch).select("conv", "depth", "size", "bytes", "k1", "k2"))


def placed_nodes(steps: DataFrame, sizes: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(conv, depth, size, rep, n_convs, weight, deepest, bytes): the node that every
    conversation passes at every depth, and the weight of the root."""
    facts = (F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("size") - F.col("depth") + 1).alias("weight"),
             F.max("size").alias("deepest"))
    key = ["depth", "k1", "k2"]
    nodes = scratch.keep(steps.groupBy(*key).agg(*facts))
    met = steps.join(nodes, key).select("conv", "depth", "size", "rep", "n_convs", "weight", "deepest", "bytes")
    top = sizes.select("conv", F.lit(0).cast("bigint").alias("depth"), "size")
    root = top.agg(*facts).first()
    if root["n_convs"] == 0:
        return scratch.keep(met), 0
    constant = [F.lit(root[c]).cast("bigint").alias(c) for c in ("rep", "n_convs", "weight", "deepest")]
    return scratch.keep(met.unionByName(top.select("conv", "depth", "size", *constant, F.lit(0).cast("bigint").alias("bytes")))), root["weight"]


def path_tops(placed: DataFrame, light: int, scratch: Scratch) -> DataFrame:
    """(conv, hangs_on, hangs_at, top_rep, top_depth): where a conversation's own path
    starts, as the last node of another one's, and its first light node."""
    other, low = F.col("rep") != F.col("conv"), F.col("weight") <= light
    found = placed.groupBy("conv").agg(
        F.max(F.when(other, F.struct("depth", "rep"))).alias("above"), F.min(F.when(low, F.struct("depth", "rep"))).alias("top"))
    return scratch.keep(found.select("conv", F.col("above.rep").alias("hangs_on"), F.col("above.depth").alias("hangs_at"),
                                     F.col("top.rep").alias("top_rep"), F.col("top.depth").alias("top_depth")))


def trie_nodes(placed: DataFrame, tops: DataFrame, light: int, scratch: Scratch) -> DataFrame:
    """One row per node, with its parent's rep, its own totals and, where it is light, the
    root of its light subtree."""
    own = placed.where("conv = rep").join(tops, "conv")
    above = F.when(F.col("depth") - 1 == F.col("hangs_at"), F.col("hangs_on")).otherwise(F.when(F.col("depth") > 0, F.col("rep")))
    return scratch.keep(own.select(
        "rep", "depth", above.alias("parent_rep"), "n_convs", (F.col("weight") <= light).alias("light"), "top_rep", "top_depth",
        F.lit(0).cast("bigint").alias("n_children"), (F.col("deepest") == F.col("depth")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))


def reports(done: DataFrame, of: str, at: Column) -> DataFrame:
    """Sums of what roots report, per parent, as (rep, depth, c, n, s)."""
    return done.groupBy(F.col(of).alias("rep"), at.alias("depth")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("n"), F.sum("saved").alias("s"))


def told(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Nodes with the messages added to their own totals."""
    plus = lambda column, name: (F.col(column) + F.coalesce(name, F.lit(0))).alias(column)
    kept = [c for c in nodes.columns if c not in ("n_children", "n_leaves", "saved")]
    return nodes.join(messages, ["rep", "depth"], "left").select(*kept, plus("n_children", "c"), plus("n_leaves", "n"), plus("saved", "s"))


def subtree_totals(nodes: DataFrame, placed: DataFrame, light: int, band: int, scratch: Scratch) -> DataFrame:
    """All nodes with the totals of their subtrees."""
    low = nodes.where("light").withColumn("inside", F.col("depth") > F.col("top_depth"))
    done = scratch.keep(summed(low, "top_rep", "top_depth"))
    from_light = reports(done.where("NOT inside AND depth > 0"), "parent_rep", F.col("depth") - 1)

    number = F.expr(f"depth div {band}")
    borders = placed.where((F.col("weight") > light) & (F.col("depth") % band == 0))
    roots = scratch.keep(borders.select("conv", number.alias("band"), F.col("rep").alias("piece")))  # the piece's root on each conversation
    high = nodes.where("NOT light").withColumn("band", number).join(roots.withColumnRenamed("conv", "rep"), ["rep", "band"])
    high = scratch.keep(told(high.withColumn("inside", F.col("depth") % band > 0), from_light).drop("light", "top_rep", "top_depth"))
    heads = summed(high, "piece", "band").where("NOT inside").withColumn("band", number)
    # the tree of the pieces' roots, a level per band: the parent is the root of the piece above
    above = roots.select(F.col("conv").alias("rep"), (F.col("band") + 1).alias("band"), F.col("piece").alias("above"))
    tree = heads.join(above, ["rep", "band"], "left").select(
        "rep", F.col("band").alias("depth"), F.col("above").alias("parent_rep"), "n_convs", (F.col("band") > 0).alias("inside"),
        F.lit(0).cast("bigint").alias("n_children"), "n_leaves", "saved", F.col("parent_rep").alias("under"))
    tree = scratch.keep(tree)
    whole = summed(tree, F.lit(0)).select("rep", "depth", "n_leaves", "saved")
    below = scratch.keep(tree.select("rep", "depth", "under").join(whole, ["rep", "depth"]).where("depth > 0"))
    from_heads = reports(below, "under", F.col("depth") * band - 1)
    return done.unionByName(summed(told(high, from_heads), "piece", "band"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, depth, first, ids, sha) of members sorted by node and number. Nodes that lie
    wholly in the partition get their hash; the first and the last, which may go on in
    another partition, and very long ones give pieces of text."""
    names = ["rep", "depth", "first", "ids", "sha"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    out: list[tuple] = []
    node, ids, size, pieces, opening = None, [], 0, True, True

    def close(whole: bool) -> None:
        if ids:
            text = ",".join(map(str, ids))
            out.append((*node, ids[0], None, hashlib.sha256(text.encode()).hexdigest()) if whole else (*node, ids[0], text, None))

    for batch in batches:
        for rep, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "conv"))):
            if (rep, depth) != node:
                close(not pieces)
                pieces, opening = opening, False
                node, ids, size = (rep, depth), [], 0
            ids.append(conv)
            size += 12
            if size > TEXT_PIECE:
                close(False)
                ids, size, pieces = [], 0, True
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
    close(False)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, depth, sha) of pieces of text sorted by node and first number."""
    node, sha, out = None, None, []
    for batch in batches:
        for rep, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "ids"))):
            if (rep, depth) == node:
                sha.update(b",")
            else:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = (rep, depth), hashlib.sha256()
            sha.update(ids.encode())
    if node is not None:
        out.append((*node, sha.hexdigest()))
    columns = list(zip(*out)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["rep", "depth", "sha"])


def end_hashes(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """(rep, depth, sha) of the nodes where conversations end."""
    ends = placed.where("depth = size").select("rep", "depth", "conv")
    ordered = ends.repartitionByRange("rep", "depth", "conv").sortWithinPartitions("rep", "depth", "conv")
    parts = scratch.keep(ordered.mapInArrow(_joined, "rep bigint, depth bigint, first bigint, ids string, sha string"))
    pieces = parts.where("sha IS NULL").repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first")
    whole = parts.where("sha IS NOT NULL").select("rep", "depth", "sha")
    return whole.unionByName(pieces.select("rep", "depth", "ids").mapInArrow(_hashed, "rep bigint, depth bigint, sha string"))


def prefix_trie(conversations: DataFrame, light_least: int = LIGHT_LEAST, band_least: int = BAND_LEAST) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)."""
    scratch = Scratch(conversations.sparkSession)
    turns = numbered_turns(conversations, scratch)
    sizes = rebuilt_sizes(turns, scratch)
    steps = prefixes(turns, sizes, scratch)
    placed, weight = placed_nodes(steps, sizes, scratch)
    scratch.drop(turns, steps)
    light, band = max(light_least, weight >> LIGHT_SHARE), max(band_least, weight >> BAND_SHARE)
    nodes = trie_nodes(placed, path_tops(placed, light, scratch), light, scratch)
    done = scratch.keep(subtree_totals(nodes, placed, light, band, scratch))
    ends = scratch.keep(end_hashes(placed, scratch))
    scratch.drop(placed, nodes)
    nobody = hashlib.sha256(b"").hexdigest()
    return done.join(ends, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent_rep").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(nobody)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))
