"""Best-fit packing with dominance reduction (operator 2).

Only lengths matter to a packing, and there are at most ``capacity`` of them, so the plan
is made on counts per length: bounded, whatever the number of documents.

1. Dominance reduction after Martello and Toth. For each length j left, longest first, and
   the pieces that fit beside it, a small set that provably dominates every alternative is
   fixed for good: j alone if nothing fits; j with the largest partner if that fills the
   sequence, if no two pieces fit together, or if two fit, three never do and no two sum
   to more; j with two partners if these dominate every other choice. What is fixed
   leaves the instance; lengths without such a set are passed over, and the test is
   repeated on all that is left until it fixes nothing.
2. Best fit decreasing on the rest: each piece goes to the fullest sequence it fits in.

Both work on runs of equal pieces at a time. The plan is a short list of patterns
(lengths with multiplicities, times a number of sequences). A piece finds its place by
its rank among the pieces of its length: ranks are counts per block of rows plus a row
number in a block, so no length, however common, meets in one task.

Documents above ``capacity`` are cut into pieces of that length; the last may be shorter.
Null text is the empty text. Rows that repeat a ``doc_id`` are packed each on its own.
An empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, chunks, flatten, mapped, read_table, share_text
from gleanery.llm.word_tokens import SLICE_CHARS, word_ids

Pattern = tuple[tuple[int, int], ...]  # (length, copies) in order of place


class Remaining:
    """Counts per length with the lengths in order."""

    def __init__(self, counts: Mapping[int, int]):
        self.counts = {n: c for n, c in counts.items() if c}
        self.lengths = sorted(self.counts)

    def take(self, length: int, copies: int) -> None:
        self.counts[length] -= copies
        if not self.counts[length]:
            del self.counts[length]
            del self.lengths[bisect_left(self.lengths, length)]

    def largest(self, room: int, but: Mapping[int, int]) -> int | None:
        """The largest length within ``room`` when ``but`` are taken."""
        for i in range(bisect_right(self.lengths, room) - 1, -1, -1):
            n = self.lengths[i]
            if self.counts[n] > but.get(n, 0):
                return n
        return None

    def smallest(self, number: int, but: Mapping[int, int]) -> list[int]:
        """The ``number`` smallest pieces when ``but`` are taken; fewer if there are no more."""
        found: list[int] = []
        for n in self.lengths:
            found += [n] * min(self.counts[n] - but.get(n, 0), number - len(found))
            if len(found) == number:
                break
        return found

    def best_pair(self, room: int, but: Mapping[int, int]) -> tuple[int, int] | None:
        """The two pieces of the largest sum within ``room``, larger first."""
        best, low, high = None, 0, bisect_right(self.lengths, room) - 1
        left = lambda n: self.counts[n] - but.get(n, 0)
        while 0 <= low <= high:
            a, b = self.lengths[high], self.lengths[low]
            if not left(a) or a + b > room:
                high -= 1
                continue
            if left(b) > (a == b) and (best is None or a + b > sum(best)):
                best = (a, b)
            low += 1
        return best


def dominating_set(left: Remaining, j: int, capacity: int) -> tuple[int, ...] | None:
    """Partners of a piece of length ``j`` that dominate every other choice, or None."""
    room, but = capacity - j, {j: 1}
    one = left.largest(room, but)
    if one is None:
        return ()
    if one == room:
        return (one,)
    small = left.smallest(3, but)
    if len(small) < 2 or small[0] + small[1] > room:
        return (one,)
    if len(small) == 3 and sum(small) <= room:
        return None
    pair = left.best_pair(room, but)
    if pair is None or one >= sum(pair):
        return (one,)
    # The pair (one, other) covers any pair (x, y), x >= y, if no y can exceed ``other``.
    other = left.largest(room - one, {**but, one: but.get(one, 0) + 1})
    if other is not None and not _pair_above(left, other, room, but):
        return (one, other)
    return None


def _pair_above(left: Remaining, other: int, room: int, but: Mapping[int, int]) -> bool:
    """Whether two pieces both longer than ``other`` fit together."""
    above = []
    for n in left.lengths[bisect_right(left.lengths, other):]:
        above += [n] * min(left.counts[n] - but.get(n, 0), 2 - len(above))
        if len(above) == 2:
            return sum(above) <= room
    return False


def reduce_dominated(left: Remaining, capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets of all lengths until none has one; they leave ``left``. A set
    that dominates goes on doing so while its pieces last, so runs are fixed at once."""
    fixed, before = [], -1
    while before < len(fixed):
        before = len(fixed)
        for j in reversed(list(left.lengths)):
            while j in left.counts and (partners := dominating_set(left, j, capacity)) is not None:
                need: dict[int, int] = {}
                for n in (j, *partners):
                    need[n] = need.get(n, 0) + 1
                times = min(left.counts[n] // c for n, c in need.items())
                for n, c in need.items():
                    left.take(n, c * times)
                fixed.append((tuple(sorted(need.items(), reverse=True)), times))
    return fixed


def best_fit(left: Remaining, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing on runs of equal pieces."""
    groups: dict[int, list[tuple[Pattern, int]]] = {}  # free room -> sequences
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((pattern, times))

    for length in reversed(left.lengths):
        count = left.counts[length]
        placed = []
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, pattern, times = capacity, (), count
            else:
                room = rooms[at]
                pattern, times = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            each = room // length  # best fit goes on in the sequence it has begun to fill
            full = min(times, count // each)
            rest = 0 if full == times else count - full * each
            if full:
                placed.append((room - each * length, (*pattern, (length, each)), full))
                count -= full * each
            if rest and rest < each:
                placed.append((room - rest * length, (*pattern, (length, rest)), 1))
                count, full = 0, full + 1
            if pattern and times > full:
                put(room, pattern, times - full)
        for item in placed:
            put(*item)
    return [item for items in groups.values() for item in items]


def plan_packing(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns with the number of sequences that follow each; they hold every piece."""
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    left = Remaining(counts)
    return reduce_dominated(left, capacity) + best_fit(left, capacity)


class Places:
    """Where the piece of a rank within its length goes."""

    def __init__(self, plan: list[tuple[Pattern, int]]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        first_sequence = 0
        for pattern, times in plan:
            offset = 0
            for length, copies in pattern:
                rank = used.get(length, 0)
                by_length.setdefault(length, []).append((rank, first_sequence, copies, offset))
                used[length] = rank + copies * times
                offset += copies * length
            first_sequence += times
        self.by_length = {n: np.array(rows, np.int64).T for n, rows in by_length.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            ranks, sequences, copies, offsets = self.by_length[int(n)]
            row = np.searchsorted(ranks, rank[own], side="right") - 1
            within = rank[own] - ranks[row]
            sequence[own] = sequences[row] + within // copies[row]
            offset[own] = offsets[row] + within % copies[row] * n
        return sequence, offset


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of each document's ids, without the ids."""
    model = share_text(docs.sparkSession, tokenizer)

    def run(batches):
        encoder = word_ids(model.value)
        for batch in batches:
            for part in chunks(batch, limit=SLICE_CHARS):
                ids, counts = encoder.encode(part.column("text"))
                lengths = counts + 1
                ends = np.cumsum(lengths)
                flat = np.full(int(lengths.sum()), end_id, "<u4")
                flat[flatten(ends - lengths, counts)] = ids
                pieces = -(-lengths // capacity)
                of = np.repeat(np.arange(len(lengths)), pieces)
                number = flatten(np.zeros(len(pieces), np.int64), pieces)
                size = np.minimum(lengths[of] - number * capacity, capacity)
                begin = (ends - lengths)[of] + number * capacity
                sums = [zlib.crc32(flat[a:a + n].tobytes()) for a, n in zip(begin.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(of)), pa.array(number, pa.int32()), pa.array(number * capacity),
                    pa.array(size), pa.array(sums, pa.int64()),
                ], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), bounded())
    return mapped(texts, run, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int, scratch: Scratch) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length``."""
    kept = scratch.keep(pieces.withColumn("block", F.spark_partition_id()))
    per_block = scratch.keep(kept.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    places = scratch.spark.sparkContext.broadcast(Places(plan_packing(counts, capacity)))
    before = per_block.select(
        "block", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before")
    )
    within = F.row_number().over(Window.partitionBy("block", "length").orderBy("doc_id", "piece")) - 1
    ranked = kept.withColumn("within", within).join(before, ["block", "length"])
    columns = pieces.columns
    ranked = ranked.select(*columns, (F.col("before") + F.col("within")).alias("rank"))

    def run(batches):
        for batch in batches:
            sequence, offset = places.value.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in columns), pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id bigint, offset bigint"])
    return mapped(ranked, run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    return pack_pieces(cut_documents(docs, tokenizer, end_id, capacity), capacity, Scratch(docs.sparkSession))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
