"""Weighted draws without replacement, and with replacement under a cap.

Each row is a Poisson process of rate w that stops after ``cap`` arrivals. In the
merged process every next arrival is a row drawn with probability proportional to w
among the rows below their cap: exactly "draw, redraw if at cap". So the first n
arrivals are the sample. Arrival k of a row comes at

    T_k = (E_1 + ... + E_k) / w,   E_j = -ln U(seed, row, j),

and cap = 1 is the exponential race for successive sampling without replacement.
One pass and no refill loop; past the first arrival of every row the work is proportional
to the candidates.
"""

from __future__ import annotations

import itertools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.uniform import uniform
from gleanery.operators.ranking import bucket_counts, n_smallest, position_by_bucket
from gleanery.operators.stats import Profile, weight_column
from gleanery.runtime import BUCKET_ROWS, held, release

# Up to this many draws one top-k task is cheaper than ranking by buckets.
TOP_K_ROWS = 100_000
# Below this many candidates every arrival is generated; above, only those before
# an estimated (and then verified) cut-off.
UNPRUNED_CANDIDATES = 1_000_000
# Arrivals generated from one array; longer runs are split into such chunks.
CHUNK = 256
# Up to this many arrivals per row are written out as columns, for generated code.
UNROLLED = 12


def _gap(seed: int, arrival: Column) -> Column:
    return -F.ln(uniform(seed, F.col("source_pos"), arrival))


def _running(first: Column, last: Column, seed: int) -> Column:
    """Running sums of the gaps ``first..last`` as an array."""
    gaps = F.transform(F.sequence(first, last), lambda k: _gap(seed, k))
    start = F.struct(F.lit(0.0).alias("at"), F.array().cast("array<double>").alias("seen"))
    return F.aggregate(
        gaps, start,
        lambda acc, gap: F.struct(
            (acc["at"] + gap).alias("at"), F.array_append(acc["seen"], acc["at"] + gap).alias("seen")
        ),
        lambda acc: acc["seen"],
    )


def arrivals(
    eligible: DataFrame, seed: int, cap: int, cutoff: float | None, weight_max: float, chunk: int = CHUNK
) -> DataFrame:
    """``(source_pos, score, copy, t, cut_short)`` for every arrival up to ``cap`` and
    ``cutoff``. ``cut_short`` marks a row whose generated arrivals might not have
    reached the cut-off (never seen in practice; the caller checks)."""
    weight = weight_column()
    if cap == 1:
        every = eligible.select(
            "source_pos", "score", F.lit(1).cast("bigint").alias("copy"),
            (_gap(seed, F.lit(1)) / weight).alias("t"), F.lit(False).alias("cut_short"),
        )
        return every if cutoff is None else every.where(F.col("t") <= F.lit(cutoff))

    def needed(mean):
        return mean + 12 * mean**0.5 + 40

    limit, most = F.lit(cap).cast("bigint"), cap
    if cutoff is not None:
        # A row whose first arrival is past the cut-off has none before it: the further
        # ones are generated for the others only, so the work follows the candidates.
        eligible = eligible.where(_gap(seed, F.lit(1)) / weight <= F.lit(cutoff))
        most = min(cap, math.ceil(needed(weight_max * cutoff)))
        mean = weight * F.lit(cutoff)
        limit = F.least(limit, F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("bigint"))
    if most <= UNROLLED:
        gaps = [f"_gap{k}" for k in range(1, most + 1)]
        sums = list(itertools.accumulate(map(F.col, gaps), operator.add))
        rows = eligible.withColumns({name: _gap(seed, F.lit(k)) for k, name in enumerate(gaps, 1)})
        every = rows.select("source_pos", "score", F.posexplode(F.array(*sums)).alias("_index", "_sum"))
        every = every.withColumns({
            "copy": (F.col("_index") + 1).cast("bigint"), "t": F.col("_sum") / weight,
            "cut_short": (F.col("_index") == most - 1) & F.lit(most < cap),
        })
        every = every if cutoff is None else every.where(F.col("t") <= F.lit(cutoff))
        return every.select("source_pos", "score", "copy", "t", "cut_short")

    rows = eligible.withColumn("_limit", limit)
    first = F.col("_chunk") * chunk + 1
    last = F.least(first + (chunk - 1), F.col("_limit"))
    few = rows if most <= chunk else rows.where(F.col("_limit") <= chunk)
    parts = few.withColumns({"_chunk": F.lit(0).cast("bigint"), "_base": F.lit(0.0)})
    if most > chunk:
        # A row with very many arrivals: sum each chunk on its own, add up the
        # sums of earlier chunks, then generate all chunks in parallel.
        pieces = (
            rows.where(F.col("_limit") > chunk)
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_limit") - 1) / chunk))))
            .repartition("source_pos", "_chunk")
            .withColumn("_sum", F.element_at(_running(first, last, seed), -1))
        )
        earlier = Window.partitionBy("source_pos").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        based = pieces.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)))
        parts = parts.unionByName(based.drop("_sum").repartition("source_pos", "_chunk"))

    every = parts.select(
        "source_pos", "score", "_chunk", "_base", "_limit",
        F.posexplode(_running(first, last, seed)).alias("_index", "_sum"),
    )
    copy = F.col("_chunk") * chunk + F.col("_index") + 1
    every = every.withColumns({"copy": copy, "t": (F.col("_base") + F.col("_sum")) / weight})
    if cutoff is None:
        every = every.withColumn("cut_short", F.lit(False))
    else:
        open_end = (F.col("copy") == F.col("_limit")) & (F.col("_limit") < cap)
        every = every.where(F.col("t") <= F.lit(cutoff)).withColumn("cut_short", open_end)
    return every.select("source_pos", "score", "copy", "t", "cut_short")


def estimate_cutoff(eligible: DataFrame, n: int, cap: int) -> float | None:
    """A time by which at least ``n`` arrivals are expected with a wide margin, or
    None if only the full set is sure to hold them.

    Weights are binned by magnitude (a few hundred rows to the driver). A row with
    rate w has at least ``cap * (1 - exp(-w t / cap))`` expected arrivals: spread its
    arrivals over ``cap`` slots and count the slots used.
    """
    bins = (
        eligible.withColumn("_w", weight_column())
        .groupBy(F.floor(F.log2("_w") * 32).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("_w").alias("w"))
        .collect()
    )
    target = n + 8 * math.sqrt(n) + 64

    def expected(t: float) -> float:
        return sum(row["rows"] * cap * -math.expm1(-row["w"] * t / cap) for row in bins)

    high = target / max(sum(row["rows"] * row["w"] for row in bins), 1e-300)
    for _ in range(1100):
        if expected(high) >= target:
            break
        high *= 2
    else:
        return None
    low = high / 2
    for _ in range(30):
        middle = (low + high) / 2
        low, high = (low, middle) if expected(middle) >= target else (middle, high)
    return high


def _log_bucket(n: int) -> Column:
    """Arrival times in equal steps of ln t. A row's arrival spreads over more than
    one nat, so steps of a small fraction of a nat stay balanced for any weights."""
    per_nat = max(1, -(-n // BUCKET_ROWS) * 4)
    return F.floor(F.ln("t") * per_nat)


def _cut(counts: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    kept = []
    for bucket, rows in counts:
        if n <= 0:
            break
        kept.append((bucket, min(rows, n)))
        n -= rows
    return kept


def race_draw(
    scored: DataFrame, n: int, seed: int, cap: int, found: Profile, reorder: bool,
    holding: list | None = None, unpruned: int = UNPRUNED_CANDIDATES, top_k: int = TOP_K_ROWS,
) -> DataFrame:
    """``(source_pos, draw_pos, score)``: the first ``n`` arrivals, ``n`` at most
    ``cap`` times the eligible rows. Draw order is arrival order or, with
    ``reorder``, a uniform shuffle. Frames kept for later jobs go to ``holding``."""
    eligible = scored.select("source_pos", "score").where(weight_column() > 0)
    capacity = cap * found.eligible
    by_time = [F.col("t"), F.col("source_pos"), F.col("copy")]
    shuffle = uniform(seed, "order", F.col("source_pos"), F.col("copy"))
    by_draw = [shuffle, *by_time[1:]] if reorder else by_time
    cutoff = None
    if capacity > max(unpruned, 4 * n):
        cutoff = estimate_cutoff(eligible, n, cap)

    if cutoff is None and n <= top_k:
        some = arrivals(eligible, seed, cap, None, found.weight_max)
        first = some if n >= capacity else some.orderBy(*by_time).limit(n)
        drawn = position_by_bucket(first, by_draw, F.lit(0), "draw_pos", counts=[(0, n)])
        return drawn.select("source_pos", "draw_pos", "score")

    bucket = _log_bucket(n)
    while True:
        some = arrivals(eligible, seed, cap, cutoff, found.weight_max)
        some = held(some, min(capacity, 4 * n))
        counts = bucket_counts(some, bucket)
        enough = cutoff is None or (
            sum(rows for _, rows in counts) >= n and not some.where("cut_short").head(1)
        )
        if enough:
            break
        release(some)
        cutoff = cutoff * 2 if cutoff < 1e300 else None
    if holding is not None:
        holding.append(some)
    first = n_smallest(some, n, by_time, bucket, counts)
    if reorder:
        parts = max(1, -(-n // BUCKET_ROWS))
        drawn = position_by_bucket(
            first, by_draw, F.floor(shuffle * parts), "draw_pos", [(0, n)] if parts == 1 else None
        )
    else:
        drawn = position_by_bucket(first, by_draw, bucket, "draw_pos", _cut(counts, n))
    return drawn.select("source_pos", "draw_pos", "score")
