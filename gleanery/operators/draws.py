"""Independent weighted draws with replacement: an inverse-CDF lookup as Spark joins.

Rows lie one after another, in position order, on a line of integer length; draw j is
a point on it. Positions are cut into blocks and blocks into cells of equal length, so
that a cell holds a bounded number of rows *and* of expected draws: a row with a third
of all weight covers many cells, and many tiny rows share a block, but no task gets
more than its share. Inside a cell one sort finds the row under each point.

Integer lengths make all sums exact and independent of partitioning. They distort the
probability p of a row by at most 2**-61 / p, relatively. Points come from 52-bit uniforms,
so a probability is exact to about 2**-52 / p.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.uniform import uniform
from gleanery.operators.stats import Profile, weight_column
from gleanery.runtime import BUCKET_ROWS, small_frame

MAX_BLOCKS = 65_536
BLOCK_BYTES = 96


def length_exponent(found: Profile) -> int:
    """Lengths are ``floor(w / max(w) * 2**exponent)``, summing to about 2**61. The
    rounding keeps the last bits of the weight sum from mattering."""
    return math.floor(61 - round(math.log2(found.weight_sum / found.weight_max), 6))


def draw_with_replacement(
    scored: DataFrame, n: int, seed: int, found: Profile, block_rows: int | None = None,
    cell_draws: int = BUCKET_ROWS,
) -> DataFrame:
    """``(source_pos, draw_pos, score)`` for ``n`` draws in draw order."""
    spark = scored.sparkSession
    block_rows = block_rows or max(BUCKET_ROWS, -(-found.rows // MAX_BLOCKS))
    share = weight_column() / F.lit(found.weight_max)
    length = F.floor(share * F.lit(float(2 ** length_exponent(found))))
    rows = scored.where(weight_column() > 0).select(
        "source_pos", "score",
        F.expr(f"source_pos div {block_rows}").alias("block"),
        F.greatest(length, F.lit(1)).cast("bigint").alias("length"),
    )

    blocks, total = [], 0
    for row in rows.groupBy("block").agg(F.sum("length").alias("length")).orderBy("block").collect():
        blocks.append((row["block"], total, total + row["length"]))
        total += row["length"]

    point = F.least(F.floor(uniform(seed, "draw", F.col("draw_pos")) * F.lit(float(total))), F.lit(total - 1))
    parts = max(spark.sparkContext.defaultParallelism, -(-n // (8 * BUCKET_ROWS)))
    points = spark.range(0, n, 1, parts).select(F.col("id").alias("draw_pos")).withColumn("x", point)
    if len(blocks) == 1:
        points = points.select("draw_pos", F.lit(blocks[0][0]).cast("bigint").alias("block"), F.col("x").alias("at"))
    else:
        # Which block holds x: equi-join on a coarse step of x, then compare. The
        # table has at most five rows per block.
        step = -(-total // (4 * len(blocks)))
        table = [
            (number, block, start, end)
            for block, start, end in blocks
            for number in range(start // step, (end - 1) // step + 1)
        ]
        columns = dict(zip(("_step", "block", "_start", "_end"), map(list, zip(*table))))
        starts = small_frame(spark, columns, BLOCK_BYTES)
        points = (
            points.withColumn("_step", F.expr(f"x div {step}"))
            .join(starts, "_step")
            .where((F.col("x") >= F.col("_start")) & (F.col("x") < F.col("_end")))
            .select("draw_pos", "block", (F.col("x") - F.col("_start")).alias("at"))
        )

    cell = max(1, total * cell_draws // n)
    up_to = Window.partitionBy("block").orderBy("source_pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = rows.withColumn("end", F.sum("length").over(up_to)).withColumn("at", F.col("end") - F.col("length"))
    spans = spans.select(
        "block", F.explode(F.expr(f"sequence(at div {cell}, (end - 1) div {cell})")).alias("cell"), "at",
        F.lit(0).alias("is_draw"), F.lit(None).cast("bigint").alias("draw_pos"),
        "source_pos", "score",
    )
    points = points.select(
        "block", F.expr(f"at div {cell}").alias("cell"), "at", F.lit(1).alias("is_draw"), "draw_pos",
        F.lit(None).cast("bigint").alias("source_pos"), F.lit(None).cast("double").alias("score"),
    )
    # A row starting at x covers x, so rows sort before draws at equal places.
    so_far = (
        Window.partitionBy("block", "cell").orderBy("at", "is_draw")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        spans.unionByName(points)
        .withColumns({name: F.last(name, ignorenulls=True).over(so_far) for name in ("source_pos", "score")})
        .where("is_draw = 1")
        .select("source_pos", "draw_pos", "score")
    )
