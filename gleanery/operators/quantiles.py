"""Exact percentiles of a histogram too large for one task.

Each pass counts the rows of a score range in equal-width bins and keeps only the
bins that hold a wanted order statistic, until those bins hold few distinct scores.
The driver sees at most ``BINS`` counts per wanted range and pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096
FEW = 50_000


def _order_statistics(histogram: DataFrame, wanted: list[int], few: int) -> dict[int, float]:
    """Score of each 0-based rank in ``wanted``. ``pending`` ranges are half-open,
    but for the last one, as (lo, hi, rows below lo, ranks)."""
    found: dict[int, float] = {}
    first = histogram.agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    pending = [(first["lo"], math.nextafter(first["hi"], math.inf), 0, wanted)]
    while pending:
        lo, hi, below, ranks = pending.pop()
        part = histogram.where((F.col("score") >= F.lit(lo)) & (F.col("score") < F.lit(hi)))
        size = part.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        width = (hi - lo) / BINS
        if size <= few or width <= 0 or lo + width == lo:
            # Bounded by ``few``, or by the doubles inside one bin.
            at = below
            for row in part.groupBy("score").agg(F.sum("rows").alias("rows")).orderBy("score").collect():
                for rank in ranks:
                    if at <= rank < at + row["rows"]:
                        found[rank] = row["score"]
                at += row["rows"]
            continue
        cell = F.least(F.floor((F.col("score") - F.lit(lo)) / F.lit(width)), F.lit(BINS - 1))
        bins = (
            part.groupBy(cell.alias("cell"))
            .agg(F.sum("rows").alias("rows"), F.min("score").alias("lo"), F.max("score").alias("hi"))
            .orderBy("cell").collect()
        )
        at = below
        for row in bins:
            inside = [rank for rank in ranks if at <= rank < at + row["rows"]]
            if inside:
                pending.append((row["lo"], math.nextafter(row["hi"], math.inf), at, inside))
            at += row["rows"]
    return found


def exact_percentiles(
    histogram: DataFrame, fractions: Sequence[float], few: int = FEW
) -> list[float | None]:
    """Linearly interpolated percentiles of ``(score, rows)``."""
    total = histogram.agg(F.sum("rows").alias("n")).first()["n"] or 0
    if total == 0:
        return [None] * len(fractions)
    places = [(total - 1) * fraction for fraction in fractions]
    wanted = sorted({rank for place in places for rank in (math.floor(place), math.ceil(place))})
    at = _order_statistics(histogram, wanted, few)
    values = []
    for place in places:
        low, high = math.floor(place), math.ceil(place)
        values.append(at[low] + (at[high] - at[low]) * (place - low))
    return values
