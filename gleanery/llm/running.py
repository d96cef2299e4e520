"""Running sums along sorted keys, a long key's rows spread over many tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from gleanery.llm.common import Scratch
from gleanery.runtime import small_frame

MASK = (1 << 62) - 1  # sums are modulo 2^62, so that two of them fit a bigint


def _sums_in_partition(columns: list[str], key: str, sums: dict[str, str]):
    def run(batches):
        part, place, last, held = TaskContext.get().partitionId(), 0, None, [np.uint64(0)] * len(sums)
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            keys = batch.column(key).to_numpy()
            change = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(change, size))
            made = []
            for i, name in enumerate(sums.values()):
                values = batch.column(name).to_numpy().view(np.uint64)
                total = np.cumsum(values, dtype=np.uint64)  # wraps, which the mask allows
                base = total[change] - values[change]
                if keys[0] == last:
                    base[0] -= held[i]
                total -= np.repeat(base, counts)
                held[i] = total[-1]
                made.append(pa.array((total & np.uint64(MASK)).view(np.int64)))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *made, pa.array(np.full(size, part, np.int32)), pa.array(np.arange(place, place + size))],
                names=[*columns, *sums, "_part", "_place"])
            place += size

    return run


def running_sums(df: DataFrame, key: str, order: list[str], sums: dict[str, str], scratch: Scratch) -> DataFrame:
    """``df`` (a table of ``scratch``) with columns ``{sum: of}``: sums over the rows of
    the bigint ``key`` up to and including this one in ``order``, modulo 2^62. ``order``
    should end in a column that no two rows of a key share, so that ranges can cut between
    any two. Ranges of rows are summed on their own; what a key has in earlier ranges, one
    number per range, is added afterwards."""
    schema = StructType(list(df.schema.fields))
    for name in sums:
        schema = schema.add(name, LongType())
    schema = schema.add("_part", IntegerType()).add("_place", LongType())
    ordered = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    within = scratch.keep(ordered.mapInArrow(_sums_in_partition(df.columns, key, sums), schema))
    names = list(sums)
    ends = within.groupBy("_part").agg(F.min(key).alias("first"), F.max_by(F.struct(key, *names), "_place").alias("last")).collect()  # a row per range
    carried: list[tuple] = []
    open_key, so_far = None, [0] * len(names)
    for row in sorted(ends, key=lambda r: r["_part"]):
        if row["first"] == open_key:
            carried.append((row["_part"], open_key, *so_far))
        last = [row["last"][name] for name in names]
        if not (row["first"] == open_key == row["last"][key]):
            so_far = [0] * len(names)
        open_key, so_far = row["last"][key], [(a + b) & MASK for a, b in zip(so_far, last)]
    if not carried:
        return within.drop("_part", "_place")
    columns = {c: [row[i] for row in carried] for i, c in enumerate(["_part", key, *(f"_carried_{n}" for n in names)])}
    together = within.join(small_frame(df.sparkSession, columns, 64), ["_part", key], "left")
    added = [(F.col(n) + F.coalesce(F.col(f"_carried_{n}"), F.lit(0))).bitwiseAND(F.lit(MASK)).alias(n) for n in names]
    return together.select(*df.columns, *added)
