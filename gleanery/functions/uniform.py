"""Hash uniforms: a draw depends only on (seed, key), never on which partition or
task evaluates it, so a lost executor or another cluster size changes nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(2**52)


def hash52(seed: int, *keys: Column | str | int) -> Column:
    """First 52 bits of ``md5("seed:key:...")`` as a bigint. String keys are
    literal tags, columns are data."""
    parts = [key.cast("string") if isinstance(key, Column) else F.lit(str(key)) for key in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(seed: int, *keys: Column | str | int) -> Column:
    """A double strictly inside (0, 1)."""
    return (hash52(seed, *keys).cast("double") + F.lit(0.5)) / F.lit(_SCALE)
