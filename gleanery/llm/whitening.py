"""Whitening of embeddings by polarisation covariance (operator 13).

Entries become integers x = floor(1024 * c) + 100000, scaled entries beyond 2^62 stopping
there. With n vectors and sums S the centred value is y = n * x - S, an integer too. One
pass adds up the squares of y for every dimension and of y_i + y_j for every pair of
dimensions, exactly. As

    sum (y_i + y_j)^2 = sum y_i^2 + sum y_j^2 + 2 * sum y_i * y_j,

differences of these variances give every covariance as an exact fraction; only its
value, correctly rounded, goes to ``eigh``. The driver receives one row per pair of
dimensions, which does not grow with the vectors.

Four passes read the table: sizes, sums, squares, projection. Tasks stream batches and hold
one matrix of sums. The projected rows are a table, whose covariance (Spark's covar_pop, which
merges centred moments) gives the identity error.

Rows whose vector is null or holds null or non-finite entries are left out; all others are
in the fit, repeated rows and null ids too. A vector shorter than the longest reads as
zero beyond its end. Components whose variance is not above rounding (a share of 1e-12
of the largest) have no rows, so equal vectors, a single one, an empty table or vectors
without entries give none. Equal eigenvalues may take any basis of their space. The sign
makes a component's largest entry positive. A deviation beyond a bigint is null. Only the
columns ``vec_id`` and ``embedding`` (names are parameters) are read; others are not
carried.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, read_table, ship_package

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
FARTHEST = 2.0**62  # scaled entries stop there
LIMB, LIMBS = 40, 8  # bits of a limb, limbs of a sum of squares
NEGLIGIBLE = 1e-12  # of the largest eigenvalue
CELLS = 1 << 21  # values of a slice of rows that a task works on at a time


def is_finite(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def as_integers(vector: Column) -> Column:
    """floor(SCALE * c) + SHIFT of each entry."""
    scaled = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(FARTHEST)), F.lit(-FARTHEST))
    return F.transform(vector, lambda c: F.floor(scaled(c)) + F.lit(SHIFT).cast("bigint"))


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that are left."""
    left = vectors.where(is_finite(F.col(vector_col)))
    return left.select(F.col(id_col).alias("id"), as_integers(F.col(vector_col)).alias("x"))


def matrices(batch: pa.RecordBatch, dimensions: int):
    """(first row, matrix of x) of slices of a batch; short vectors are padded with the
    value of a zero entry."""
    lists = batch.column("x")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    ends = np.cumsum(sizes)
    step = max(1, CELLS // max(1, dimensions))
    for first in range(0, len(sizes), step):
        own = sizes[first:first + step]
        start = int(ends[first] - sizes[first])
        made = np.full((len(own), dimensions), SHIFT, np.int64)
        made[np.arange(dimensions) < own[:, None]] = values[start:int(ends[first + len(own) - 1])]
        yield first, made


@dataclass(frozen=True)
class Centre:
    """Number of vectors and the sums of each dimension."""

    n: int
    sums: tuple[int, ...]

    def of(self, x: np.ndarray) -> np.ndarray:
        """n * x - S: int64 where it fits, else Python integers."""
        means = [s // self.n for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, means)]
        ends = zip(x.max(axis=0).tolist(), x.min(axis=0).tolist(), means)
        far = max((max(high - m, m - low) for high, low, m in ends), default=0)
        if (far + 1) * self.n < 1 << 61:  # so do sums of two
            return (x - np.array(means, np.int64)) * self.n - np.array(rest, np.int64)
        return (x.astype(object) - np.array(means, object)) * self.n - np.array(rest, object)


def sums_of_squares(values: np.ndarray) -> list[int]:
    """Exact sums of the squares in each column, as Python integers."""
    if values.dtype == object:
        return [int(s) for s in (values * values).sum(axis=0)]
    largest = int(np.abs(values).max(initial=0))
    if largest * largest * max(1, len(values)) < 1 << 63:
        return [int(s) for s in (values * values).sum(axis=0)]
    parts, place = [], values  # three limbs of 21 bits, the last one signed
    for _ in range(2):
        parts.append(place & 0x1FFFFF)
        place = place >> 21
    parts.append(place)
    totals = [0] * values.shape[1]
    for i, a in enumerate(parts):
        for j, b in enumerate(parts[:i + 1]):
            by = (1 if i == j else 2) << (21 * (i + j))
            for first in range(0, len(values), 1 << 20):
                made = (a[first:first + (1 << 20)] * b[first:first + (1 << 20)]).sum(axis=0)
                totals = [t + by * int(s) for t, s in zip(totals, made)]
    return totals


def limbs(value: int) -> list[int]:
    return [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS)]


def centre(x: DataFrame) -> Centre:
    """n and S of all vectors (id, x)."""
    sized = x.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, dimensions = sized["n"], sized["d"] or 0

    def run(batches):
        totals = [0] * dimensions
        for batch in batches:
            for _, made in matrices(batch, dimensions):
                # halves keep the sums of a slice within 64 bits
                high, low = (made >> 32).sum(axis=0), (made & 0xFFFFFFFF).sum(axis=0)
                totals = [t + (int(h) << 32) + int(v) for t, h, v in zip(totals, high, low)]
        high, low = [t >> 32 for t in totals], [t & 0xFFFFFFFF for t in totals]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                                         names=["i", "high", "low"])

    if not n or not dimensions:
        return Centre(n, ())
    parts = x.select("x").mapInArrow(run, "i int, high bigint, low bigint").groupBy("i").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum("low").alias("low"))
    found = {row["i"]: (int(row["high"]) << 32) + row["low"] for row in parts.collect()}  # one row per dimension
    return Centre(n, tuple(found[i] for i in range(dimensions)))


def pair_squares(x: DataFrame, about: Centre) -> dict[tuple[int, int], int]:
    """Sums of y_i^2 as (i, i) and of (y_i + y_j)^2 as (i, j), i < j."""
    d = len(about.sums)

    def run(batches):
        totals = [[0] * (d - i) for i in range(d)]
        for batch in batches:
            for _, made in matrices(batch, d):
                y = about.of(made)
                for i in range(d):
                    sums = y[:, i:] + y[:, i:i + 1]
                    sums[:, 0] = y[:, i]
                    totals[i] = [t + s for t, s in zip(totals[i], sums_of_squares(sums))]
        for i in range(d):
            cut = [limbs(t) for t in totals[i]]
            columns = [pa.array([row[k] for row in cut], pa.int64()) for k in range(LIMBS)]
            yield pa.RecordBatch.from_arrays([pa.array([i] * (d - i), pa.int32()), pa.array(range(i, d), pa.int32()), *columns],
                                             names=["i", "j", *(f"q{k}" for k in range(LIMBS))])

    names = [f"q{k}" for k in range(LIMBS)]
    parts = x.select("x").mapInArrow(run, "i int, j int, " + ", ".join(f"{q} bigint" for q in names))
    rows = parts.groupBy("i", "j").agg(*[F.sum(q).alias(q) for q in names]).collect()  # one row per pair of dimensions
    return {(r["i"], r["j"]): sum(r[f"q{k}"] << (LIMB * k) for k in range(LIMBS)) for r in rows}


def covariance(about: Centre, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """V, each entry the double next to its exact value."""
    d = len(about.sums)
    scale = about.n**3  # y is n times the centred value, and the divisor is n
    made = np.zeros((d, d))
    for i in range(d):
        made[i, i] = float(Fraction(squares[i, i], scale))
        for j in range(i + 1, d):
            crossed = squares[i, j] - squares[i, i] - squares[j, j]
            made[i, j] = made[j, i] = float(Fraction(crossed, 2 * scale))
    return made


@dataclass(frozen=True)
class Whitening:
    """The fit: centre, axes (a unit eigenvector per row), their eigenvalues and shares."""

    about: Centre
    axes: np.ndarray
    values: np.ndarray
    shares: np.ndarray


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening:
    about = centre(x)
    if not about.sums:
        return Whitening(about, np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    v = covariance(about, pair_squares(x, about))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1].T
    kept = int((values > NEGLIGIBLE * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    axes = vectors[:min(kept, components)]
    largest = np.abs(axes).argmax(axis=1) if len(axes) else np.zeros(0, int)
    axes = axes * np.sign(axes[np.arange(len(axes)), largest])[:, None]
    return Whitening(about, axes, values[:len(axes)], values[:len(axes)] / np.trace(v) if len(axes) else np.zeros(0))


def project(x: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, w) with the whitened values of all components."""
    d, n = len(model.about.sums), model.about.n
    turned = (model.axes / np.sqrt(model.values)[:, None]).T / n if len(model.axes) else np.zeros((d, 0))

    def run(batches):
        for batch in batches:
            for first, made in matrices(batch, d):
                y = model.about.of(made)
                largest = max((abs(int(y.max())), abs(int(y.min()))), default=0) if y.size else 0
                if largest * largest * max(1, d) < 1 << 63:
                    deviations = (y * y).sum(axis=1).tolist()
                else:
                    exact = [sum(v * v for v in row) for row in y.tolist()]
                    deviations = [v if v < 1 << 63 else None for v in exact]
                w = y.astype(np.float64) @ turned
                cuts = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(first, len(w)), pa.array(deviations, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(w.ravel()))],
                    names=["id", "deviation", "w"])

    kind = x.schema["id"].dataType.simpleString()
    return x.mapInArrow(run, f"id {kind}, deviation bigint, w array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity."""
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    found = projected.agg(*[F.covar_pop(F.col("w")[a], F.col("w")[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error)."""
    ship_package(vectors.sparkSession)
    x = integer_vectors(vectors, id_col, vector_col)
    model = fit(x, components)
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.keep(project(x, model))
    found = len(model.axes)
    error = identity_error(rows, found) if found else 0.0
    shares = F.array(*[F.lit(float(s)) for s in model.shares]) if found else F.array().cast("array<double>")
    placed = rows.select(F.col("id").alias(id_col), "deviation", F.posexplode("w").alias("p", "whitened"))
    return placed.select(id_col, (F.col("p") + 1).cast("int").alias("component"), F.lit(model.about.n).cast("bigint").alias("n"), "deviation",
                         "whitened", F.get(shares, F.col("p")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
