"""Operator 13: against plain arithmetic on Python integers and numpy's eigh."""

import math
from fractions import Fraction

import numpy as np
import pytest

from gleanery.llm.whitening import Centre, covariance, fit, integer_vectors, limbs, op13_whitening, pair_squares, sums_of_squares, whitened

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, n int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors):
    """Exact deviations, and V as doubles, of Python integers."""
    fine = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in fine), default=0)
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] + [100000] * (d - len(v)) for _, v in fine]
    n, sums = len(x), [sum(row[k] for row in x) for k in range(d)]
    y = [[n * row[k] - sums[k] for k in range(d)] for row in x]
    v = [[float(Fraction(sum(row[a] * row[b] for row in y), n**3)) for b in range(d)] for a in range(d)]
    return [i for i, _ in fine], [sum(c * c for c in row) for row in y], np.array(v), np.array(y, float) / max(n, 1)


def check(spark, vectors, expect_components):
    got = whitened(table(spark, vectors)).collect()
    ids, deviations, v, centred = brute(vectors)
    assert sorted((r.vec_id is not None, r.vec_id, r.component, r.deviation) for r in got) == sorted(
        (i is not None, i, c + 1, dev) for i, dev in zip(ids, deviations) for c in range(expect_components))
    values, axes = np.linalg.eigh(v)
    for r in got:
        c = len(values) - r.component
        assert r.n == len(ids) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        if ids.count(r.vec_id) == 1:
            w = centred[ids.index(r.vec_id)] @ axes[:, c] / math.sqrt(values[c])
            assert abs(r.whitened) == pytest.approx(abs(w), abs=1e-7)
    return got


class TestWhitening:
    def test_against_plain_arithmetic(self, spark):
        rng = np.random.default_rng(3)
        mix = rng.normal(size=(10, 10))
        vectors = [(i, [float(c) for c in rng.normal(size=10) @ mix + 5]) for i in range(150)]
        vectors += [(200, None), (201, [1.0, None] + [0.0] * 8), (202, [float("nan")] * 10), (203, [float("inf")] + [0.0] * 9)]
        vectors += [vectors[0], vectors[1]]  # repeated rows count twice
        got = check(spark, vectors, 8)
        by_axis = {}
        for r in got:
            by_axis.setdefault(r.component, []).append(r.whitened)
        w = np.array([by_axis[c + 1] for c in range(8)])
        assert abs(w.mean(axis=1)).max() < 1e-9

    def test_fewer_dimensions_than_components(self, spark):
        check(spark, [(i, [float(i % 7), float(i * i % 11), 3.0]) for i in range(40)], 2)  # the third is constant

    def test_short_vectors_read_as_zero_beyond_their_end(self, spark):
        check(spark, [(0, [1.0, 2.0]), (1, [3.0]), (2, []), (3, [0.5, -1.0])], 2)

    def test_nothing_to_whiten(self, spark):
        assert whitened(table(spark, [])).collect() == []
        assert whitened(table(spark, [(1, None), (2, [None])])).collect() == []
        assert whitened(table(spark, [(1, [1.0, 2.0])])).collect() == []
        assert whitened(table(spark, [(1, [1.0]), (2, [1.0])])).collect() == []
        assert whitened(table(spark, [(1, []), (2, [])])).collect() == []

    def test_null_ids_stay(self, spark):
        got = whitened(table(spark, [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (5, [2.0, 2.0])])).collect()
        assert sum(r.vec_id is None for r in got) == 4 and len(got) == 6

    def test_entries_beyond_64_bits(self, spark):
        got = whitened(table(spark, [(0, [3e38, 1.0]), (1, [-3e38, 2.0]), (2, [0.0, 3.0])])).collect()
        assert len(got) == 3 and all(r.deviation is None for r in got if r.vec_id != 2) and got[0].identity_error < 1e-4

    def test_double_vectors_and_other_names(self, spark):
        rows = spark.createDataFrame([(str(i), [i / 3.0, i % 4 * 1.0]) for i in range(9)], "key string, vec array<double>")
        got = whitened(rows, components=1, id_col="key", vector_col="vec").collect()
        assert {r.key for r in got} == {str(i) for i in range(9)} and {r.component for r in got} == {1}


class TestExactSums:
    def test_squares_are_exact_at_every_size(self):
        rng = np.random.default_rng(4)
        for top in (10, 1 << 31, 1 << 40, (1 << 62) - 1):
            values = rng.integers(-top, top, size=(50, 3))
            assert sums_of_squares(values) == [sum(int(v) ** 2 for v in values[:, k]) for k in range(3)]

    def test_limbs_add_up(self):
        value = 123456789**20
        assert sum(part << (40 * k) for k, part in enumerate(limbs(value % (1 << 300)))) == value % (1 << 300)

    def test_pairs_recover_covariances(self, spark):
        vectors = [(i, [i * 0.1, (i * 7 % 13) * 0.5, float(i % 3)]) for i in range(30)]
        x = integer_vectors(table(spark, vectors))
        about = fit(x).about
        assert isinstance(about, Centre) and about.n == 30
        assert covariance(about, pair_squares(x, about)).tolist() == brute(vectors)[2].tolist()

    def test_query(self, spark):
        got = op13_whitening(spark, "/root/testdata/sf0.001")
        assert got.count() == 500 * 8
