import logging

import numpy as np
import pytest

from gleanery.operators.quantiles import exact_percentiles
from gleanery.operators.stats import (
    DISTRIBUTION, Profile, check_match_rate, match_rate, profile, score_distribution,
    score_histogram, selection_summary, weight_totals,
)
from tests.util import scored_frame


def expected(scores):
    values = np.array(scores)
    cuts = np.percentile(values, [10, 25, 50, 75, 90])
    return [values.mean(), np.median(values), values.std(), values.min(), values.max(), *cuts]


@pytest.mark.parametrize("bound", [1000, 10**9])
def test_distribution(spark, bound):
    scores = list(np.random.default_rng(1).random(500).round(2)) + [-0.5, 0.0]
    row = score_distribution(scored_frame(spark, scores), bound).first()
    assert [row[name] for name in DISTRIBUTION] == pytest.approx(expected(scores), abs=1e-12)


def test_distribution_of_constant_and_empty(spark):
    row = score_distribution(scored_frame(spark, [0.4] * 7)).first()
    assert row["std"] == pytest.approx(0, abs=1e-15) and row["median"] == 0.4
    for bound in (10, 10**9):
        empty = score_distribution(scored_frame(spark, [0.1]).limit(0), bound).first()
        assert all(empty[name] is None for name in DISTRIBUTION)


@pytest.mark.parametrize("few", [3, 1000])
def test_exact_percentiles_refine(spark, few):
    """Many rows share one score, the others crowd in a tiny range."""
    rng = np.random.default_rng(2)
    scores = [0.25] * 300 + list(1 + rng.random(400) * 1e-9) + [1e6, -3.0]
    histogram = score_histogram(scored_frame(spark, scores))
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert exact_percentiles(histogram, fractions, few) == pytest.approx(
        list(np.percentile(scores, [100 * f for f in fractions])), rel=1e-15)


def test_profile_and_totals(spark):
    scores = [0.5, -1.0, 0.0, 0.25, 0.25]
    scored = scored_frame(spark, scores)
    found = profile(scored)
    assert (found.rows, found.matched, found.eligible) == (5, 5, 3)
    assert (found.weight_sum, found.weight_max) == (1.0, 0.5)
    assert tuple(weight_totals(scored).first()) == (1.0, 3)
    assert tuple(match_rate(scored).first()) == (5, 5, 1.0)
    empty = profile(scored.limit(0))
    assert (empty.rows, empty.matched, empty.eligible, empty.match_rate) == (0, 0, 0, 0.0)
    assert tuple(match_rate(scored.limit(0)).first()) == (0, 0, 0.0)
    assert tuple(weight_totals(scored.limit(0)).first()) == (0.0, 0)


def test_nan_scores_weigh_nothing(spark):
    found = profile(scored_frame(spark, [float("nan"), 0.5]))
    assert (found.eligible, found.weight_sum, found.weight_max) == (1, 0.5, 0.5)


def test_summary(spark):
    assert tuple(selection_summary(scored_frame(spark, [1, 1]), 8).first()) == (8, 2, 0.25)
    assert tuple(selection_summary(scored_frame(spark, [1]).limit(0), 0).first()) == (0, 0, None)


class TestGate:
    def found(self, matched, rows=100):
        return Profile(rows, matched, matched, 1.0, 1.0)

    def test_low_rate_stops(self):
        with pytest.raises(ValueError, match="Only 10.0% of dataset IDs"):
            check_match_rate(self.found(10), 0.0)
        with pytest.raises(ValueError, match="Only 0.0%"):
            check_match_rate(self.found(0, 0), 0.0)

    def test_force_goes_on(self, caplog):
        with caplog.at_level(logging.WARNING):
            check_match_rate(self.found(10), 0.0, force=True)
        assert "Only 10.0%" in caplog.text

    def test_middle_rate_warns(self, caplog):
        with caplog.at_level(logging.WARNING):
            check_match_rate(self.found(50), 0.25)
        assert "50.0% of dataset IDs have annotations; the other 50 rows score 0.25" in caplog.text

    @pytest.mark.parametrize("matched", [90, 95, 100])
    def test_usual_rate_is_silent(self, caplog, matched):
        with caplog.at_level(logging.WARNING):
            check_match_rate(self.found(matched), 0.0)
        assert caplog.text == ""

    def test_bounds_are_exclusive(self, caplog):
        check_match_rate(self.found(20), 0.0)
