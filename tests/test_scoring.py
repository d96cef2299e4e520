"""Rules, label vocabulary and score computation."""

import logging

import pytest
import yaml
from pyspark.sql import functions as F

from gleanery import (
    ALL_PROPERTIES, CATEGORICAL_LABELS, DEFAULT_SCORING_CONFIG, NORM_SCORE_MAPS, ORDINAL_LABELS,
    SCORE_MAPS, ColumnScoring, ScoringConfig,
)
from gleanery.labels import label_dimension, ordinal_score, rescale
from gleanery.operators.lookup import attach_scores, compute_scores, hot_ids, latest_scores
from gleanery.rules import rules_frame
from tests.util import quality_rules


def two_rules(aggregation, safe=1.0):
    return ScoringConfig(
        {
            "content_quality": ColumnScoring({"good": 0.8}, weight=2.0),
            "content_safety": ColumnScoring({"safe": safe}, weight=3.0),
        },
        aggregation=aggregation, normalize=False,
    )


def scores_of(frame):
    return {row["id"]: row["score"] for row in frame.collect()}


@pytest.fixture(scope="module")
def one_row(spark):
    return spark.createDataFrame(
        [("a", "good", "safe")], "id string, content_quality string, content_safety string"
    )


def quality_frame(spark, labels):
    rows = [(chr(97 + i), label) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "id string, content_quality string")


class TestRules:
    def test_bundled(self):
        assert list(DEFAULT_SCORING_CONFIG.columns) == ["content_quality"]
        assert DEFAULT_SCORING_CONFIG.columns["content_quality"].default_score == 0.0
        rules = ScoringConfig.from_name("all_properties")
        assert len(rules.columns) == 7
        assert sum(rule.weight for rule in rules.columns.values()) == 16
        assert rules.columns["content_safety"].weight == 5

    def test_unknown_name(self):
        with pytest.raises(FileNotFoundError, match="No bundled config.*all_properties"):
            ScoringConfig.from_name("nonexistent")

    def test_file(self, tmp_path):
        path = tmp_path / "rules.yaml"
        path.write_text(yaml.dump({
            "aggregation": "min", "normalize": False, "missing_id_score": 0.5,
            "columns": {"content_quality": {
                "weight": 2.0, "default_score": 0.3, "category_scores": {"good": 0.9, "bad": 0.1}}},
        }))
        rules = ScoringConfig.resolve(str(path))
        assert (rules.aggregation, rules.normalize, rules.missing_id_score) == ("min", False, 0.5)
        rule = rules.columns["content_quality"]
        assert (rule.weight, rule.default_score) == (2.0, 0.3)
        assert rule.category_scores == {"good": 0.9, "bad": 0.1}

    def test_file_defaults(self):
        rules = ScoringConfig.from_dict({"columns": {"x": {"category_scores": {"a": 1}}}})
        assert (rules.aggregation, rules.missing_id_score, rules.normalize) == ("weighted_mean", 0.0, True)
        assert (rules.columns["x"].weight, rules.columns["x"].default_score) == (1.0, 0.5)

    def test_resolve(self):
        assert ScoringConfig.resolve(None) is DEFAULT_SCORING_CONFIG
        assert len(ScoringConfig.resolve("all_properties").columns) == 7

    @pytest.mark.parametrize("bad", [float("nan"), float("inf"), "1", None, True])
    def test_numbers_must_be_finite(self, bad):
        with pytest.raises(ValueError, match="finite"):
            ColumnScoring({"a": 1.0}, weight=bad)

    def test_unknown_aggregation(self):
        with pytest.raises(ValueError, match="Unknown aggregation: median"):
            two_rules("median")

    def test_rules_frame(self, spark):
        rows = rules_frame(spark, two_rules("min")).collect()
        assert [tuple(row) for row in rows] == [
            ("content_quality", "good", 0.8, 2.0, 0.5), ("content_safety", "safe", 1.0, 3.0, 0.5)]


class TestLabels:
    def test_counts(self, spark):
        assert len(ALL_PROPERTIES) == 18
        assert sum(map(len, ORDINAL_LABELS.values())) == 55
        assert {name: len(labels) for name, labels in CATEGORICAL_LABELS.items()} == {
            "content_type": 18, "business_sector": 37, "technical_content": 7, "regional_relevance": 14}

    def test_scores(self):
        assert SCORE_MAPS["audience_level"]["expert"] == 6.0
        assert SCORE_MAPS["pii_presence"] == {"no_pii": 2.0, "contains_pii": 1.0}
        assert list(NORM_SCORE_MAPS["content_quality"].values()) == [1.0, 0.75, 0.5, 0.25, 0.0]
        assert rescale({"a": 3.0, "b": 3.0}) == {"a": 1.0, "b": 1.0}

    def test_dimension(self, spark):
        labels = label_dimension(spark, ["ivory_coast", "none"])
        assert labels.count() == 55 + 76 + 2 + 1
        assert labels.where("kind != 'ordinal' AND score IS NOT NULL").count() == 0
        assert label_dimension(spark, ["x"]).where("property = 'country_relevance'").count() == 1

    def test_ordinal_score(self, spark):
        frame = quality_frame(spark, ["excellent", "poor", "other", None])
        got = frame.select(ordinal_score("content_quality", "content_quality"),
                           ordinal_score("content_quality", "content_quality", True)).collect()
        assert [tuple(row) for row in got] == [(5.0, 1.0), (2.0, 0.25), (None, None), (None, None)]


class TestScores:
    def test_maps_labels(self, spark):
        frame = quality_frame(spark, ["excellent", "good", "adequate", "poor", "unacceptable"])
        assert scores_of(compute_scores(frame, quality_rules())) == dict(zip("abcde", [1.0, 0.75, 0.4, 0.1, 0.0]))

    def test_default_for_unlisted_null_and_null_score(self, spark):
        rules = ScoringConfig({"content_quality": ColumnScoring({"good": 1.0, "bad": None}, default_score=0.3)}, normalize=False)
        frame = quality_frame(spark, ["good", "never_seen_before", None, "bad"])
        assert list(scores_of(compute_scores(frame, rules)).values()) == [1.0, 0.3, 0.3, 0.3]

    @pytest.mark.parametrize("how,safe,expected", [
        ("weighted_mean", 1.0, 0.92), ("weighted_sum", 1.0, 4.6), ("min", 1.0, 0.8), ("product", 0.5, 0.4)])
    def test_aggregations(self, one_row, how, safe, expected):
        assert scores_of(compute_scores(one_row, two_rules(how, safe)))["a"] == pytest.approx(expected, abs=1e-15)

    def test_normalises(self, spark):
        rules = ScoringConfig({"content_quality": ColumnScoring({"excellent": 1.0, "poor": 0.2, "good": 0.4})})
        frame = quality_frame(spark, ["excellent", "poor", "excellent", "good"])
        got = scores_of(compute_scores(frame, rules))
        assert (got["a"], got["b"]) == (1.0, 0.0) and got["d"] == pytest.approx(0.25)

    def test_constant_scores_stay_raw(self, spark):
        rules = ScoringConfig({"content_quality": ColumnScoring({"good": 0.4})})
        assert scores_of(compute_scores(quality_frame(spark, ["good", "good"]), rules)) == {"a": 0.4, "b": 0.4}

    def test_no_column_matches(self, one_row):
        with pytest.raises(ValueError, match="No annotation columns matched"):
            compute_scores(one_row, ScoringConfig({"nope": ColumnScoring({"x": 1.0})}))

    def test_skips_absent_columns(self, spark, caplog):
        with caplog.at_level(logging.WARNING):
            got = scores_of(compute_scores(quality_frame(spark, ["good"]), two_rules("weighted_mean")))
        assert got == {"a": 0.8} and "content_safety" in caplog.text

    def test_zero_weights(self, one_row):
        rules = ScoringConfig({"content_quality": ColumnScoring({"good": 1.0}, weight=0.0)})
        with pytest.raises(ValueError, match="sum to zero"):
            compute_scores(one_row, rules)

    def test_array_column(self, spark):
        frame = spark.createDataFrame([("a", ["x"])], "id string, tags array<string>")
        with pytest.raises(TypeError, match="single-value"):
            compute_scores(frame, ScoringConfig({"tags": ColumnScoring({"x": 1.0})}))

    def test_label_types(self, spark):
        frame = spark.createDataFrame([("a", 1), ("b", 0), ("c", 7)], "id string, flag int")
        rules = ScoringConfig({"flag": ColumnScoring({1: 0.9, 0: 0.2})}, normalize=False)
        assert scores_of(compute_scores(frame, rules)) == {"a": 0.9, "b": 0.2, "c": 0.5}
        with pytest.raises(TypeError, match="not a string"):
            compute_scores(quality_frame(spark, ["no"]), ScoringConfig({"content_quality": ColumnScoring({False: 1.0})}))

    def test_one_projection_no_python(self, one_row):
        plan = compute_scores(one_row, two_rules("weighted_mean"))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


class TestLookup:
    def test_last_annotation_wins_but_bounds_see_all(self, spark):
        rows = [("a", "excellent", 0), ("a", "poor", 1), ("b", "adequate", 2), ("b", "unacceptable", 3)]
        frame = spark.createDataFrame(rows, "id string, content_quality string, pos bigint").repartition(4)
        scores = compute_scores(frame, quality_rules(normalize=True), order_col="pos")
        assert scores_of(latest_scores(scores, "pos")) == {"a": 0.1, "b": 0.0}
        assert scores_of(latest_scores(scores)) == {"a": 1.0, "b": 0.4}

    @pytest.mark.parametrize("skewed", [None, [], ["hot"]])
    def test_attach(self, spark, skewed):
        ids = ["hot"] * 50 + ["a", "b", "lost", None, None]
        rows = spark.createDataFrame(list(enumerate(ids)), "source_pos bigint, id string")
        scores = spark.createDataFrame([("hot", 0.9), ("a", 0.2), ("b", 0.0), (None, 0.7)], "id string, score double")
        got = attach_scores(rows, scores, 0.4, skewed).orderBy("source_pos").collect()
        assert [row["source_pos"] for row in got] == list(range(55))
        assert [row["score"] for row in got] == [0.9] * 50 + [0.2, 0.0, 0.4, 0.4, 0.4]
        assert [row["matched"] for row in got] == [True] * 52 + [False] * 3

    def test_id_types_must_agree(self, spark):
        rows = spark.createDataFrame([(0, "1")], "source_pos bigint, id string")
        scores = spark.createDataFrame([(1, 0.5)], "id bigint, score double")
        with pytest.raises(TypeError, match="different types"):
            attach_scores(rows, scores, 0.0)

    def test_integer_widths_may_differ(self, spark):
        rows = spark.createDataFrame([(0, 1), (1, 2)], "source_pos bigint, id int")
        scores = spark.createDataFrame([(1, 0.5)], "id bigint, score double")
        got = attach_scores(rows, scores, 0.0).orderBy("source_pos").collect()
        assert [row["score"] for row in got] == [0.5, 0.0]

    def test_hot_ids(self, spark):
        rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("id"))
        assert hot_ids(rows, 3000) == [-1]
