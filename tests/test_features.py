"""Key-routed gather, statistics on the way, long rules, sketches, positions, journal."""

import glob
import itertools
import math
import os
import random
import re

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from gleanery import ColumnScoring, ScoringConfig, curate, gather_positions
from gleanery.functions.scores import category_score, composite_score, looked_up
from gleanery.operators.gather import gather_by_key
from gleanery.operators.ranking import unique_position
from gleanery.operators.selection import Selection
from gleanery.operators.sketches import RANK_ERROR, approximate_distribution, merged_sketches, score_sketches
from gleanery.operators.stats import distribution_frame, profile, score_distribution
from gleanery.plans import job
from gleanery.runtime import PAYLOAD_ROWS
from gleanery.sinks import files, shards
from gleanery.sinks.shards import pending, write_shards
from tests.util import quality_rules, scored_frame, write_annotations, write_source

WR, WOR = "sample_with_replacement", "sample_without_replacement"


def plan_of(frame, mode="formatted"):
    explain = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return frame._jdf.queryExecution().explainString(explain.fromString(mode))


class TestKeys:
    def rows(self, spark):
        return spark.createDataFrame([(f"k{i % 7}", i, f"text {i}") for i in range(70)], "k string, i int, text string").repartition(5)

    def test_places_are_those_of_the_sorted_keys(self, spark):
        places, rows = unique_position(self.rows(spark).select("k", "i"), ["k", "i"], "at")
        got = sorted((r["k"], r["i"], r["at"]) for r in places.collect())
        assert rows == 70 and [r[2] for r in got] == list(range(70))

    @pytest.mark.parametrize("bad", [(None, 1), ("k1", 1)])
    def test_faults_are_found_by_the_sort(self, spark, bad):
        rows = self.rows(spark).select("k", "i").unionByName(spark.createDataFrame([bad], "k string, i int"))
        with pytest.raises(ValueError, match="NULL" if bad[0] is None else "not unique"):
            unique_position(rows, ["k", "i"])

    def test_the_sort_is_the_only_exchange(self, spark):
        keys = ["k", "i"]
        ordered = self.rows(spark).select(*keys).repartitionByRange(4, *keys).sortWithinPartitions(*keys)
        counted = ordered.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        plan = plan_of(counted)
        assert len(re.findall(r"\(\d+\) Exchange\n", plan)) == len(re.findall(r"\(\d+\) Sort\n", plan)) == 1

    @pytest.mark.parametrize("order", ["draw", "source"])
    @pytest.mark.parametrize("budget", [0, 1 << 20])
    def test_gather_by_two_keys(self, spark, order, budget):
        table = self.rows(spark)
        places, _ = unique_position(table.select("k", "i"), ["k", "i"], "source_pos")
        by_place = {r["source_pos"]: r["i"] for r in places.collect()}
        drawn = [5, 5, 69, 0, 5, 33, 33]
        rows = spark.createDataFrame([(p, n, 0.5) for n, p in enumerate(drawn)], "source_pos bigint, draw_pos bigint, score double")
        frame, count, total = gather_by_key(table, places, ["k", "i"], Selection(rows, 7, True, True), 3, order, budget)
        got = frame.select(F.spark_partition_id().alias("part"), "out_pos", "text").collect()
        expected = drawn if order == "draw" else sorted(drawn)
        assert (count, total) == (3, 7)
        assert [tuple(r) for r in got] == [(n // 3, n, f"text {by_place[p]}") for n, p in enumerate(expected)]

    def test_payload_is_shuffled_by_key_and_to_its_shard_only(self, spark):
        table = spark.range(5000).select(F.col("id").alias("k"), F.hex("id").alias("text"))
        places, _ = unique_position(table.select("k"), ["k"], "source_pos")
        rows = places.select("source_pos", F.lit(0.5).alias("score"))
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for budget, exchanges in ((0, 2), (1 << 30, 1)):
                frame, _, _ = gather_by_key(table, places, ["k"], Selection(rows, 5000, False, False), 100, "source", budget)
                nodes = re.findall(r"\(\d+\) (\w*Exchange)\n(?:Input|Output) \[\d+\]: \[([^\]]*)\]", plan_of(frame))
                assert [kind for kind, columns in nodes if "text#" in columns] == ["Exchange"] * exchanges
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    def test_draws_by_key_equal_draws_by_file(self, spark, tmp_path):
        source = write_source(tmp_path / "s", files=3, rows=40)
        notes = write_annotations(tmp_path / "a.parquet", [f"d{i:04d}" for i in range(120)], ["excellent"] * 60 + ["poor"] * 60)
        options = dict(n_samples=200, seed=3, spark=spark)
        by_file = curate(source, notes, WR, quality_rules(), **options).aligned().collect()
        frame = spark.read.parquet(f"{source}/data")
        by_key = curate(frame, notes, WR, quality_rules(), row_key="id", **options).aligned().collect()
        assert by_key == by_file and len(by_key) == 200

    @pytest.mark.parametrize("row_key, cap", [(None, None), ("id", None), (None, 1000)])
    def test_no_task_holds_all_of_a_large_selection(self, spark, tmp_path, row_key, cap):
        n = 2 * PAYLOAD_ROWS + 9
        source = write_source(tmp_path / "s", files=3, rows=60)
        notes = write_annotations(tmp_path / "a.parquet", [f"d{i:04d}" for i in range(180)], ["excellent"] * 180)
        frame = spark.read.parquet(f"{source}/data")
        with curate(frame, notes, WR, quality_rules(), n_samples=n, max_duplications=cap, row_key=row_key, spark=spark) as curated:
            for rows in (curated.aligned(), curated.aligned("source")):
                parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(
                    F.count(F.lit(1)).alias("rows"), F.min("out_pos").alias("low"), F.max("out_pos").alias("high"))
                assert sorted((r["part"], r["rows"], r["low"], r["high"]) for r in parts.collect()) == [
                    (0, PAYLOAD_ROWS, 0, PAYLOAD_ROWS - 1), (1, PAYLOAD_ROWS, PAYLOAD_ROWS, 2 * PAYLOAD_ROWS - 1),
                    (2, 9, 2 * PAYLOAD_ROWS, n - 1)]
            assert curated.data().rdd.getNumPartitions() == 3


class TestOnTheWay:
    @pytest.fixture(scope="class")
    @staticmethod
    def tables(tmp_path_factory):
        root = tmp_path_factory.mktemp("way")
        source = write_source(root / "source", files=3, rows=40)
        # the extremes are in annotations that match no row, or are not the last of their id
        ids = [f"d{i:04d}" for i in range(120)] + ["d0003", "other", "more"]
        labels = ["good", "adequate"] * 60 + ["good", "unacceptable", "excellent"]
        return source, write_annotations(root / "notes.parquet", ids, labels)

    def test_annotations_are_scanned_once(self, spark, tables):
        with curate(*tables, "threshold", quality_rules(normalize=True), spark=spark) as got:
            final = plan_of(got.scored, "simple").split("== Initial Plan ==")[0]
        assert final.count("notes.parquet") == 1

    @pytest.mark.parametrize("normalize", [True, False])
    def test_bounds_are_over_all_annotations(self, spark, tables, normalize):
        with curate(*tables, "threshold", quality_rules(normalize=normalize), threshold=0.5, spark=spark) as got:
            scores = {r["source_pos"]: r["score"] for r in got.scored.collect()}
        assert scores[0] == 0.75 and scores[1] == 0.4 and scores[3] == 0.75

    def test_constant_and_unmatched_scores(self, spark, tmp_path):
        source = write_source(tmp_path / "s", files=1, rows=4)
        constant = write_annotations(tmp_path / "a.parquet", ["d0000", "d0001", "d0002"], ["good"] * 3)
        rules = quality_rules(normalize=True, missing_id_score=0.1)
        with curate(source, constant, "threshold", rules, threshold=0.0, spark=spark) as got:
            assert sorted(r["score"] for r in got.scored.collect()) == [0.1, 0.75, 0.75, 0.75]
        strangers = write_annotations(tmp_path / "b.parquet", ["x", "y"], ["good", "poor"])
        with curate(source, strangers, "threshold", rules, threshold=0.0, force=True, spark=spark) as got:
            assert {r["score"] for r in got.scored.collect()} == {0.1}

    def test_statistics_equal_those_of_the_frames(self, spark, tables, tmp_path):
        result = job.run(spark, *tables, str(tmp_path / "out"), WR, n_samples=300, seed=5)
        with curate(*tables, WR, n_samples=300, seed=5, spark=spark) as got:
            assert got.totals.distribution is not None
            before, after = (score_distribution(f, None).first() for f in (got.scored, got.selection.rows))
        for name in before.asDict():
            assert result.before[name] == pytest.approx(before[name], abs=1e-12)
            assert result.provenance[name] == pytest.approx(after[name], abs=1e-12)

    def test_distribution_from_the_profile(self, spark):
        for scores in ([], [0.5], [0.1, 0.2, 0.2, 0.9, -1.0]):
            frame = scored_frame(spark, scores)
            made = distribution_frame(spark, profile(frame, 10).distribution).first()
            exact = score_distribution(frame, 10).first()
            assert made.asDict().keys() == exact.asDict().keys()
            assert all((a is None) == (b is None) and (a is None or math.isclose(a, b, abs_tol=1e-12)) for a, b in zip(made, exact))
        assert profile(frame, 1 << 30).distribution is None and profile(frame).distribution is None

    @pytest.mark.parametrize("aggregation", ["weighted_mean", "weighted_sum", "min", "product"])
    def test_bound_counts_folded_scores(self, aggregation):
        rng = random.Random(1)
        columns = {f"c{i}": ColumnScoring({f"l{j}": rng.choice([0.0, 0.25, 0.5, 1.0]) for j in range(5)}, weight=rng.choice([1.0, 2.0])) for i in range(5)}
        config = ScoringConfig(columns, aggregation)
        values = [sorted({*rule.category_scores.values(), rule.default_score}) for rule in columns.values()]
        folds = {"min": min, "product": math.prod}
        weights = [rule.weight for rule in columns.values()]
        fold = folds.get(aggregation, lambda scores: sum(s * w for s, w in zip(scores, weights)))
        assert config.score_combinations() == len({fold(p) for p in itertools.product(*values)}) + 1
        assert config.score_combinations(["c0", "absent"]) == len(values[0]) + 1


class TestAnnotationOrder:
    def test_last_row_of_the_files_wins(self, spark, tmp_path):
        source = write_source(tmp_path / "s", files=2, rows=2)
        folder = tmp_path / "notes"
        os.makedirs(folder)
        write_annotations(folder / "a.parquet", ["d0000", "d0001", "d0000"], ["poor", "good", "excellent"])
        write_annotations(folder / "b.parquet", ["d0001", "d0002", "d0003"], ["adequate", "poor", "poor"])
        frame = spark.read.parquet(str(folder)).withColumn("more", F.lit(1))
        for notes in (frame, str(folder)):
            with curate(source, notes, "threshold", quality_rules(), spark=spark) as got:
                assert [r["score"] for r in got.scored.orderBy("source_pos").collect()] == [1.0, 0.4, 0.1, 0.1]
        joined = frame.join(spark.createDataFrame([("d0000",)], "id string"), "id")  # rows of no file
        with pytest.raises(ValueError, match="annotation_order"):
            curate(source, joined, "threshold", quality_rules(), spark=spark)


class TestLongRules:
    def test_join_gives_what_the_map_gives(self, spark):
        rng = random.Random(2)
        rule = ColumnScoring({f"label {i}": rng.random() for i in range(400)}, default_score=0.3)
        labels = [f"label {rng.randrange(500)}" for _ in range(300)] + [None, "", "LABEL 1"]
        rows = spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "id int, c string").repartition(3)
        frame, score = looked_up(rows, "c", rule, rows.schema["c"].dataType)
        expected = rows.select("id", category_score("c", rule, rows.schema["c"].dataType).alias("s"))
        assert sorted(frame.select("id", score.alias("s")).collect()) == sorted(expected.collect())

    def test_long_and_short_columns_fold_together(self, spark):
        config = ScoringConfig({"a": ColumnScoring({i: i / 100 for i in range(100)}), "b": ColumnScoring({"x": 1.0}, weight=3.0)})
        rows = spark.createDataFrame([(7, "x"), (99, "y"), (None, None), (500, "x")], "a int, b string")
        for listed in (0, 50, 1000):
            frame, score = composite_score(rows, config, listed)
            got = sorted((r["a"] or 0, r["s"]) for r in frame.select("a", score.alias("s")).collect())
            assert got == [(0, 0.5), (7, pytest.approx(0.7675)), (99, pytest.approx(0.6225)), (500, 0.875)]
            plan = plan_of(frame.select(score))
            assert ("BroadcastHashJoin" in plan) == (listed < 100) and "SortMergeJoin" not in plan

    def test_repeated_label_is_refused(self, spark):
        rows = spark.createDataFrame([(1,)], "a int")
        with pytest.raises(ValueError, match="twice"):
            looked_up(rows, "a", ColumnScoring({1: 0.1, "1": 0.2}), rows.schema["a"].dataType)


class TestSketches:
    def test_ranks_keep_to_the_error_however_merged(self, spark):
        rng = random.Random(3)
        scores = [rng.gauss(0, 1) if rng.random() < 0.7 else 0.25 for _ in range(20_000)]
        frame = spark.createDataFrame([(i % 40, s) for i, s in enumerate(scores)], "part int, score double").repartition(8)
        parts = score_sketches(frame, "part")
        halves = merged_sketches(parts.withColumn("half", F.col("part") % 2), "half")
        ordered = sorted(scores)
        for sketches in (score_sketches(frame), merged_sketches(parts), merged_sketches(halves)):
            row = approximate_distribution(sketches).first()
            assert row["rows"] == 20_000 and (row["min"], row["max"]) == (ordered[0], ordered[-1])
            assert row["mean"] == pytest.approx(sum(scores) / 20_000)
            for p in (10, 25, 50, 75, 90):
                below, upto = sum(s < row[f"p{p}"] for s in scores), sum(s <= row[f"p{p}"] for s in scores)
                assert below / 20_000 <= p / 100 + RANK_ERROR and upto / 20_000 >= p / 100 - RANK_ERROR

    def test_sketches_are_small_and_of_each_group(self, spark):
        frame = spark.range(200_000).select((F.col("id") % 2).alias("part"), F.col("id").cast("double").alias("score"))
        parts = score_sketches(frame, "part").select("part", F.octet_length("sketch").alias("n")).collect()
        assert len(parts) == 2 and all(r["n"] < 64 << 10 for r in parts)

    def test_nothing_to_sketch(self, spark):
        for scores in ([], [None, None]):
            row = approximate_distribution(score_sketches(scored_frame(spark, scores))).first()
            assert row["rows"] == 0 and row["median"] is None and row["mean"] is None
        odd = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "score double")
        row = approximate_distribution(score_sketches(odd)).first()
        assert (row["rows"], row["p90"], row["max"]) == (1, 2.0, 2.0)


class TestOwnPositions:
    @pytest.fixture(scope="class")
    @staticmethod
    def source(tmp_path_factory):
        return write_source(tmp_path_factory.mktemp("positions"), files=3, rows=[5, 1, 6])

    def asked(self, spark, places, schema="source_pos bigint, place int"):
        return spark.createDataFrame([(p, n) for n, p in enumerate(places)], schema).repartition(3)

    def test_order_and_repeats(self, spark, source):
        places = [11, 0, 0, 5, 4, 11, 11]
        rows = gather_positions(source, self.asked(spark, places), "place", per_shard=3, spark=spark)
        got = rows.select(F.spark_partition_id(), "out_pos", "source_pos", "id").collect()
        assert [tuple(r) for r in got] == [(n // 3, n, p, f"d{p:04d}") for n, p in enumerate(places)]
        assert rows.columns == ["id", "messages", "source_pos", "out_pos"]
        plain = gather_positions(source, self.asked(spark, places), per_shard=3, spark=spark).collect()
        assert [r["source_pos"] for r in plain] == sorted(places)

    def test_unknown_positions_fail_before_any_row_is_read(self, spark, source):
        for bad in ([0, 12], [-1], [3, None]):
            with pytest.raises(IndexError):
                gather_positions(source, self.asked(spark, bad), spark=spark)

    def test_gaps_in_the_order(self, spark, source):
        for numbers in ([(1, 0), (2, 2)], [(1, 0), (2, 0)], [(1, None)], [(1, 1)]):
            with pytest.raises(ValueError, match="without gap"):
                gather_positions(source, spark.createDataFrame(numbers, "source_pos int, place int"), "place", spark=spark)

    def test_none_asked(self, spark, source):
        assert gather_positions(source, self.asked(spark, []), "place", spark=spark).collect() == []


class Killed(Exception):
    pass


class TestJournal:
    @pytest.fixture(scope="class")
    @staticmethod
    def tables(tmp_path_factory):
        root = tmp_path_factory.mktemp("journal")
        source = write_source(root / "source", files=3, rows=20)
        return source, write_annotations(root / "a.parquet", [f"d{i:04d}" for i in range(60)], ["excellent", "poor"] * 30)

    def kill_after(self, monkeypatch, steps):
        """The process dies at its n-th change of the output folder once shards are staged."""
        left = [steps]

        def counted(name):
            plain = getattr(files.Folder, name)

            def step(folder, *args):
                if left[0] == 0:
                    raise Killed
                left[0] -= 1
                return plain(folder, *args)

            return step

        for name in ("move", "remove", "write_text"):
            monkeypatch.setattr(files.Folder, name, counted(name))
        monkeypatch.setattr(shards, "_RENAME_THREADS", 1)

    def output(self, out):
        names = sorted(os.path.basename(p) for p in glob.glob(f"{out}/data/*.parquet"))
        return names, sorted(os.path.basename(p) for p in glob.glob(f"{out}/*"))

    def test_killed_at_every_step_and_resumed(self, spark, tables, tmp_path, monkeypatch):
        options = dict(n_samples=30, seed=2, overwrite=True)
        whole = job.run(spark, *tables, str(tmp_path / "whole"), WOR, **options)
        rows = spark.read.parquet(str(tmp_path / "whole" / "data")).collect()
        resumed = 0
        for steps in range(40):
            out = tmp_path / f"out{steps}"
            job.run(spark, *tables, str(out), WOR, n_samples=60, seed=9)  # three old shards to replace
            with monkeypatch.context() as patch:
                self.kill_after(patch, steps)
                try:
                    job.run(spark, *tables, str(out), WOR, **options)
                    break  # it needs no more steps than these
                except Killed:
                    pass
            sealed = pending(spark, str(out)) is not None
            with monkeypatch.context() as patch:
                if sealed:
                    patch.setattr(job, "curate", None)  # nothing is computed again
                result = job.run(spark, *tables, str(out), WOR, **options)
            resumed += sealed
            assert result == whole
            assert self.output(out) == (["train-00000-of-00002.parquet", "train-00001-of-00002.parquet"], ["README.md", "data"])
            assert spark.read.parquet(f"{out}/data").collect() == rows
        assert 6 <= resumed < steps < 39

    def test_other_options_finish_the_old_run_first(self, spark, tables, tmp_path, monkeypatch):
        out = str(tmp_path / "out")
        with monkeypatch.context() as patch:
            self.kill_after(patch, 3)
            with pytest.raises(Killed):
                job.run(spark, *tables, out, WOR, n_samples=30, seed=2)
        assert pending(spark, out) is not None
        with pytest.raises(FileExistsError):  # the old run is whole now
            job.run(spark, *tables, out, WOR, n_samples=10, seed=3)
        assert spark.read.parquet(f"{out}/data").count() == 30 and pending(spark, out) is None
        assert job.run(spark, *tables, out, WOR, n_samples=10, seed=3, overwrite=True).selected_rows == 10

    def test_plain_write(self, spark, tmp_path):
        out = str(tmp_path / "out")
        assert write_shards(spark.range(10).repartition(2), 2, out) == 2
        assert self.output(out) == (["train-00000-of-00002.parquet", "train-00001-of-00002.parquet"], ["data"])
        with pytest.raises(FileExistsError):
            write_shards(spark.range(1), 1, out)


def test_results_are_equal_by_what_was_selected():
    def result(name="a", seed=1, rows=3):
        return job.JobResult(1, 5, rows, Row(name=name, seed=seed), Row(mean=0.5), 0.6)

    assert result() == result(name="b") and hash(result()) == hash(result(name="b"))
    assert result() != result(seed=2) and result() != result(rows=4) and result() != "a"
