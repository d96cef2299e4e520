"""The plan from tables to result, and the job on disk."""

import datetime
import glob
import logging
import os
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import yaml
from pyspark.sql import functions as F

from gleanery import ORDINAL_LABELS, ColumnScoring, ScoringConfig, curate
from gleanery.operators.lookup import compute_scores
from gleanery.operators.stats import score_distribution
from gleanery.plans.job import main, parser, run
from gleanery.sinks import rows_per_shard
from gleanery.sinks.card import CurationInfo, provenance, render_card
from gleanery.sinks.files import Folder
from tests.util import quality_rules, scored_frame, write_annotations, write_source

WOR, WR = "sample_without_replacement", "sample_with_replacement"


def ids_of(curated, order="draw"):
    return [row["id"] for row in curated.data(order).collect()]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """50 rows in 2 files, all annotated at random in seven properties."""
    root = tmp_path_factory.mktemp("tables")
    source = write_source(root / "source", rows=[30, 20])
    rng = np.random.default_rng(123)
    properties = list(ScoringConfig.from_name("all_properties").columns)
    labels = {name: rng.choice(ORDINAL_LABELS[name], 50).tolist() for name in properties}
    quality = labels.pop("content_quality")
    annotations = write_annotations(root / "ann.parquet", [f"d{i:04d}" for i in range(50)], quality, **labels)
    return source, annotations, quality


class TestCurate:
    def test_threshold(self, spark, tables):
        source, annotations, quality = tables
        curated = curate(source, annotations, "threshold", quality_rules(), threshold=0.5, spark=spark)
        expected = [f"d{i:04d}" for i, label in enumerate(quality) if label in ("excellent", "good")]
        assert ids_of(curated) == expected and 0 < len(expected) < 50
        assert curated.summary().first()["ratio"] == len(expected) / 50
        curated.close()

    def test_without_replacement(self, spark, tables):
        source, annotations, _ = tables
        ids = ids_of(curate(source, annotations, WOR, quality_rules(), n_samples=20, spark=spark))
        assert len(ids) == len(set(ids)) == 20

    def test_with_replacement(self, spark, tables):
        source, annotations, quality = tables
        ids = ids_of(curate(source, annotations, WR, quality_rules(), n_samples=200, spark=spark))
        assert len(ids) == 200 > len(set(ids))
        capped = ids_of(curate(source, annotations, WR, quality_rules(), n_samples=1000, max_duplications=3, spark=spark))
        assert set(Counter(capped).values()) == {3}
        assert all(quality[int(i[1:])] != "unacceptable" for i in ids + capped)

    def test_bad_arguments_fail_before_any_read(self, spark):
        with pytest.raises(ValueError, match="max_duplications"):
            curate("/nowhere", "/nowhere", WOR, max_duplications=2, spark=spark)
        with pytest.raises(ValueError, match="Unknown mode"):
            curate("/nowhere", "/nowhere", "best", spark=spark)

    def test_seven_properties_and_yaml(self, spark, tables, tmp_path):
        source, annotations, _ = tables
        path = tmp_path / "custom.yaml"
        path.write_text(yaml.dump({"columns": {
            "content_quality": {"category_scores": {"excellent": 1.0, "good": 0.75}},
            "content_safety": {"weight": 10.0, "default_score": 0.0, "category_scores": {"safe": 1.0, "mild_concerns": 0.5}},
        }}))
        for rules in (ScoringConfig.from_name("all_properties"), ScoringConfig.from_file(path)):
            curated = curate(source, annotations, "threshold", rules, spark=spark)
            assert 0 < len(ids_of(curated)) < 50
            row = curated.after().first()
            assert 0.5 <= row["min"] <= row["p10"] <= row["median"] == row["p50"] <= row["max"] == 1.0

    def test_columns_and_alignment(self, spark, tables):
        source, annotations, quality = tables
        curated = curate(source, annotations, WR, quality_rules(), n_samples=80, spark=spark)
        assert curated.data().schema == spark.read.parquet(f"{source}/data").schema
        rows = curated.aligned(per_shard=9).collect()
        assert [row["out_pos"] for row in rows] == list(range(80))
        assert all(row["id"] == f"d{row['source_pos']:04d}" for row in rows)
        assert all(row["score"] == {"excellent": 1, "good": 0.75, "adequate": 0.4, "poor": 0.1}[quality[row["source_pos"]]] for row in rows)
        assert [row["id"] for row in rows] == ids_of(curated)

    def test_seed(self, spark, tables):
        source, annotations, _ = tables
        def go(seed):
            return ids_of(curate(source, annotations, WOR, quality_rules(), n_samples=10, seed=seed, spark=spark))
        assert go(99) == go(99) != go(100)

    def test_filtered_input_keeps_source_positions(self, spark, tables):
        source, annotations, _ = tables
        part = spark.read.parquet(f"{source}/data").where("substring(id, 5, 1) IN ('3', '7')")
        rows = curate(part, annotations, WR, quality_rules(), n_samples=20, max_duplications=8).aligned().collect()
        assert len(rows) == 20 and {row["source_pos"] % 10 for row in rows} <= {3, 7}
        assert all(row["id"] == f"d{row['source_pos']:04d}" for row in rows)

    def test_frame_without_files(self, spark, tables):
        source, annotations, _ = tables
        frame = spark.createDataFrame(spark.read.parquet(f"{source}/data").collect()).repartition(3)
        with_key = curate(frame, annotations, WOR, quality_rules(), n_samples=15, row_key="id")
        placed = frame.withColumn("place", F.substring("id", 2, 4).cast("bigint"))
        with_position = curate(placed, annotations, WOR, quality_rules(), n_samples=15, position_col="place")
        from_files = curate(source, annotations, WOR, quality_rules(), n_samples=15, spark=spark)
        assert ids_of(with_key) == ids_of(with_position) == ids_of(from_files)

    def test_bad_frames(self, spark, tables):
        frame = spark.createDataFrame([("a", 1), ("a", 2)], "id string, out_pos int")
        with pytest.raises(ValueError, match="Rename.*out_pos"):
            curate(frame, tables[1], WOR, row_key="id")
        with pytest.raises(ValueError, match="not unique"):
            curate(frame.select("id"), tables[1], WOR, row_key="id")

    def test_empty_selection(self, spark, tables):
        source, annotations, _ = tables
        for mode, options in (("threshold", {"threshold": 2.0}), (WR, {"n_samples": 0}), (WOR, {"n_samples": 0})):
            curated = curate(source, annotations, mode, quality_rules(), spark=spark, **options)
            assert ids_of(curated) == [] and curated.summary().first()["selected_rows"] == 0
            assert curated.after().first()["mean"] is None

    def test_empty_dataset(self, spark, tables, tmp_path):
        _, annotations, _ = tables
        pq.write_table(pa.table({"id": pa.array([], pa.string())}), tmp_path / "x.parquet")
        source = str(tmp_path)
        with pytest.raises(ValueError, match="Only 0.0%"):
            curate(source, annotations, "threshold", spark=spark)
        for mode in ("threshold", WOR, WR):
            assert ids_of(curate(source, annotations, mode, force=True, spark=spark)) == []

    @pytest.mark.parametrize("skewed", [False, True])
    def test_duplicate_ids_on_both_sides(self, spark, tmp_path, monkeypatch, skewed):
        if skewed:
            monkeypatch.setattr(sys.modules["gleanery.plans.curate"], "HOT_CHECK_ROWS", 0)
        os.makedirs(tmp_path / "s")
        pq.write_table(pa.table({"id": ["a", "b", None, "a", "c"]}), tmp_path / "s" / "x.parquet")
        annotations = write_annotations(tmp_path / "a.parquet", ["a", "b", "a", None], ["poor", "good", "excellent", "good"])
        curated = curate(str(tmp_path / "s"), annotations, "threshold", quality_rules(missing_id_score=0.2), threshold=0.2, spark=spark)
        rows = [(row["source_pos"], row["score"]) for row in curated.aligned().collect()]
        assert rows == [(0, 1.0), (1, 0.75), (2, 0.2), (3, 1.0), (4, 0.2)]
        assert curated.totals.matched == 3
        assert curated.before().first()["mean"] == pytest.approx((1.0 + 0.75 + 0.2 + 1.0 + 0.2) / 5)

    def test_annotation_frame_with_order(self, spark, tables):
        source, _, _ = tables
        rows = [(f"d{i:04d}", label, turn) for i in range(50) for turn, label in ((1, "excellent"), (2, "poor" if i % 2 else "good"))]
        frame = spark.createDataFrame(rows, "id string, content_quality string, turn int").repartition(6)
        curated = curate(source, frame, "threshold", quality_rules(), annotation_order="turn", spark=spark)
        assert ids_of(curated) == [f"d{i:04d}" for i in range(0, 50, 2)]

    def test_annotation_folder(self, spark, tables, tmp_path):
        """Later files win over earlier ones."""
        source, _, _ = tables
        ids = [f"d{i:04d}" for i in range(50)]
        write_annotations(tmp_path / "part-1.parquet", ids, ["poor"] * 50)
        write_annotations(tmp_path / "part-0.parquet", ids, ["excellent"] * 50)
        curated = curate(source, str(tmp_path), "threshold", quality_rules(), spark=spark)
        assert ids_of(curated) == []

    @pytest.mark.parametrize("share,force,fails,warns", [
        (0.1, False, True, False), (0.1, True, False, True), (0.5, False, False, True), (0.95, False, False, False)])
    def test_match_rate(self, spark, tmp_path, caplog, share, force, fails, warns):
        source = write_source(tmp_path / "s", rows=[100])
        n = int(100 * share)
        annotations = write_annotations(tmp_path / "a.parquet", [f"d{i:04d}" for i in range(n)], ["excellent"] * n)
        def go():
            return curate(source, annotations, "threshold", quality_rules(), threshold=0.0, force=force, spark=spark)
        with caplog.at_level(logging.WARNING):
            if fails:
                with pytest.raises(ValueError, match="Only 10.0% of dataset IDs"):
                    go()
            else:
                assert len(ids_of(go())) == 100
        assert ("have annotations" in caplog.text) == warns


class TestPlan:
    def test_few_rows_read_few_files(self, spark, tmp_path):
        source = write_source(tmp_path / "many files", rows=[5] * 30)
        ids = [f"d{i:04d}" for i in range(150)]
        annotations = write_annotations(tmp_path / "a.parquet", ids, ["excellent"] * 150)
        for options in ({}, {"n_samples": 3}):
            curated = curate(source, annotations, WOR, quality_rules(), spark=spark, **options)
            rows = curated.aligned()
            assert all(row["id"] == f"d{row['source_pos']:04d}" for row in rows.collect())
            read = curated._payload()
            assert read.count() == (150 if not options else 5 * len({r["source_pos"] // 5 for r in rows.collect()}))
            scan = read._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
            assert options == {} or "file_path" in scan.toString()

    def test_slim_until_the_gather(self, spark, tables):
        source, annotations, _ = tables
        curated = curate(source, annotations, WOR, quality_rules(), n_samples=5, spark=spark)
        assert curated.scored.columns == ["source_pos", "score", "matched"]
        plan = curated.selection.rows._jdf.queryExecution().toString()
        assert "messages" not in plan.split("Optimized Logical Plan")[1] and "Python" not in plan

    def test_annotation_scan_is_pruned(self, spark, tables):
        from gleanery.sources import scan_annotations
        plan = scan_annotations(spark, tables[1], quality_rules())._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<id:string,content_quality:string,_tmp_metadata_row_index:bigint>" in plan


def written(out):
    files = sorted(glob.glob(f"{out}/data/*"))
    return [os.path.basename(name) for name in files], [row for name in files for row in pq.read_table(name)["id"].to_pylist()], files


class TestJob:
    @pytest.fixture(scope="class")
    @staticmethod
    def source(tmp_path_factory):
        root = tmp_path_factory.mktemp("job")
        source = write_source(root / "source", files=3, rows=40)
        annotations = write_annotations(
            root / "ann.parquet", [f"d{i:04d}" for i in range(120)],
            ["excellent"] * 60 + ["good"] * 40 + ["poor"] * 20)
        return source, annotations

    def go(self, spark, source, out, *extra, mode=WR):
        return main(["--dataset_path", source[0], "--annotations_path", source[1], "--output_dir", str(out),
                     "--mode", mode, *extra], spark)

    def test_both_orders(self, spark, source, tmp_path):
        options = ["--n_samples", "200", "--max_duplications", "3", "--seed", "7"]
        for writer in ("load", "stream"):
            result = self.go(spark, source, tmp_path / writer, *options, "--writer", writer)
            assert (result.shards, result.source_rows, result.selected_rows) == (5, 120, 200)
        names, load, files = written(tmp_path / "load")
        _, stream, more = written(tmp_path / "stream")
        assert names == [f"train-{i:05d}-of-00005.parquet" for i in range(5)]
        assert [pq.read_table(name).num_rows for name in files] == [40] * 5
        assert len(load) == 200 and Counter(load) == Counter(stream) and max(Counter(load).values()) <= 3
        assert stream == sorted(stream) and load != sorted(load)
        curated = curate(*source, WR, n_samples=200, seed=7, max_duplications=3, spark=spark)
        assert load == ids_of(curated)
        schema = pq.read_schema(glob.glob(f"{source[0]}/data/*")[0])
        for name in files + more:
            assert pq.read_schema(name).equals(schema, check_metadata=False)
            assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "SNAPPY"
        assert not glob.glob(f"{tmp_path}/load/_staging*")

    def test_card(self, spark, source, tmp_path):
        result = self.go(spark, source, tmp_path / "out", "--max_duplications", "3")
        text = (tmp_path / "out" / "README.md").read_text()
        assert "(n=120, max_duplications=3)" in text
        assert "120 (100.0%)" in text and "path: data/train-*" in text and "# out" in text
        assert result.provenance["selected_percent"] == 100.0
        assert f"{result.provenance['mean']:.3f}" in text

    def test_threshold_in_card(self, spark, source, tmp_path):
        self.go(spark, source, tmp_path / "out", "--threshold", "0.7", mode="threshold")
        assert "threshold >= 0.7" in (tmp_path / "out" / "README.md").read_text()
        assert written(tmp_path / "out")[1] == [f"d{i:04d}" for i in range(100)]

    def test_uneven_shards(self, spark, source, tmp_path):
        """100 rows in 3 files: 33 rows a shard make 4 shards."""
        uneven = write_source(tmp_path / "s", rows=[50, 30, 20])
        run(spark, uneven, source[1], str(tmp_path / "out"), "threshold", threshold=-1.0)
        names, ids, files = written(tmp_path / "out")
        assert [pq.read_table(name).num_rows for name in files] == [33, 33, 33, 1] and len(names) == 4
        assert ids == [f"d{i:04d}" for i in range(100)]
        assert rows_per_shard(2, 5) == 1 and rows_per_shard(0, 0) == 1

    def test_empty_selection(self, spark, source, tmp_path):
        result = run(spark, *source, str(tmp_path / "out"), "threshold", threshold=5.0)
        names, ids, files = written(tmp_path / "out")
        assert names == ["train-00000-of-00001.parquet"] and ids == [] and result.selected_rows == 0
        assert pq.read_schema(files[0]).equals(pq.read_schema(glob.glob(f"{source[0]}/data/*")[0]), check_metadata=False)
        assert "n/a" in (tmp_path / "out" / "README.md").read_text()

    def test_existing_output(self, spark, source, tmp_path):
        run(spark, *source, str(tmp_path / "out"), WOR, n_samples=90)
        with pytest.raises(FileExistsError):
            run(spark, *source, str(tmp_path / "out"), WOR, n_samples=10)
        run(spark, *source, str(tmp_path / "out"), WOR, n_samples=10, overwrite=True)
        names, ids, _ = written(tmp_path / "out")
        assert names == ["train-00000-of-00001.parquet"] and len(ids) == 10

    def test_timestamps_keep_their_type(self, spark, source, tmp_path):
        os.makedirs(tmp_path / "s")
        table = pa.table({"id": ["d0000"], "at": pa.array(pd.to_datetime(["2024-05-01 12:00:01.5"]).astype("datetime64[us]")), "n": pa.array([3], pa.int16())})
        pq.write_table(table, tmp_path / "s" / "x.parquet")
        run(spark, str(tmp_path / "s"), source[1], str(tmp_path / "out"), "threshold")
        back = pq.read_table(written(tmp_path / "out")[2][0])
        assert back.schema.field("n").type == pa.int16() and back["at"].to_pylist() == table["at"].to_pylist()
        assert back.schema.field("at").type.unit == "us"

    def test_options(self):
        needed = ["--dataset_path", "a", "--annotations_path", "b", "--output_dir", "c", "--mode", "threshold"]
        options = parser().parse_args(needed)
        assert (options.threshold, options.seed, options.n_samples, options.config) == (0.5, 42, None, None)
        with pytest.raises(SystemExit):
            parser().parse_args(needed[:-2])

    def test_mode_text(self, spark):
        def selection(*info):
            scores = score_distribution(scored_frame(spark, [0.5]), 1)
            row = provenance(CurationInfo("x", "s", "a", "default", *info), scores).first()
            return next(line for line in render_card(row, datetime.date(2025, 1, 1)).split("\n") if line.startswith("| Selection"))

        assert selection(WR, None, None, 0, 100, 100, 3) == "| Selection | sample_with_replacement (n=100, max_duplications=3) |"
        assert selection(WOR, None, 1234, 0, 100, 100) == "| Selection | sample_without_replacement (n=1,234) |"
        assert selection("threshold", 0.5, None, 0, 100, 100) == "| Selection | threshold (threshold >= 0.5) |"


class TestSafety:
    def curated(self, spark, rows, schema="id string, pos bigint", **options):
        notes = spark.createDataFrame([("a", "excellent"), ("b", "good"), ("c", "poor")], "id string, content_quality string")
        return curate(spark.createDataFrame(rows, schema), notes, spark=spark, config=quality_rules(), **{"mode": "threshold", **options})

    def test_null_key_is_refused(self, spark):
        with pytest.raises(ValueError, match="NULL"):
            self.curated(spark, [("a", 0), (None, 1), ("c", 2)], row_key="id")

    @pytest.mark.parametrize("places", [[0, 0, 1], [0, None, 1], [0, 1, 3], [1, 2, 3]])
    def test_bad_positions_are_refused(self, spark, places):
        with pytest.raises(ValueError, match="dense"):
            self.curated(spark, list(zip("abc", places)), position_col="pos")

    def test_repeated_annotations_need_an_order(self, spark):
        rows = spark.createDataFrame([("a", 0)], "id string, pos bigint")
        notes = spark.createDataFrame([("a", "poor", 1), ("a", "excellent", None)], "id string, content_quality string, turn int")
        with pytest.raises(ValueError, match="annotation_order"):
            curate(rows, notes, "threshold", quality_rules(), row_key="id", spark=spark)
        with curate(rows, notes, "threshold", quality_rules(), threshold=0.0, row_key="id", annotation_order="turn", spark=spark) as got:
            assert [(r.score, r.id) for r in got.aligned().collect()] == [(0.1, "a")]
            assert got.totals.matched == 1

    def test_tables_go_with_the_result(self, spark, monkeypatch):
        monkeypatch.setattr("gleanery.runtime.CACHE_ROWS", 0)
        folder = Folder(spark, spark.sparkContext.getCheckpointDir())
        rows = [("a", 0), ("b", 1), ("c", 2)]
        before = folder.names("gleanery-*")
        with self.curated(spark, rows, position_col="pos", mode=WOR, n_samples=2) as got:
            assert got.data().count() == 2
            assert len(folder.names("gleanery-*")) > len(before)
        assert folder.names("gleanery-*") == before
        with pytest.raises(ValueError, match="zero"):
            self.curated(spark, [("x", 0)], position_col="pos", mode=WOR, force=True)
        assert folder.names("gleanery-*") == before

    def test_output_apart_from_source(self, spark, tmp_path):
        source = write_source(tmp_path / "source", files=1, rows=3)
        notes = write_annotations(tmp_path / "notes.parquet", ["d0000"], ["good"])
        for output in (source, f"{source}/data", str(tmp_path)):
            with pytest.raises(ValueError, match="apart"):
                run(spark, source, notes, output, "threshold")

    def test_label_of_another_number_is_refused(self, spark):
        rules = ScoringConfig({"quality": ColumnScoring({1.5: 1.0})})
        notes = spark.createDataFrame([("a", 1)], "id string, quality int")
        with pytest.raises(ValueError, match="never equal"):
            compute_scores(notes, rules)
