"""Positions, global order and the row gather, in every physical strategy."""

import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gleanery.operators.gather import _dealt, _near, check_positions, gather_ordered, gather_rows, order_source, rows_at, source_order
from gleanery.operators.ranking import bucket_counts, global_position, n_smallest, position_by_bucket
from gleanery.operators.selection import Selection
from gleanery.sources import read_dataset, with_source_pos
from tests.util import write_source


class TestPositions:
    @pytest.fixture(scope="class")
    @staticmethod
    def files(tmp_path_factory):
        """Row groups and scan splits smaller than the files; one file is empty."""
        root = tmp_path_factory.mktemp("positions with space")
        start = 0
        for number, size in enumerate([500, 0, 37, 900]):
            table = pa.table({"n": pa.array(range(start, start + size), pa.int64())})
            pq.write_table(table, root / f"part {number}.parquet", row_group_size=64)
            start += size
        return str(root)

    def test_rows_are_numbered_across_files(self, spark, files):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        try:
            placed = with_source_pos(read_dataset(spark, files))
            assert placed.rdd.getNumPartitions() > 4
            assert placed.where("n = source_pos").count() == placed.count() == 1437
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def test_filtered_frame_keeps_source_positions(self, spark, files):
        table = read_dataset(spark, files).where("n % 3 = 1")
        placed = with_source_pos(table)
        assert placed.count() == 479 and placed.where("n != source_pos").count() == 0

    def test_positions_need_no_shuffle_and_no_column(self, spark, files):
        plan = with_source_pos(read_dataset(spark, files)).select("source_pos")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert "ReadSchema: struct<_tmp_metadata_row_index:bigint>" in plan

    def test_lookup_order_of_folders(self, spark, tmp_path):
        write_source(tmp_path / "a", files=2, rows=3)
        write_source(tmp_path / "a", files=1, rows=50, sub="")
        assert read_dataset(spark, str(tmp_path / "a")).count() == 6
        write_source(tmp_path / "b", files=2, rows=4, sub="")
        write_source(tmp_path / "b", files=1, rows=50, sub="deeper")
        assert read_dataset(spark, str(tmp_path / "b")).count() == 8
        (tmp_path / "c").mkdir()
        with pytest.raises(FileNotFoundError, match="No .parquet files"):
            read_dataset(spark, str(tmp_path / "c"))


class TestRanking:
    @pytest.fixture(scope="class")
    @staticmethod
    def rows(spark):
        """A third of the rows share one key."""
        keys = [5.0] * 400 + [random.Random(1).expovariate(1) for _ in range(800)]
        random.Random(2).shuffle(keys)
        return spark.createDataFrame(list(enumerate(keys)), "id bigint, key double").repartition(5)

    def expect(self, rows):
        ordered = sorted((r["key"], r["id"]) for r in rows.collect())
        return {id_: pos for pos, (_, id_) in enumerate(ordered)}

    def got(self, frame):
        return {r["id"]: r["pos"] for r in frame.collect()}

    def test_global_position(self, rows, monkeypatch):
        monkeypatch.setattr("gleanery.operators.ranking.BUCKET_ROWS", 100)
        assert self.got(global_position(rows, [F.col("key"), F.col("id")])) == self.expect(rows)

    def test_single_range(self, rows):
        placed = global_position(rows, [F.col("key"), F.col("id")])
        assert self.got(placed) == self.expect(rows) and placed.columns == ["id", "key", "pos"]

    @pytest.mark.parametrize("per_unit", [0.01, 1, 50])
    def test_position_by_bucket(self, rows, per_unit):
        order = [F.col("key"), F.col("id")]
        assert self.got(position_by_bucket(rows, order, F.floor(F.col("key") * per_unit))) == self.expect(rows)

    @pytest.mark.parametrize("n", [0, 1, 377, 800, 1200, 5000])
    def test_n_smallest(self, rows, n):
        order, bucket = [F.col("key"), F.col("id")], F.floor(F.col("key") * 3)
        kept = n_smallest(rows, n, order, bucket, bucket_counts(rows, bucket))
        assert {r["id"] for r in kept.collect()} == {i for i, pos in self.expect(rows).items() if pos < n}

    def test_no_sort_in_one_task(self, rows):
        plan = position_by_bucket(rows, [F.col("id")], F.floor(F.col("key")))._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Python" not in plan


class TestGather:

    @pytest.fixture(scope="class")
    @staticmethod
    def source(spark):
        return spark.range(200).select(
            F.col("id").alias("source_pos"), F.concat(F.lit("row"), "id").alias("text")).repartition(7)

    def selection(self, spark, positions, draw_order=True, may_repeat=True, hot=()):
        rows = [(pos, place, pos / 1000) for place, pos in enumerate(positions)]
        frame = spark.createDataFrame(rows, "source_pos bigint, draw_pos bigint, score double").repartition(4)
        if not draw_order:
            frame = frame.drop("draw_pos")
        return Selection(frame, len(positions) if draw_order else None, may_repeat, draw_order, hot)

    def read(self, frame):
        rows = frame.select(F.spark_partition_id().alias("part"), "*").collect()
        return [(r["part"], r["out_pos"], r["source_pos"], r["text"], r["_score"]) for r in rows]

    # A third of all rows are copies of one source row.
    REPEATED = [random.Random(5).randrange(200) for _ in range(200)] + [17] * 100

    # Selection broadcast; directory of shards; bitmap; position ranges; plain shuffle.
    PLANS = [(1 << 20, 0), (0, 10 << 20), (0, 40_000), (0, 1000), (0, 0)]

    @pytest.mark.parametrize("budgets", PLANS)
    @pytest.mark.parametrize("per_shard", [1, 7, 50, 1000])
    @pytest.mark.parametrize("order", ["draw", "source"])
    def test_repeated_rows(self, spark, source, order, per_shard, budgets):
        positions = list(self.REPEATED)
        random.Random(9).shuffle(positions)
        chosen = self.selection(spark, positions, hot=(17,))
        frame, shards, rows = gather_ordered(source, chosen, per_shard, order, 200, *budgets)
        assert (shards, rows) == (-(-300 // per_shard), 300)
        expected = positions if order == "draw" else sorted(positions)
        assert self.read(frame) == [
            (i // per_shard, i, pos, f"row{pos}", pos / 1000) for i, pos in enumerate(expected)]

    @pytest.mark.parametrize("budgets", PLANS)
    def test_threshold_selection_is_in_source_order(self, spark, source, budgets):
        positions = list(range(3, 200, 4))
        chosen = self.selection(spark, positions, draw_order=False, may_repeat=False)
        frame, shards, rows = gather_ordered(source, chosen, 10, "draw", 200, *budgets)
        assert [r[2] for r in self.read(frame)] == positions and (shards, rows) == (5, 50)

    def test_large_source_order_shuffles_the_payload_once(self, spark, source):
        chosen = self.selection(spark, list(range(0, 200, 2)), False, False)
        frame, _, _ = gather_ordered(source, chosen, 10, "source", 200, 0)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        payload = [line for line in plan.splitlines() if "Exchange" in line and "passthrough" in line]
        assert len(payload) == 2 and plan.count("SortMergeJoin") == 1  # payload and selection
        joined = plan[: plan.index("SortMergeJoin")]
        assert "Sort [" not in joined and "Exchange" not in joined  # ordered as joined

    @staticmethod
    def payload_exchanges(frame):
        """Exchanges that carry the payload's text, from the formatted plan."""
        text = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        nodes = re.findall(r"\(\d+\) (\w*Exchange)\n(?:Input|Output) \[\d+\]: \[([^\]]*)\]", text)
        return [kind for kind, columns in nodes if "text#" in columns]

    @pytest.mark.parametrize("may_repeat", [True, False])
    def test_large_draw_order_shuffles_the_payload_once(self, spark, source, may_repeat):
        positions = [3, 150, 3, 17, 80] * 8 if may_repeat else list(range(0, 200, 3))
        plain = source.sparkSession.range(200).select(F.col("id").alias("source_pos"), F.hex("id").alias("text"))
        chosen = self.selection(spark, positions, may_repeat=may_repeat)
        once, _, _ = gather_ordered(plain, chosen, 9, "draw", 200, 0, 1 << 20)
        twice, _, _ = gather_ordered(plain, chosen, 9, "draw", 200, 0, 0)
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # nothing here is large
        try:
            assert self.payload_exchanges(once) == ["Exchange"] and self.payload_exchanges(twice) == ["Exchange"] * 2
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert self.read(once) == self.read(twice)

    def test_directory_deals_rows_to_their_shards(self, spark):
        """Lists on the borders of blocks, empty ones between, more shards than a byte holds."""
        places = [(0, 0), (0, 299), (7, 5), (32_767, 1), (32_767, 2), (32_767, 256), (32_768, 0), (65_535, 299), (99_999, 13)]
        slots = spark.createDataFrame(places, "source_pos bigint, _shard int").repartition(3)
        source = spark.range(100_000).select(F.col("id").alias("source_pos"), F.hex("id").alias("text"))
        for shards in (300, 70_000):
            dealt = _dealt(source, slots, 4, shards, 100, 1 << 20)
            assert sorted((r["source_pos"], r["_shard"]) for r in dealt.collect()) == places
            assert dealt.columns == ["source_pos", "text", "_shard"]

    def test_directory_only_within_its_budget(self, spark, source):
        slots = spark.createDataFrame([(1, 0)], "source_pos bigint, _shard int")
        assert _dealt(source, slots, 1, 10, 100, 98_307 + 96 + 100) is not None
        assert _dealt(source, slots, 1, 10, 100, 98_307 + 96 + 99) is None
        assert _dealt(source, slots, 1, 300, 100, 98_307 + 96 + 199) is None  # two bytes a shard
        assert _dealt(source, slots, 1, 1 << 10, 1 << 25, 1 << 40) is None  # a block's list could be too long

    @pytest.mark.parametrize("order", ["draw", "source"])
    def test_bitmap_drops_other_rows_before_the_shuffle(self, spark, order):
        """Positions over several bitmaps, on and off byte and block borders."""
        positions = [0, 7, 8, 4095, 32767, 32768, 32769, 65535, 70_000, 99_999]
        source = spark.range(100_000).select(F.col("id").alias("source_pos"), F.hex("id").alias("text"))
        chosen = self.selection(spark, positions, may_repeat=False)
        frame, _, _ = gather_ordered(source, chosen, 4, order, 100_000, 0, 1 << 20)
        assert [r[2] for r in self.read(frame)] == positions
        near = _near(source, chosen.rows, 4, 1 << 20)
        assert sorted(r["source_pos"] for r in near.collect()) == positions

    @pytest.mark.parametrize("budget", [0, 100, 2 * 96, 1 << 20])  # none, ranges of one block, of two, bitmaps
    def test_rows_at(self, spark, budget):
        far = 3 << 33  # as in the third partition of monotonically increasing ids
        rows = spark.range(40_000).union(spark.range(far, far + 200)).select(F.col("id").alias("at"), F.hex("id").alias("text"))
        for wanted in ([0, 8, 32767, far + 1], [39_999, 7, far + 199, far, 8, 8, 7], []):
            positions = spark.createDataFrame([(i,) for i in wanted], "a bigint")
            got = rows_at(rows, positions, "at", budget)
            assert got.columns == ["at", "text"]
            assert sorted(map(tuple, got.collect())) == [(i, f"{i:X}") for i in sorted(set(wanted))]

    def test_source_order_positions(self, spark):
        chosen = self.selection(spark, [5, 5, 199, 0, 5])
        placed, total = source_order(chosen.rows, block_rows=3)
        got = sorted((r["source_pos"], r["first"], r["copies"]) for r in placed.collect())
        assert got == [(0, 0, 1), (5, 1, 3), (199, 4, 1)] and total == 5
        assert sorted((r[1], r[0]) for r in order_source(chosen.rows).collect()) == [(0, 0), (1, 5), (2, 5), (3, 5), (4, 199)]

    def test_plain_gather(self, spark, source):
        got = gather_rows(source, self.selection(spark, [4, 4, 9]).rows).collect()
        assert sorted(r["text"] for r in got) == ["row4", "row4", "row9"]

    def test_position_range(self, spark):
        check_positions(self.selection(spark, [0, 199]).rows, 200)
        check_positions(self.selection(spark, [0]).rows.limit(0), 0)
        for bad in ([0, 200], [-1, 3]):
            with pytest.raises(IndexError, match="out of range"):
                check_positions(self.selection(spark, bad).rows, 200)
