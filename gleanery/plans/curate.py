"""The whole curation plan: load, score, join, gate, select, gather."""

from __future__ import annotations

import contextlib
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.gather import RESERVED, gather_by_key, gather_ordered
from gleanery.operators.lookup import attach_scores, hot_ids, latest_scores, raw_scores, rescaled, with_bounds
from gleanery.operators.ranking import unique_position
from gleanery.operators.selection import Selection, check_arguments, select_rows
from gleanery.operators.stats import (
    OBSERVED_DISTINCT, Profile, check_match_rate, distribution_frame, distribution_metrics, profile, score_distribution,
    selection_summary,
)
from gleanery.rules import DEFAULT_SCORING_CONFIG, ScoringConfig
from gleanery.runtime import PAYLOAD_ROWS, ensure_checkpoint_dir, held, release
from gleanery.sources.annotations import prune_annotations, scan_annotations
from gleanery.sources.dataset import read_dataset
from gleanery.sources.positions import (
    attach_positions, file_offsets, files_of, only_files, unfiltered, with_source_pos,
)

# Smaller tables are not searched for hot ids: a task can hold all of one id.
HOT_CHECK_ROWS = 20_000_000
# Selections below this size may be looked at on the driver, to read fewer files.
FEW_ROWS = 20_000


@dataclass
class Curated:
    """Result of :func:`curate`. Frames are lazy; ``scored`` is materialised.

    ``table`` is the dataset itself and ``offsets`` its files with their first positions,
    where it is read from files. ``selection.rows`` has ``source_pos`` (position in the source table), ``score`` and
    in the sampling modes ``draw_pos``. ``source`` is the dataset plus ``source_pos``, or
    with a row key the table of keys and positions, in which case ``keys`` names them.
    """

    source: DataFrame
    columns: list[str]
    scored: DataFrame
    selection: Selection
    totals: Profile
    distinct_scores: int
    table: DataFrame
    offsets: list[tuple[str, int, int]] | None
    keys: list[str] | None = None
    _held: list = field(default_factory=list)

    @property
    def source_files(self) -> int:
        return max(1, len(self.offsets or ()))

    def _gather(self, per_shard: int, order: str) -> tuple[DataFrame, int, int]:
        if self.keys:
            return gather_by_key(self.table, self.source, self.keys, self.selection, per_shard, order)
        rows = None if self.offsets is None else sum(count for _, _, count in self.offsets)
        return gather_ordered(self._payload(), self.selection, per_shard, order, rows)

    def _payload(self) -> DataFrame:
        """The source; if the selection is smaller than the number of files, only the
        files that it touches."""
        size = self.selection.size
        if self.offsets is None or size is None or not 0 < size < min(len(self.offsets), FEW_ROWS):
            return self.source
        positions = self.selection.rows.select("source_pos").distinct().collect()
        files = files_of(self.offsets, [row["source_pos"] for row in positions])
        return attach_positions(only_files(self.table, files), self.offsets, "source_pos")

    def aligned(self, order: str = "draw", per_shard: int = PAYLOAD_ROWS) -> DataFrame:
        """Source columns plus ``out_pos``, ``source_pos`` and ``score``, sorted by
        ``out_pos`` within and across partitions."""
        rows, _, _ = self._gather(per_shard, order)
        return rows.select(*self.columns, "out_pos", "source_pos", F.col("_score").alias("score"))

    def data(self, order: str = "draw", per_shard: int = PAYLOAD_ROWS) -> DataFrame:
        """The selected rows with exactly the source columns, in output order."""
        return self.shards(per_shard, order)[0]

    def shards(self, per_shard: int, order: str = "draw") -> tuple[DataFrame, int, int]:
        """``(rows, shards, count)``: partition i is shard i."""
        return self._shards(per_shard, order, None)

    def observed_shards(self, per_shard: int, order: str = "draw") -> tuple[DataFrame, int, int, Observation | None]:
        """As :meth:`shards`, with the score distribution that writing the rows reports on
        the way; None if there may be too many different scores, or no rows."""
        seen = Observation() if self.distinct_scores <= OBSERVED_DISTINCT else None
        rows, shards, count = self._shards(per_shard, order, seen)
        return rows, shards, count, seen if count else None

    def _shards(self, per_shard: int, order: str, seen: Observation | None) -> tuple[DataFrame, int, int]:
        rows, shards, count = self._gather(per_shard, order)
        if count == 0:
            return self.table.select(*self.columns).limit(0).repartition(1), 1, 0
        if seen is not None:  # after the last exchange, where every task counts once
            rows = rows.observe(seen, *distribution_metrics("_score"))
        return rows.select(*self.columns), shards, count

    def before(self) -> DataFrame:
        """Score distribution of the dataset (one row)."""
        if self.totals.distribution is not None:
            return distribution_frame(self.scored.sparkSession, self.totals.distribution)
        return score_distribution(self.scored, self.distinct_scores)

    def after(self) -> DataFrame:
        """Score distribution of the selection (one row)."""
        return score_distribution(self.selection.rows, self.distinct_scores)

    def summary(self) -> DataFrame:
        return selection_summary(self.selection.rows, self.totals.rows)

    def close(self) -> None:
        """Drop the cached frames and checkpoint tables."""
        release(*self._held)

    def __enter__(self) -> Curated:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def check_dense(places: DataFrame, name: str) -> int:
    """Positions must be 0, 1, 2, ... without gap, repeat or NULL; returns their number.
    Distinct positions are counted with map-side combine; one row comes to the driver."""
    found = places.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(name).alias("distinct"),
        F.min(name).alias("low"), F.max(name).alias("high"),
    ).first()
    if found["rows"] and (found["distinct"], found["low"], found["high"]) != (found["rows"], 0, found["rows"] - 1):
        raise ValueError(
            f"Positions must be unique and dense from 0: {found['rows']} rows, {found['distinct']} distinct positions "
            f"from {found['low']} to {found['high']}"
        )
    return found["rows"]


@dataclass
class _Placed:
    """A dataset's positions: ``source`` has ``source_pos`` beside the dataset's columns,
    or beside ``keys`` and the id; ``rows`` is its number of rows at most."""

    source: DataFrame
    ids: DataFrame
    rows: int
    offsets: list[tuple[str, int, int]] | None = None
    keys: list[str] | None = None


def _positioned(table: DataFrame, is_frame: bool, id_col: str, row_key, position_col) -> _Placed:
    identity = F.col(id_col).alias("id")
    if position_col:
        rows = check_dense(table, position_col)
        source = table.withColumn("source_pos", F.col(position_col).cast("bigint"))
        return _Placed(source, source.select("source_pos", identity), rows)
    if row_key:
        keys = [row_key] if isinstance(row_key, str) else list(row_key)
        slim = table.select(*keys, F.col(id_col).alias("_id"))
        places, rows = unique_position(slim, keys, "source_pos")
        return _Placed(places, places.select("source_pos", F.col("_id").alias("id")), rows, keys=keys)
    offsets = file_offsets(unfiltered(table) if is_frame else table)
    source = attach_positions(table, offsets, "source_pos")
    return _Placed(source, source.select("source_pos", identity), sum(count for _, _, count in offsets), offsets)


def _ordered_annotations(annotations: DataFrame, id_col: str) -> tuple[DataFrame, str | None]:
    """Annotations with the column that says which of several rows is the last: their place
    in the files they come from. A frame from elsewhere has no order; then ids must not repeat."""
    with contextlib.suppress(AnalysisException):  # raised where rows are not rows of files as they are
        annotations.select("_metadata.row_index")
        return with_source_pos(annotations, "annotation_pos"), "annotation_pos"
    if annotations.groupBy(id_col).count().where((F.col("count") > 1) & F.col(id_col).isNotNull()).head(1):
        raise ValueError("Several annotations share an id: name the column that orders them in annotation_order")
    return annotations, None


def curate(
    dataset: DataFrame | str,
    annotations: DataFrame | str,
    mode: str,
    config: ScoringConfig = DEFAULT_SCORING_CONFIG,
    *,
    threshold: float = 0.5,
    n_samples: int | None = None,
    seed: int = 42,
    force: bool = False,
    max_duplications: int | None = None,
    id_col: str = "id",
    annotation_id_col: str = "id",
    annotation_order: str | None = None,
    row_key: str | list[str] | None = None,
    position_col: str | None = None,
    spark: SparkSession | None = None,
) -> Curated:
    """Score a dataset by its annotations and select rows.

    ``dataset`` is a folder of parquet files or a parquet-backed frame, which may be
    filtered already; positions then still refer to the full table. Any other frame
    needs a unique ``row_key`` without NULLs to order it by, or a ``position_col`` with
    unique, dense bigints from 0; both are checked. Of several annotations with one id
    the last counts: by ``annotation_order``, else by the row order of the files that a
    path or a parquet-backed frame stands for. Repeated ids in any other frame without
    ``annotation_order`` are an error.
    """
    check_arguments(mode, n_samples, max_duplications)
    spark = spark or (
        dataset.sparkSession if isinstance(dataset, DataFrame) else SparkSession.active()
    )
    ensure_checkpoint_dir(spark)  # large frames need it; say so before any work
    if isinstance(annotations, DataFrame):
        order_col = annotation_order
        if order_col is None:
            annotations, order_col = _ordered_annotations(annotations, annotation_id_col)
        labels = prune_annotations(annotations, config, annotation_id_col, order_col)
    else:
        labels, order_col = scan_annotations(spark, annotations, config, annotation_id_col), "annotation_pos"
    raw, bounds = with_bounds(raw_scores(labels, config, order_col=order_col))
    scores = latest_scores(raw, order_col)

    is_frame = isinstance(dataset, DataFrame)
    table = dataset if is_frame else read_dataset(spark, dataset)
    taken = RESERVED.intersection(table.columns)
    if taken:
        raise ValueError(f"Rename these dataset columns first: {sorted(taken)}")
    placed = _positioned(table, is_frame, id_col, row_key, position_col)
    skewed = None
    if placed.rows > HOT_CHECK_ROWS:  # a frame may be filtered: count what is there
        skewed = hot_ids(placed.ids, placed.ids.count() if is_frame else placed.rows)
    scored = attach_scores(placed.ids, scores, config.missing_id_score, skewed)
    scored = held(scored.select("source_pos", "score", "matched"), placed.rows)
    holding = [scored, placed.source] if placed.keys else [scored]
    distinct = config.score_combinations(labels.columns)
    try:
        if config.normalize and scored.agg(F.count_if("matched")).first()[0]:
            # the action above has filled what is held, and with it the bounds of all annotations
            ends = bounds.get
            scored = scored.withColumn("score", F.when(
                F.col("matched"), rescaled(F.lit(ends["lo"]), F.lit(ends["hi"]))).otherwise(F.col("score")))
        totals = profile(scored, distinct)
        check_match_rate(totals, config.missing_id_score, force)
        selection = select_rows(
            scored, mode, totals, threshold=threshold, n_samples=n_samples, seed=seed,
            max_duplications=max_duplications, holding=holding,
        )
        if selection.has_draw_order:
            drawn = held(selection.rows, selection.size)
            holding.append(drawn)
            selection = replace(selection, rows=drawn)
    except BaseException:
        release(*holding)
        raise
    return Curated(
        placed.source, table.columns, scored, selection, totals, distinct, table, placed.offsets, placed.keys, holding
    )
