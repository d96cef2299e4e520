"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.scores import category_score
from gleanery.labels import label_dimension, ordinal_score
from gleanery.operators.draws import draw_with_replacement
from gleanery.operators.gather import gather_ordered, gather_rows, order_source
from gleanery.operators.lookup import attach_scores, compute_scores, latest_scores
from gleanery.operators.race import race_draw
from gleanery.operators.ranking import global_position
from gleanery.operators.selection import Selection, select_sample, select_threshold
from gleanery.operators.sketches import RANK_ERROR, approximate_distribution, merged_sketches, score_sketches
from gleanery.operators.stats import (
    DISTRIBUTION, PERCENTS, match_rate, profile, score_distribution, selection_summary, weight_totals,
)
from gleanery.plans.curate import Curated, curate
from gleanery.plans.positions import gather_positions
from gleanery.rules import ColumnScoring, ScoringConfig, rules_frame
from gleanery.sinks.card import CurationInfo, provenance
from gleanery.sinks.shards import rows_per_shard
from gleanery.sources.annotations import scan_annotations
from gleanery.sources.positions import with_source_pos
from workload.tables import SCORED_PROPERTIES, annotations, table

SEED = 42
THRESHOLD = 0.7
WOR, WR = "sample_without_replacement", "sample_with_replacement"

ALL_RULES = ScoringConfig.from_name("all_properties")
# Three properties keep products away from zero; the fourth is not in the table.
SOME_RULES = ScoringConfig(
    columns={
        "content_quality": ColumnScoring(
            {"excellent": 1.0, "good": 0.75, "adequate": 0.4, "poor": 0.1}, weight=3.0),
        "educational_value": ColumnScoring(
            {"high": 1.0, "moderate": 0.7, "basic": 0.4, "minimal": 0.15}, weight=2.0),
        "commercial_bias": ColumnScoring(
            {"none": 1.0, "minimal": 0.8, "moderate": 0.4, "heavy": 0.1}, weight=1.5, default_score=0.25),
        "audience_level": ColumnScoring({"expert": 1.0}, weight=7.0),
    },
    normalize=False,
)
# More labels than a map literal is searched for: the rules become a broadcast table.
LONG_RULES = ScoringConfig(
    columns={"bucket": ColumnScoring({bucket: bucket * 7 % 11 / 10 for bucket in range(247)}, default_score=0.5)}, normalize=False,
)
ROLE_RULES = ScoringConfig(
    columns={"role": ColumnScoring({"assistant": 0.9, "user": 0.3}, default_score=0.1)}
)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_source_pos(table(spark, sf_dir, "documents"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = latest_scores(compute_scores(annotations(spark, sf_dir), ALL_RULES))
    ids = documents(spark, sf_dir).select("source_pos", F.col("doc_id").alias("id"))
    return attach_scores(ids, scores, ALL_RULES.missing_id_score)


def scores_by(aggregation: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        rules = replace(SOME_RULES, aggregation=aggregation)
        return rounded(compute_scores(annotations(spark, sf_dir), rules), "score")
    return query


def scan(spark, sf_dir):
    rules = ScoringConfig(columns={
        name: ColumnScoring({1: 1.0, 0: 0.0}) for name in ("quality", "toxic", "not_there")
    })
    return scan_annotations(spark, f"{sf_dir}/labels.parquet", rules, id_col="doc_id")


def source_positions(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "source_pos")


def _label_use(spark, sf_dir):
    long = annotations(spark, sf_dir).unpivot("id", list(SCORED_PROPERTIES), "property", "label")
    return long.groupBy("property", "label").agg(F.count(F.lit(1)).alias("rows"))


def scoring_rules(spark, sf_dir):
    """Every rule with the number of annotation rows it scores."""
    used = _label_use(spark, sf_dir)
    return rules_frame(spark, ALL_RULES).join(used, ["property", "label"], "left").fillna(0, ["rows"])


def label_use(spark, sf_dir):
    """Every label in use with its place in the vocabulary."""
    labels = label_dimension(spark).drop("kind")
    return rounded(_label_use(spark, sf_dir).join(labels, ["property", "label"], "left"), "norm_score")


def category_scores(spark, sf_dir):
    rows = annotations(spark, sf_dir)
    types = {field.name: field.dataType for field in rows.schema}
    return rows.select("id", *[
        category_score(name, rule, types[name]).alias(name) for name, rule in ALL_RULES.columns.items()
    ])


def score_skips_absent(spark, sf_dir):
    rules = replace(SOME_RULES, columns={
        name: SOME_RULES.columns[name] for name in ("content_quality", "audience_level")
    })
    return rounded(compute_scores(annotations(spark, sf_dir), rules), "score")


def score_normalized(spark, sf_dir):
    return rounded(compute_scores(annotations(spark, sf_dir), ALL_RULES), "score")


def ordinal_encode(spark, sf_dir):
    return annotations(spark, sf_dir).select(
        "id",
        *[ordinal_score(name, name).alias(name) for name in SCORED_PROPERTIES],
        *[F.round(ordinal_score(name, name, True), 9).alias(f"{name}_norm") for name in SCORED_PROPERTIES],
    )


def threshold_rows(spark, sf_dir):
    return rounded(select_threshold(scored_documents(spark, sf_dir), THRESHOLD), "score")


def score_join(spark, sf_dir):
    return rounded(scored_documents(spark, sf_dir).select("id", "score", "matched"), "score")


def dedup_annotations(spark, sf_dir):
    """Conversations as annotations with many rows per id: the last turn counts."""
    turns = table(spark, sf_dir, "conversations")
    scores = compute_scores(turns, ROLE_RULES, id_col="conv_id", order_col="turn")
    return rounded(latest_scores(scores, "turn"), "score")


def distribution(spark, sf_dir):
    scored = scored_documents(spark, sf_dir)
    return rounded(score_distribution(scored, ALL_RULES.score_combinations()), *DISTRIBUTION)


def rate(spark, sf_dir):
    return rounded(match_rate(scored_documents(spark, sf_dir)), "match_rate")


def totals(spark, sf_dir):
    return rounded(weight_totals(scored_documents(spark, sf_dir)), "weight_sum")


def summary(spark, sf_dir):
    scored = scored_documents(spark, sf_dir)
    return rounded(selection_summary(select_threshold(scored, THRESHOLD), scored.count()), "ratio")


def _drawn(spark, sf_dir, mode, share: float, cap: int | None = None) -> Selection:
    """A sample whose size is a share of the table's rows."""
    scored = scored_documents(spark, sf_dir).select("source_pos", "score", "matched").persist()
    found = profile(scored)
    return select_sample(scored, mode, int(found.rows * share), SEED, found, cap)


def sample(mode, share, cap=None):
    return lambda spark, sf_dir: rounded(_drawn(spark, sf_dir, mode, share, cap).rows, "score")


def gathered(spark, sf_dir):
    rows = gather_rows(documents(spark, sf_dir), _drawn(spark, sf_dir, WR, 2).rows)
    return rounded(
        rows.select("draw_pos", "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), "score"),
        "score",
    )


def ordered_by_source(spark, sf_dir):
    return order_source(_drawn(spark, sf_dir, WR, 0.5, 3).rows)


def ordered_by_draw(spark, sf_dir):
    drawn = _drawn(spark, sf_dir, WR, 0.5, 3)
    rows, _, _ = gather_ordered(documents(spark, sf_dir), drawn, drawn.size, "draw")
    return rows.select("out_pos", "doc_id", "n_chars")


def ranked(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return global_position(rows, [F.desc("n_chars"), F.asc("doc_id")])


def shard_assignment(spark, sf_dir):
    """The shard that each output row physically lands in."""
    drawn = _drawn(spark, sf_dir, WR, 0.5, 3)
    rows, _, _ = gather_ordered(documents(spark, sf_dir), drawn, max(1, drawn.size // 7), "source")
    return rows.select(F.spark_partition_id().alias("shard"), "out_pos", "doc_id")


def _curated(spark, sf_dir, mode, **options) -> Curated:
    return curate(
        table(spark, sf_dir, "documents"), annotations(spark, sf_dir), mode, ALL_RULES,
        id_col="doc_id", seed=SEED, spark=spark, **options,
    )


def _rows_of(spark, sf_dir) -> int:
    return table(spark, sf_dir, "documents").count()


def curated_rows(mode, share: float | None = None, **options):
    def query(spark, sf_dir):
        sized = {} if share is None else {"n_samples": int(_rows_of(spark, sf_dir) * share)}
        rows = _curated(spark, sf_dir, mode, **sized, **options).aligned()
        return rounded(
            rows.select("out_pos", "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), "score"),
            "score",
        )
    return query


def provenance_row(spark, sf_dir):
    n = int(_rows_of(spark, sf_dir) * 0.5)
    curated = _curated(spark, sf_dir, WR, n_samples=n, max_duplications=3)
    info = CurationInfo(
        name="curated", source_dataset="documents", annotations_path="labels", config_name="all_properties",
        mode=WR, threshold=None, n_samples=n, seed=SEED, source_rows=curated.totals.rows,
        selected_rows=curated.selection.size, max_duplications=3,
    )
    return rounded(provenance(info, curated.after()), "selected_percent", *DISTRIBUTION)


def distribution_multipass(spark, sf_dir):
    """Without a bound on distinct scores, as for any caller who gives none."""
    return rounded(score_distribution(scored_documents(spark, sf_dir)), *DISTRIBUTION)


def sample_bucketed(mode, share, cap):
    """The race with its plans for large tables: pruned by a cut-off, ranked by buckets."""
    def query(spark, sf_dir):
        scored = scored_documents(spark, sf_dir).select("source_pos", "score", "matched").persist()
        found = profile(scored)
        rows = race_draw(scored, int(found.rows * share), SEED, cap, found, mode == WR, unpruned=0, top_k=0)
        return rounded(rows, "score")
    return query


def sample_blocks(spark, sf_dir):
    """Draws with replacement over many blocks and cells."""
    scored = scored_documents(spark, sf_dir).select("source_pos", "score", "matched").persist()
    found = profile(scored)
    return rounded(draw_with_replacement(scored, found.rows * 2, SEED, found, block_rows=64, cell_draws=32), "score")


def score_join_skewed(spark, sf_dir):
    """Turns look up their conversation's score, with the longest conversations apart."""
    turns = table(spark, sf_dir, "conversations")
    scores = latest_scores(compute_scores(turns, ROLE_RULES, id_col="conv_id", order_col="turn"), "turn")
    longest = turns.groupBy("conv_id").count().orderBy(F.desc("count"), "conv_id").limit(3)
    rows = turns.select(F.col("conv_id").alias("id"), "turn")
    joined = attach_scores(rows, scores, 0.0, [row["conv_id"] for row in longest.collect()])
    return rounded(joined, "score")


def negative_weights(spark, sf_dir):
    """Scores below zero weigh nothing."""
    shifted = scored_documents(spark, sf_dir).withColumn("score", F.col("score") - 0.5)
    return rounded(weight_totals(shifted), "weight_sum")


def last_annotation(spark, sf_dir):
    """Documents annotated by conversations, of which the last turn counts."""
    curated = curate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"), "threshold", ROLE_RULES,
        threshold=0.5, id_col="doc_id", annotation_id_col="conv_id", annotation_order="turn", force=True, spark=spark,
    )
    return rounded(curated.aligned().select("out_pos", "doc_id", "score"), "score")


def last_row_annotation(spark, sf_dir):
    """The same without a named order: the last row of the annotations' files counts."""
    curated = curate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"), "threshold", ROLE_RULES,
        threshold=0.5, id_col="doc_id", annotation_id_col="conv_id", force=True, spark=spark,
    )
    return rounded(curated.aligned().select("out_pos", "doc_id", "score"), "score")


def ordered_by_directory(spark, sf_dir):
    """Draw order with the plan for large selections: every row knows its shards at the scan."""
    drawn = _drawn(spark, sf_dir, WR, 2)
    rows, _, _ = gather_ordered(
        documents(spark, sf_dir), drawn, max(1, drawn.size // 7), "draw", _rows_of(spark, sf_dir), broadcast_bytes=0)
    return rows.select(F.spark_partition_id().alias("shard"), "out_pos", "doc_id", "n_chars")


def shard_sizes(spark, sf_dir):
    """Rows in each shard, sized as for a source of three files."""
    drawn = _drawn(spark, sf_dir, WR, 0.5, 3)
    per_shard = rows_per_shard(_rows_of(spark, sf_dir), 3)
    rows, _, _ = gather_ordered(documents(spark, sf_dir), drawn, per_shard, "source")
    return rows.groupBy(F.spark_partition_id().alias("shard")).agg(F.count(F.lit(1)).alias("rows"))


def own_positions(spark, sf_dir):
    """Every seventh row around the table, as often as there are rows."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.select(F.expr("doc_id * 7 % {n}".format(n=max(1, docs.count()))).alias("source_pos"), F.col("doc_id").alias("place"))
    return gather_positions(docs, asked, "place").select("out_pos", "source_pos", "doc_id", "n_chars")


def long_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") % 300).cast("int").alias("bucket"))
    return rounded(compute_scores(rows, LONG_RULES), "score")


def approximate_scores(spark, sf_dir):
    """Percentiles from merged sketches of eight shards, and whether their true ranks keep
    to the stated error."""
    scored = scored_documents(spark, sf_dir)
    parts = score_sketches(scored.withColumn("shard", F.col("source_pos") % 8), "shard")
    found = approximate_distribution(merged_sketches(parts)).first()
    ranks = [F.struct(
        F.lit(p).alias("percent"),
        ((F.count_if(F.col("score") < found[f"p{p}"]) <= F.count(F.lit(1)) * (p / 100 + RANK_ERROR))
         & (F.count_if(F.col("score") <= found[f"p{p}"]) >= F.count(F.lit(1)) * (p / 100 - RANK_ERROR))).alias("within"),
    ) for p in PERCENTS]
    checked = scored.agg(F.array(*ranks).alias("ranks")).select(F.explode("ranks").alias("r")).select("r.*")
    facts = [F.lit(found[name]).alias(name) for name in ("rows", "mean", "min", "max")]
    return rounded(checked.select("*", *facts), "mean", "min", "max")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_annotations": scan,
    "source_positions": source_positions,
    "scoring_rules": scoring_rules,
    "label_dimension": label_use,
    "category_scores": category_scores,
    "score_skips_absent": score_skips_absent,
    "score_weighted_mean": scores_by("weighted_mean"),
    "score_weighted_sum": scores_by("weighted_sum"),
    "score_min": scores_by("min"),
    "score_product": scores_by("product"),
    "score_normalized": score_normalized,
    "ordinal_encode": ordinal_encode,
    "select_threshold": threshold_rows,
    "score_join": score_join,
    "dedup_annotations": dedup_annotations,
    "gather_rows": gathered,
    "score_distribution": distribution,
    "match_rate": rate,
    "weight_totals": totals,
    "selection_summary": summary,
    "sample_wor": sample(WOR, 0.2),
    "sample_wor_capped_n": sample(WOR, 1),
    "sample_wr": sample(WR, 2),
    "sample_wr_capped": sample(WR, 0.5, 3),
    "sample_wr_capacity": sample(WR, 10, 2),
    "order_source": ordered_by_source,
    "order_draw": ordered_by_draw,
    "global_position": ranked,
    "shard_assignment": shard_assignment,
    "provenance": provenance_row,
    "curate_threshold": curated_rows("threshold", threshold=THRESHOLD),
    "curate_wor": curated_rows(WOR, 0.2),
    "curate_wr": curated_rows(WR, 2),
    "curate_wr_capped": curated_rows(WR, 0.5, max_duplications=3),
    "curate_by_key": curated_rows("threshold", threshold=THRESHOLD, row_key="doc_id"),
    "curate_by_position": curated_rows("threshold", threshold=THRESHOLD, position_col="doc_id"),
    "curate_last_annotation": last_annotation,
    "sample_wor_bucketed": sample_bucketed(WOR, 0.2, 1),
    "sample_wr_capped_pruned": sample_bucketed(WR, 0.5, 300),
    "sample_wr_blocks": sample_blocks,
    "score_distribution_multipass": distribution_multipass,
    "score_join_skewed": score_join_skewed,
    "weight_totals_negative": negative_weights,
    "curate_last_row": last_row_annotation,
    "curate_by_key_wr": curated_rows(WR, 2, row_key="doc_id"),
    "order_draw_directory": ordered_by_directory,
    "shard_sizes": shard_sizes,
    "gather_positions": own_positions,
    "score_long_rules": long_rules,
    "score_distribution_approx": approximate_scores,
}
