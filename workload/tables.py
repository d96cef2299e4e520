"""Inputs of the check queries. No table holds quality annotations, so they are
derived from ``labels`` and ``documents`` by one SQL text that Spark and the oracle
engine both run. It has unlisted and NULL labels, and covers part of the ids only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ANNOTATIONS_SQL = """
SELECT d.doc_id AS id,
  CASE WHEN l.quality = 1 AND d.n_chars >= 2500 THEN 'excellent'
       WHEN l.quality = 1 AND d.n_chars >= 1000 THEN 'good'
       WHEN l.quality = 1 THEN 'adequate'
       WHEN d.n_chars >= 1000 THEN 'poor' ELSE 'unacceptable' END AS content_quality,
  CASE WHEN l.toxic = 0 THEN 'safe' WHEN d.doc_id % 4 = 0 THEN 'mild_concerns'
       WHEN d.doc_id % 4 = 1 THEN 'nsfw' WHEN d.doc_id % 4 = 2 THEN 'harmful' ELSE 'illegal' END AS content_safety,
  CASE d.doc_id % 7 WHEN 0 THEN 'high' WHEN 1 THEN 'moderate' WHEN 2 THEN 'basic' WHEN 3 THEN 'minimal'
       WHEN 4 THEN 'none' WHEN 5 THEN 'unlisted' ELSE NULL END AS educational_value,
  CASE d.doc_id % 5 WHEN 0 THEN 'analytical' WHEN 1 THEN 'explanatory' WHEN 2 THEN 'basic_reasoning'
       WHEN 3 THEN 'minimal' ELSE 'none' END AS reasoning_indicators,
  CASE (d.doc_id + 1) % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'mostly_complete' WHEN 2 THEN 'fragment'
       ELSE 'severely_degraded' END AS content_integrity,
  CASE (d.doc_id + 2) % 5 WHEN 0 THEN 'dense' WHEN 1 THEN 'adequate' WHEN 2 THEN 'moderate'
       WHEN 3 THEN 'thin' ELSE 'empty' END AS information_density,
  CASE (d.doc_id + 3) % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'minimal' WHEN 2 THEN 'moderate' WHEN 3 THEN 'heavy'
       WHEN 4 THEN 'pure_marketing' ELSE NULL END AS commercial_bias
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
"""

SCORED_PROPERTIES = (
    "content_quality", "content_safety", "educational_value", "reasoning_indicators",
    "content_integrity", "information_density", "commercial_bias",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        ANNOTATIONS_SQL,
        labels=table(spark, sf_dir, "labels"),
        documents=table(spark, sf_dir, "documents"),
    )
