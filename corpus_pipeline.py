"""The corpus pipeline over ``documents``: drop texts of no clear or no wanted language, drop
toxic texts, keep one document of each near-duplicate group, pack the rest into sequences.

Every stage works on all that its predecessor kept, and all but the last return the
columns of ``documents``. Models are learned from the stage's own input, outside the
held-out shares of the operators. Null text is the empty text: it has no language and
goes in the first stage. The third goes by texts alone: a row is dropped only if its own
text is in a group that keeps another row, whatever ids are null or repeated. Where
nothing could be learned, only texts without letters go: no text goes but for what is in it.
"""

from __future__ import annotations

import math
from collections.abc import Collection

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import language_id, minhash, packing, toxicity
from gleanery.llm.common import Scratch, bounded, read_table
from gleanery.operators.gather import rows_at

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.5
LOWEST = 0.5  # posterior below which a text has no clear language


def keep_languages(
    spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: Collection[str] | None = None, lowest: float = LOWEST,
) -> DataFrame:
    """Documents in a ``wanted`` language (all learned ones if None) whose posterior is at
    least ``lowest``. Texts without letters have no language."""
    model = language_id.learn_from_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    if not model["langs"]:  # then every text is undetermined
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs.select(*COLUMNS), model)
    accepted = sorted(model["langs"] if wanted is None else wanted)
    return found.where(F.col("lang_pred").isin(accepted) & (F.col("score") >= lowest)).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those that score TOXIC or more, and more than a text of no voter does."""
    model = toxicity.learn_from_documents(docs, read_table(spark, sf_dir, "labels"))
    found = toxicity.score_toxicity(docs.select(*COLUMNS), model)
    silent = 1 / (1 + math.exp(-max(model["base"], -50.0))) + 1e-9
    return found.where((F.col("toxic_score") < TOXIC) | (F.col("toxic_score") <= silent)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id, null first."""
    scratch = Scratch(spark)
    rows = scratch.keep(docs.select(*COLUMNS, minhash.row_key()))
    first = minhash.first_rows(rows.select("id", minhash.doc_key(), bounded()), scratch)
    scratch.sweep(rows, first)
    return rows_at(rows, first, "id").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("best_fit_packing", pack),
]
# Neither trained models nor packing can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; what each stage keeps is a table that the next one reads."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        scratch.sweep(docs)  # what the stage before has kept is not read again
    return STAGES[-1][1](spark, docs, sf_dir)
