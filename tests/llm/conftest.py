import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def byte_model():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_model():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def documents(spark):
    """Whole documents of the smallest size, with a null and an empty text, a repeated
    row, a null id and a column whose name operators use themselves."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
    made = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x") for r in rows]
    made += [(9001, None, None, None, None, "x"), (9002, "", "en", None, 0, None), made[3], (None, "one two three", "en", "s", 13, "x"),
             (9003, " \n\t", "de", "s", 3, "x"), (9004, "ab " * 20_000, "en", "s", 60_000, "x")]
    return spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string").repartition(3)
