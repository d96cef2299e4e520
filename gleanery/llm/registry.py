"""Queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm.byte_bpe import op4_byte_bpe
from gleanery.llm.embedding_dedup import op3_embedding_dedup
from gleanery.llm.language_id import op6_language_id
from gleanery.llm.licenses import op7_license_scan
from gleanery.llm.minhash import op1_minhash_dedup
from gleanery.llm.oracle import OP1, OP3, OP11, OP12
from gleanery.llm.packing import op2_best_fit_packing
from gleanery.llm.prefix_trie import op12_prefix_trie
from gleanery.llm.quality import op8_quality
from gleanery.llm.quality_rules import op11_quality_rules
from gleanery.llm.simhash import op10_simhash
from gleanery.llm.token_files import op9_token_files
from gleanery.llm.toxicity import op5_toxicity
from gleanery.llm.whitening import op13_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_language_id": op6_language_id,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_token_files": op9_token_files,
    "op10_simhash": op10_simhash,
    "op11_quality_rules": op11_quality_rules,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
ORACLE: dict[str, str] = {"op1_minhash_dedup": OP1, "op3_embedding_dedup": OP3, "op11_quality_rules": OP11, "op12_prefix_trie": OP12}
