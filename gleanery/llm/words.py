"""Words of text batches, and the split of labelled rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Unique lower-case words of letters, the word of each occurrence, and the number
    of occurrences in each text."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), sizes


def sums_by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` that belong to each text; zero for none."""
    out = np.zeros((len(sizes), *values.shape[1:]), np.float64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def sample_fraction(fraction: Column, *of: Column) -> Column:
    """Whether a row is in a sample of about that share; the same rows in every run, equal
    ones together."""
    return F.pmod(F.xxhash64(*of, F.lit(20)), F.lit(1 << 20)) < fraction * (1 << 20)
