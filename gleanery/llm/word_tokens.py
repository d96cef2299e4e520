"""Token ids of whole texts by a word-level tokenizer of the ``tokenizers`` library.

White space always separates this tokenizer's words, so a text's ids are the ids of its
words in order. Each worker keeps the ids of words it has seen, and once these are too many
those that came again most often; only new words go to the library, and of "Word!!" only
"word" and "!!" if these are new. Other words, such as those with digits, inner signs or
rarer letters, go to the library as they stand. Lower-case words of letters, which the
tokenizer's normalizer and splitter leave as they are, go to the library's model at once.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gleanery.llm.common import built_once, byte_alphabet, flatten

# Words that a worker remembers, but for a batch with more words than these.
CACHE_WORDS = 300_000
SIGNS = string.punctuation
# Characters of text that a worker encodes at a time.
SLICE_CHARS = 1 << 20
# Below U+0130 lower case and composition work by single characters.
_LETTERS = [c for c in map(chr, range(0x130)) if unicodedata.category(c)[0] == "L"]
_LOWER = re.compile(f"[{''.join(c for c in _LETTERS if c.lower() == c)}]+")
_BYTES_ALONE = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}


class Ids:
    """Ids of strings in one flat array with starts and counts."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int32)  # batches that had the string

    def add(self, names: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        base, end = len(self.rows), len(self.rows) + len(names)
        self.flat = _room(self.flat, self.used + len(flat))
        self.starts, self.counts, self.uses = (_room(x, end) for x in (self.starts, self.counts, self.uses))
        self.flat[self.used:self.used + len(flat)] = flat
        self.starts[base:end] = self.used + np.cumsum(counts) - counts
        self.counts[base:end] = counts
        self.rows.update(zip(names, range(base, end)))
        self.used += len(flat)

    def rows_of(self, names: list[str]) -> np.ndarray:
        """Rows of different names, -1 for those that are new."""
        return np.fromiter(map(self.rows.get, names, repeat(-1)), np.int64, len(names))

    def recurring(self, most: int) -> Ids:
        """A copy of at most so many strings, those used most often and more than once.
        Their uses are halved, so that what no longer comes goes in time."""
        uses = self.uses[:len(self.rows)]
        rows = np.argsort(-uses, kind="stable")[:max(0, most)]
        rows = np.sort(rows[uses[rows] > 1])
        names, kept = list(self.rows), Ids()
        kept.add([names[i] for i in rows], *self.get(rows))
        kept.uses[:len(rows)] = uses[rows] // 2
        return kept

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[rows]
        return self.flat[flatten(self.starts[rows], counts)], counts


def only_spells(model: dict) -> bool:
    """Whether all that a tokenizer does to a lower-case word of letters, before its model,
    is to spell its bytes in the signs of ``byte_alphabet``."""
    steps = (model["normalizer"] or {}).get("normalizers", [])
    split = (model["pre_tokenizer"] or {}).get("pretokenizers", [])
    if len(split) != 2 or model["post_processor"]:
        return False
    kept = all(step["type"] in ("NFC", "Lowercase") or step.get("pattern") == {"Regex": "\\s+"} for step in steps)
    whole = split[0].get("invert") and "|[\\p{L}]+|" in split[0].get("pattern", {}).get("Regex", "")
    return kept and whole and _BYTES_ALONE.items() <= split[1].items()


class WordIds:
    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spelled = {byte: sign for sign, byte in byte_alphabet().items()} if only_spells(json.loads(model)) else None
        self.parts = Ids()

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = [[]] * len(texts)
        others, tokenize = [], self.tokenizer.model.tokenize
        for i, text in enumerate(texts):
            if self.spelled is None or not _LOWER.fullmatch(text):
                others.append(i)
            else:  # the model knows bytes by signs, which are the letters themselves in ASCII
                signs = text if text.isascii() else text.encode().decode("latin-1").translate(self.spelled)
                found[i] = [token.id for token in tokenize(signs)]
        for i, e in zip(others, self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)):
            found[i] = e.ids
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Rows of ``parts`` for unique pieces."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        rows = self.parts.rows_of(names)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = np.arange(len(self.parts.rows), len(self.parts.rows) + len(new))
            unknown = [names[i] for i in new]
            self.parts.add(unknown, *self._by_library(unknown))
        self.parts.uses[rows] += 1
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text's."""
        lists = pc.ascii_split_whitespace(texts)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        # letters, then signs: the library splits there
        core = pc.utf8_rtrim(words, characters=SIGNS)
        simple = pc.and_(pc.utf8_is_alpha(core), pc.match_substring_regex(core, "^[\\x{00}-\\x{12F}]*$"))
        pieces = pc.if_else(simple, pc.utf8_lower(core), words).dictionary_encode()
        simple = simple.to_numpy(zero_copy_only=False)
        tailed = simple & (pc.binary_length(words).to_numpy() > pc.binary_length(core).to_numpy())
        tails = pc.extract_regex(words.filter(pa.array(tailed)), f"(?P<tail>[{re.escape(SIGNS)}]*)$").field(0).dictionary_encode()
        room = CACHE_WORDS - len(pieces.dictionary) - len(tails.dictionary)
        if len(self.parts.rows) > room:
            self.parts = self.parts.recurring(room)
        first = self._rows(pieces.dictionary)[pieces.indices.to_numpy()]
        second = np.full(len(words), -1)
        second[tailed] = self._rows(tails.dictionary)[tails.indices.to_numpy()]
        both = np.stack([first, second], axis=1)[at].ravel()
        ids, counts = self.parts.get(both[both >= 0])
        ends = np.concatenate([[0], np.cumsum(counts)])
        ends = ends[np.concatenate([[0], np.cumsum(both >= 0)[1::2]])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def word_ids(model: str) -> WordIds:
    """The worker's own encoder of a tokenizer given as JSON text."""
    return built_once(model, WordIds)
