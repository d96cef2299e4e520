"""Byte-level BPE encoding by backtracking, and decoding by an offset table (operator 4).

A text is split by the tokenizer's pattern; each piece is encoded on its own. All tokens
that occur in a piece come from one Aho-Corasick pass, of which the longest at each
position is tried first. A token may follow another only if the merge order would not
have joined across their border; such pairs are looked up in a compatibility table that
is filled on demand. Where no token fits, the encoder steps back and shortens; positions
that cannot be reached are marked, so each is given up once at most and the work is
linear. The result is what applying the merges in order gives. Pieces that a worker has
met are remembered.

Decoding looks up each id's place in one table of all token bytes and copies the ranges.

Null text is the empty text: no ids, empty decoded text. Strings of special tokens in a
text become their ids, as the library does. Rows are independent, so repeated rows and
ties need no rule; other columns than those asked for are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
import string

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bounded, byte_alphabet, chunks, flatten, read_table, share_text, ship_package
from gleanery.llm.word_tokens import Ids

# Pieces that a worker remembers; beyond it the memory starts anew. Stretches of LONG bytes go piece by piece.
CACHE_PIECES, LONG = 500_000, 256
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# White space after something else. Control separators count as space in neither class.
SIGNS = string.punctuation
STRETCH = r"([^\s\x0b\x1c-\x1f\x{85}\p{Z}])([ \t\n\r\f])"
_LOADED: dict[int, ByteBpe] = {}


class ByteBpe:
    """Tables of one vocabulary. Ids of merged tokens ascend in the order of merges."""

    def __init__(self, model: str):
        spec = json.loads(model)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = byte_alphabet()
        vocab = {name: i for name, i in spec["model"]["vocab"].items() if name not in special}
        self.bytes_of = {i: bytes(to_byte[c] for c in name) for name, i in vocab.items()}
        self.special = special
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, both = vocab[left], vocab[right], vocab[left + right]
            self.parts[both] = (a, b)
            self.merged[a, b] = both
        self.by_bytes = by_bytes = {raw: i for i, raw in self.bytes_of.items()}
        self.lengths = {i: len(raw) for raw, i in by_bytes.items()}
        self.shorter = {i: self._prefix(raw, by_bytes) for raw, i in by_bytes.items()}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for raw, i in by_bytes.items():
            self.matcher.add_word(raw.decode("latin-1"), (len(raw), i))
        self.matcher.make_automaton()
        self.fits: dict[int, bool] = {}
        self._offsets([*self.bytes_of.items(), *((i, name.encode()) for name, i in special.items())])
        self.digits = [str(i) for i in range(len(self.start))]
        self.forget()

    @staticmethod
    def _prefix(raw: bytes, by_bytes: dict[bytes, int]) -> int | None:
        for size in range(len(raw) - 1, 0, -1):
            if raw[:size] in by_bytes:
                return by_bytes[raw[:size]]
        return None

    def _offsets(self, tokens: list[tuple[int, bytes]]) -> None:
        self.start = np.zeros(max(i for i, _ in tokens) + 1, np.int64)
        self.size = np.zeros(len(self.start), np.int64)
        place = 0
        for i, raw in tokens:
            self.start[i], self.size[i] = place, len(raw)
            place += len(raw)
        self.table = np.frombuffer(b"".join(raw for _, raw in tokens), np.uint8)

    def forget(self) -> None:
        """Empty the memory of pieces: the ids of each, and these as text."""
        self.seen, self.said = Ids(), []

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging in order leaves ``left`` and ``right`` side by side: undo the
        later of the two tokens' merges, again and again; at no level may the tokens that
        touch have an earlier merge of their own."""
        a, b, limit, good = left, right, 1 << 62, True
        while True:
            both = self.merged.get((a, b))
            if both is not None and both < limit:
                good = False
                break
            # the left side merges first on a tie of equal tokens
            if a > b and a in self.parts:
                limit, a = a, self.parts[a][1]
            elif b in self.parts:
                limit, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                limit, a = a, self.parts[a][1]
            else:
                break
        self.fits[left << 32 | right] = good
        return good

    def encode_piece(self, raw: bytes) -> list[int]:
        whole = self.by_bytes.get(raw)
        if whole is not None and whole not in self.parts:
            return [whole]
        size = len(raw)
        longest, span = [0] * size, [0] * size
        for end, (length, token) in self.matcher.iter(raw.decode("latin-1")):
            begin = end - length + 1
            if length > span[begin]:
                span[begin], longest[begin] = length, token
        closed = bytearray(size + 1)  # positions that no valid sequence of tokens gets past
        fits, shorter, lengths = self.fits, self.shorter, self.lengths
        ids: list[int] = []
        place, token, last = 0, longest[0] if size else None, -1
        while token is not None:
            end = place + lengths[token]
            if not closed[end]:
                good = last < 0 or fits.get(last << 32 | token)
                if good is None:
                    good = self.compatible(last, token)
                if good:
                    ids.append(token)
                    place, last = end, token
                    token = longest[place] if place < size else None
                    continue
            token = shorter[token]
            if token is None:
                closed[place] = 1
                token = ids.pop()
                place -= lengths[token]
                last = ids[-1] if ids else -1
        return ids

    def encode(self, text: str) -> list[int]:
        if self.split_special is None or not self.split_special.search(text):
            return self._plain(text)
        ids: list[int] = []
        for part in self.split_special.split(text):
            ids += [self.special[part]] if part in self.special else self._plain(part)
        return ids

    def _plain(self, text: str) -> list[int]:
        return [i for piece in PIECES.findall(text) for i in self.encode_piece(piece.encode("utf-8"))]

    def _rows(self, names: list[str], single: bool) -> np.ndarray:
        """Rows in memory of unique strings; ``single`` if each is one piece."""
        known = self.seen.rows
        new = [n for n in names if n not in known]
        if new:
            ids = [self.encode_piece(n.encode("utf-8")) if single else self.encode(n) for n in new]
            self.said += [",".join([self.digits[i] for i in own]) for own in ids]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            self.seen.add(new, np.fromiter((i for own in ids for i in own), np.uint32, int(counts.sum())), counts)
        return self.seen.rows_of(names)

    def rows_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text as rows of the memory, all in one array, and the number of each text's."""
        # A stretch begins where white space follows something else; no piece reaches across.
        marked = pc.replace_substring_regex(texts, STRETCH, "\\1\x00\\2")
        whole = pc.match_substring(texts, "\x00")
        for name in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, name))
        if pc.any(whole).as_py():  # such texts stay in one stretch each
            lists = pa.array(
                [[t] if w else m.split("\x00") for t, w, m in zip(texts.to_pylist(), whole.to_pylist(), marked.to_pylist())],
                pa.list_(pa.string()))
        else:
            lists = pc.split_pattern(marked, "\x00")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        stretches, at = coded.dictionary, coded.indices.to_numpy()
        if len(self.seen.rows) + 2 * len(stretches) > CACHE_PIECES:
            self.forget()
        first, second = np.full(len(stretches), -1), np.full(len(stretches), -1)
        core = pc.utf8_rtrim(stretches, characters=SIGNS)
        simple = pc.utf8_is_alpha(pc.if_else(pc.starts_with(core, " "), pc.utf8_slice_codeunits(core, 1), core))
        simple = pc.and_(simple, pc.less(pc.binary_length(core), LONG)).to_numpy(zero_copy_only=False)
        words = core.filter(pa.array(simple)).dictionary_encode()
        first[simple] = self._rows(words.dictionary.to_numpy(zero_copy_only=False).tolist(), True)[words.indices.to_numpy()]
        rest = stretches.filter(pa.array(~simple)).to_numpy(zero_copy_only=False).tolist()
        first[~simple] = self._rows(rest, False)
        tailed = simple & (pc.binary_length(stretches).to_numpy() > pc.binary_length(core).to_numpy())
        tails = pc.extract_regex(stretches.filter(pa.array(tailed)), f"(?P<tail>[{re.escape(SIGNS)}]*)$").field(0).dictionary_encode()
        second[tailed] = self._rows(tails.dictionary.to_numpy(zero_copy_only=False).tolist(), True)[tails.indices.to_numpy()]
        both = np.stack([first, second], axis=1)[at].ravel()
        ends = np.concatenate([[0], np.cumsum(both >= 0)[1::2]])
        return both[both >= 0], np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids and the number of each text's, and the same of the rows behind them."""
        rows, sizes = self.rows_of(texts)
        ids, counts = self.seen.get(rows)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])]), rows, sizes

    def decode(self, ids: np.ndarray) -> bytes:
        return self.table[flatten(self.start[ids], self.size[ids])].tobytes()


def byte_bpe(model: str) -> ByteBpe:
    """The worker's own tables of a tokenizer given as JSON text."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(model)
    return _LOADED[key]


def encode_texts(docs: DataFrame, tokenizer: str, *keep: str) -> DataFrame:
    """``keep`` columns and ``ids``, the token ids of each whole text."""
    model = share_text(docs.sparkSession, tokenizer)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                ids, counts, _, _ = byte_bpe(model.value).encode_batch(part.column("text"))
                cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), lists], names=[*keep, "ids"])

    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep), "ids array<int>"])
    return docs.select(*keep, bounded()).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, tokenizer: str, *keep: str) -> DataFrame:
    """``keep`` columns and ``text``; bytes that are no UTF-8 become U+FFFD."""
    model = share_text(encoded.sparkSession, tokenizer)

    def run(batches):
        for batch in batches:
            tables = byte_bpe(model.value)
            lists = batch.column("ids")
            values, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            texts = [tables.decode(values[a:b]).decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    schema = ", ".join([*(f"`{k}` {encoded.schema[k].dataType.simpleString()}" for k in keep), "text string"])
    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them, without shipping either."""
    model = share_text(docs.sparkSession, tokenizer)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                tables = byte_bpe(model.value)
                flat, counts, rows, sizes = tables.encode_batch(part.column("text"))
                said = [tables.said[row] for row in rows.tolist()]
                ids_hash, text_hash, stretch, token = [], [], 0, 0
                for size, count in zip(sizes.tolist(), counts.tolist()):
                    text = tables.decode(flat[token:token + count]).decode("utf-8", "replace")
                    ids_hash.append(hashlib.sha256(",".join(said[stretch:stretch + size]).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                    stretch, token = stretch + size, token + count
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), bounded())
    return texts.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship_package(spark)
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
