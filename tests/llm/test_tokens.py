"""Operators 4, 9 and 2: against the tokenizers library, round trips, exact packings."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gleanery.llm import common
from gleanery.llm.byte_bpe import ByteBpe, decode_ids, encode_texts, round_trip
from gleanery.llm.common import Scratch, chunks
from gleanery.llm.packing import Remaining, best_fit, pack_documents, plan_packing, reduce_dominated
from gleanery.llm.token_files import checksums, read_token_files, token_starts, write_token_files
from gleanery.llm.word_tokens import WordIds

PARTS = ["a", "the", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "12", "½", "é", "é", "İ", "ß", "Σ",
         "漢字", "🙂", "'s", "'S", "'", "!!", "<|endoftext|>", "<|end", "\x00", "aaaa", "THE", ".", ",", "‍", "İx", "ſ", "ŉ"]


def mixtures(seed, number=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(number)]


class TestByteBpe:
    def test_equals_library(self, byte_model):
        own, library = ByteBpe(open(byte_model).read()), Tokenizer.from_file(byte_model)
        texts = mixtures(1)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [own.encode(t) for t in texts] == want
        ids, counts, _, _ = own.encode_batch(pa.array(texts))
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
        plain = [t for t in texts if "\x00" not in t and "<|" not in t]
        ids, _, _, _ = own.encode_batch(pa.array(plain))
        assert ids.tolist() == [i for t in plain for i in library.encode(t, add_special_tokens=False).ids]
        assert [own.decode(np.array(w, np.int64)).decode("utf-8", "replace") for w in want] == texts

    def test_long_runs_are_linear(self, byte_model):
        own, library = ByteBpe(open(byte_model).read()), Tokenizer.from_file(byte_model)
        for text in ("a" * 20_000, "ab" * 10_000, " " * 20_000, "=-" * 9_000):
            assert own.encode(text) == library.encode(text, add_special_tokens=False).ids

    def test_documents(self, spark, documents, byte_model):
        library = Tokenizer.from_file(byte_model)
        rows = documents.collect()
        got = Counter(map(tuple, round_trip(documents, byte_model).collect()))
        want = Counter()
        for r in rows:
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert got == want
        back = decode_ids(encode_texts(documents, byte_model, "doc_id", "score"), byte_model, "doc_id", "score")
        assert Counter(map(tuple, back.collect())) == Counter((r.doc_id, r.score, r.text or "") for r in rows)
        assert round_trip(documents.limit(0), byte_model).collect() == []


class TestTokenFiles:
    def test_words_equal_library(self, word_model):
        own, library = WordIds(open(word_model).read()), Tokenizer.from_file(word_model)
        texts = mixtures(2)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        ids, counts = own.encode(pa.array(texts))
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]

    def test_recurring_words_outlast_a_full_memory(self, word_model, monkeypatch):
        monkeypatch.setattr("gleanery.llm.word_tokens.CACHE_WORDS", 150)
        own, library, asked = WordIds(open(word_model).read()), Tokenizer.from_file(word_model), []
        by_library = own._by_library
        monkeypatch.setattr(own, "_by_library", lambda texts: asked.append(" ".join(texts)) or by_library(texts))
        common = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(30)]
        letters = "klmnopqrstuvwxyz"
        for k in range(12):
            rare = [f"q{letters[k]}{letters[i // 10]}{letters[i % 10]}" for i in range(40)]
            texts = [" ".join(common[::-1]) + "!", " ".join(rare + common[:5]), ""]
            want = [library.encode(t, add_special_tokens=False).ids for t in texts]
            ids, counts = own.encode(pa.array(texts))
            assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
            assert len(own.parts.rows) <= 150
        assert sum(a.split().count("waa") for a in asked) == 1
        many = [" ".join(rare + common + [f"z{i}" for i in range(120)])]  # more words than it keeps
        assert own.encode(pa.array(many))[0].tolist() == library.encode(many[0], add_special_tokens=False).ids

    def test_lower_case_words_go_to_the_model_at_once(self, word_model):
        own, library, asked = WordIds(open(word_model).read()), Tokenizer.from_file(word_model), []

        class Seen:
            model = own.tokenizer.model

            def encode_batch_fast(self, texts, **options):
                asked.extend(texts)
                return library.encode_batch_fast(texts, **options)

        own.tokenizer, rng = Seen(), random.Random(5)
        letters = [c for c in map(chr, range(0x20, 0x140)) if c.isalpha()]
        texts = [" ".join("".join(rng.choices(letters if k % 2 else letters[:52], k=rng.randint(1, 9))) for _ in range(40)) for k in range(100)]
        texts += ["weiß don't Straße, ª º µ x1 naïve!!", "e\u0301 \u0130x \u0138a <|endoftext|>"]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        ids, counts = own.encode(pa.array(texts))
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
        assert {"don't", "x1", "e\u0301", "<|endoftext|>"} <= set(asked)
        assert not {"weiß", "straße", "naïve", "µ"} & {w for a in asked for w in a.split()}

    def test_another_tokenizer_gets_all_words_itself(self, word_model):
        spec = json.loads(open(word_model).read())
        spec["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "a"}, "content": "o"})
        own, library = WordIds(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
        assert own.encode(pa.array(["banana split"]))[0].tolist() == library.encode("banana split", add_special_tokens=False).ids

    def test_slices_give_memory_back(self, monkeypatch):
        released = []
        monkeypatch.setattr(common, "release_unused", lambda: released.append(1), raising=False)
        batch = pa.RecordBatch.from_pydict({"text": ["a" * 6, "b" * 6, "c" * 30, None, "d"]})
        held = [(part.column("text").to_pylist(), len(released)) for part in chunks(batch, limit=12)]
        assert held == [(["a" * 6, "b" * 6], 0), (["c" * 30], 1), ([None, "d"], 2)]
        assert len(released) == 3

    def test_files(self, spark, documents, word_model):
        library = Tokenizer.from_file(word_model)
        path = Scratch(spark).path()
        write_token_files(documents, path, word_model, end_id=2)
        rows = read_token_files(spark, path).orderBy("shard", "place").collect()
        assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
        want = Counter((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in documents.collect())
        assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
        starts = {(r.shard, r.place): r.start for r in token_starts(spark, path).collect()}
        sums = {(r.shard, r.place): r.ids_crc32 for r in checksums(read_token_files(spark, path)).collect()}
        total = 0
        for r in rows:
            assert starts[r.shard, r.place] == total
            assert sums[r.shard, r.place] == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            total += r.n_tokens
        empty = Scratch(spark).path()
        write_token_files(documents.limit(0), empty, word_model, end_id=2)
        assert read_token_files(spark, empty).count() == token_starts(spark, empty).count() == 0


def fewest(items, capacity):
    """The least number of sequences, by exhaustive search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                rest = list(rooms)
                rest.remove(r)
                go(i + 1, [*rest, r - items[i]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


class TestPacking:
    def test_plans_hold_all(self):
        rng = random.Random(3)
        worse = 0
        for _ in range(400):
            capacity = rng.choice([10, 20, 37])
            items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
            plan, held = plan_packing(Counter(items), capacity), Counter()
            for pattern, times in plan:
                assert sum(n * c for n, c in pattern) <= capacity
                for n, c in pattern:
                    held[n] += c * times
            assert held == Counter(items)
            worse += sum(t for _, t in plan) - fewest(items, capacity)
        assert worse <= 4

    def test_reduction_keeps_the_optimum(self):
        rng = random.Random(4)
        for _ in range(400):
            capacity = rng.choice([10, 20, 37])
            items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
            left = Remaining(Counter(items))
            fixed = sum(times for _, times in reduce_dominated(left, capacity))
            rest = [n for n, c in left.counts.items() for _ in range(c)]
            assert fixed + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)

    def test_reduction_passes_over_lengths_without_a_set(self):
        left = Remaining({11: 1, 10: 5, 3: 1, 2: 1, 1: 1})  # 1, 2 and 3 fit beside 11
        assert reduce_dominated(left, 20) == [(((10, 2),), 2)] and left.counts == {11: 1, 10: 1, 3: 1, 2: 1, 1: 1}
        rng = random.Random(11)
        for _ in range(300):
            capacity = rng.choice([20, 37, 2048])
            left = Remaining(Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 60))))
            reduce_dominated(left, capacity)
            assert not reduce_dominated(left, capacity)

    def test_runs_pack_as_single_pieces_do(self):
        assert sum(t for _, t in best_fit(Remaining({3: 10}), 10)) == 4
        assert plan_packing({}, 10) == []
        with pytest.raises(ValueError):
            plan_packing({11: 1}, 10)

    def test_documents(self, spark, documents, word_model):
        library = Tokenizer.from_file(word_model)
        rows = pack_documents(documents, word_model, 0, 256).orderBy("sequence_id", "offset").collect()
        end = {}
        for r in rows:
            assert r.offset == end.get(r.sequence_id, 0)
            end[r.sequence_id] = r.offset + r.length
        assert max(end.values()) <= 256 and len(end) <= 1.02 * -(-sum(end.values()) // 256) + 1
        want = Counter()
        for d in documents.collect():
            ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
            for number, start in enumerate(range(0, len(ids), 256)):
                part = ids[start:start + 256]
                want[d.doc_id, number, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        assert pack_documents(documents.limit(0), word_model).collect() == []
