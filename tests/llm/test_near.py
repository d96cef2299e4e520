"""Operators 1, 3 and 10: against brute force on small fixtures."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm.common import Scratch
from gleanery.llm import components
from gleanery.llm.components import connected_components
from gleanery.llm.embedding_dedup import near_vectors, table_plan
from gleanery.llm.minhash import near_duplicates
from gleanery.llm import simhash
from gleanery.llm.simhash import compared_documents, edited_documents, fingerprints, near_fingerprints, next_documents
from tests.test_features import plan_of


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_sets(rows):
    sets = {}
    for i, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        runs = [tuple(words[k:k + 5]) for k in range(len(words) - 4)] if len(words) > 4 else [tuple(words)] * bool(words)
        sets[i] = frozenset(runs)
    return sets


def brute_groups(rows):
    sets, groups = shingle_sets(rows), Groups([i for i, _ in rows])
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.find(i), groups.find(i) == i) for i in ids}


def moved(plan):
    """Exchanges that carry texts."""
    return re.findall(r"\(\d+\) \w*Exchange\n(?:Input|Output) \[\d+\]: \[[^\]]*text#[^\]]*\]", plan)


class TestMinhash:
    def test_against_brute_force(self, spark):
        rng = random.Random(5)
        words = [f"w{i}" for i in range(3000)]
        base = [rng.choice(words) for _ in range(200)]
        rows = []
        for i in range(120):  # one group of near copies around the threshold
            text = list(base)
            for _ in range(rng.randint(2, 9)):
                text[rng.randrange(200)] = rng.choice(words)
            rows.append((i, " ".join(text)))
        text = [rng.choice(words) for _ in range(120)]
        for i in range(200, 240):  # a chain: neighbours are similar, ends are not
            text = text[5:] + [rng.choice(words) for _ in range(5)]
            rows.append((i, " ".join(text)))
        rows += [(300, None), (301, ""), (302, " \n"), (303, "a b"), (304, "A  B"), (305, "é É"), (306, "é é"), (307, "x " * 20_000)]
        rows += [(400 + i, rows[i % 7][1].upper()) for i in range(30)]
        frame = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id bigint, text string, id int, key string").repartition(5)
        assert {r.doc_id: tuple(r)[1:] for r in near_duplicates(frame).collect()} == brute_groups(rows)

    @pytest.fixture
    def joined_by_sort(self, spark):
        """As with tables too large to be broadcast unasked."""
        name, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set(name, "-1")
        yield
        spark.conf.set(name, was)

    def test_texts_are_chosen_without_a_shuffle(self, spark, joined_by_sort, monkeypatch):
        rows = [(i, f"{'a b c d e f g h i j k l m n o p q r s t u v w x y z ' * 2}{i % 9} {i % 9}") for i in range(40)]
        plans, keep = [], Scratch.keep

        def kept(scratch, df, **options):
            if df.columns == ["id", "text"]:
                plans.append(plan_of(df))
            return keep(scratch, df, **options)

        monkeypatch.setattr(Scratch, "keep", kept)
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        assert {r.doc_id: tuple(r)[1:] for r in near_duplicates(frame).collect()} == brute_groups(rows)
        assert len(plans) == 1 and not moved(plans[0])

    def test_pipeline_keeps_rows_without_a_shuffle(self, spark, joined_by_sort):
        docs = spark.createDataFrame([(i, f"a b c d e f {i // 2}", "en", "s", 13) for i in range(20)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
        found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        assert not moved(plan_of(found))
        assert sorted(r.doc_id for r in found.collect()) == list(range(0, 20, 2))

    def test_edges(self, spark):
        schema = "doc_id bigint, text string"
        assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
        rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, "a b c d e f")]
        got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
        assert got == sorted([(1, 2, None, False), (1, 2, None, False), (2, 0, 2, True), (None, 2, None, True)], key=str)

    @pytest.mark.parametrize("parts", [1, 4])
    def test_ids_of_several_texts(self, spark, parts):
        rng = random.Random(9)
        words = [f"w{i}" for i in range(2000)]
        base = {name: [rng.choice(words) for _ in range(80)] for name in "abcdefg"}
        said = lambda name, changed=0: " ".join([*base[name][:80 - changed], *(rng.choice(words) for _ in range(changed))])
        rows = [(1, said("a")), (1, said("b")), (2, said("a", 2)), (3, said("b", 3)), (4, said("c")), (1, ""), (5, ""),
                (None, said("d")), (None, said("e")), (6, said("d", 2)), (7, said("e", 3)), (8, said("e").upper()),
                (9, said("f")), (10, said("f", 2)), (10, said("g")), (11, said("g", 3))]
        rng.shuffle(rows)
        want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, None: None, 6: None, 7: None, 8: None, 9: 9, 10: 9, 11: 9}
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        got = near_duplicates(frame).collect()
        assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), 76 if t else 0) for i, t in rows)
        assert all((r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id) for r in got)


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, i) for i in range(501, 560)]
    groups = Groups(range(600))
    for a, b in edges:
        groups.join(a, b)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(6)
    got = dict(map(tuple, connected_components(frame, Scratch(spark)).collect()))
    assert got == {n: groups.find(n) for e in edges for n in e if e[0] != e[1] or n in got}
    assert connected_components(frame.limit(0), Scratch(spark)).collect() == []


@pytest.mark.parametrize("few", [1, 1 << 16])
def test_few_edges_need_no_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few, raising=False)
    scratch, groups = Scratch(spark), Groups(range(400))
    edges = [(i, i + 1) for i in range(0, 300, 2)] + [(i, i + 1) for i in range(1, 250, 2)] + [(7, 7), (350, 351), (351, 350)]
    for a, b in edges:
        groups.join(a, b)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    got = components.connected_components(frame, scratch).collect()
    assert len(got) == len(dict(map(tuple, got)))
    assert dict(map(tuple, got)) == {n: groups.find(n) for a, b in edges if a != b for n in (a, b)}
    assert (scratch.made == 2) == (few > 1)


class TestVectors:
    def test_against_brute_force(self, spark):
        rng = np.random.default_rng(1)
        center = rng.standard_normal(16)
        rows = [(i, (center + 0.12 * rng.standard_normal(16)).tolist(), i % 2) for i in range(300)]
        rows += [(1000 + i, center.tolist(), 1) for i in range(40)] + [(2000 + i, rng.standard_normal(16).tolist(), 1) for i in range(100)]
        bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
        rows += [(3000 + i, v, 1) for i, v in enumerate(bad)] + [(3100, center.tolist(), None), (3101, [1.0, 2.0], 1), (3102, [2.0, 4.0], 1)]
        units = {i: (np.array(v) / np.linalg.norm(v), label) for i, v, label in rows if v and label is not None and v not in bad}
        links, groups = defaultdict(int), Groups([i for i, _, _ in rows])
        for a, (x, label) in units.items():
            for b, (y, other) in units.items():
                if a != b and label == other and len(x) == len(y) and x @ y >= 0.98:
                    links[a] += 1
                    groups.join(a, b)
        want = {i: (links[i], groups.find(i), groups.find(i) == i) for i, _, _ in rows}
        frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, vector array<double>, label int, key int").repartition(4)
        assert {r.vec_id: tuple(r)[1:] for r in near_vectors(frame).collect()} == want

    @pytest.mark.parametrize("kind, labels", [("decimal(3,1)", ["1.2", "1.7"]), ("string", ["b", "c"]), ("double", ["1.25", "1.5"]), ("boolean", ["true", "false"])])
    def test_labels_of_any_type_are_compared_as_they_are(self, spark, kind, labels):
        rows = [(i, [1.0, 0.01 * i], labels[i % 2] if i < 6 else None) for i in range(8)]
        frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>, label string").withColumn("label", F.col("label").cast(kind))
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(frame).collect()}
        assert got == {**{i: (2, i % 2) for i in range(6)}, 6: (0, 6), 7: (0, 7)}

    def test_edges(self, spark):
        schema = "vec_id bigint, vector array<float>, label int"
        assert near_vectors(spark.createDataFrame([], schema)).collect() == []
        rows = [(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
        got = sorted((tuple(r) for r in near_vectors(spark.createDataFrame(rows, schema)).collect()), key=str)
        assert got == [(2, 2, None, False), (2, 2, None, False), (None, 2, None, True)]

    @pytest.mark.parametrize("classes", [1, 1000, 10**9])
    def test_tables_follow_signs(self, classes):
        signs, tables = table_plan(classes)
        assert (1 - (1 - np.arccos(0.98) / np.pi) ** signs) ** tables <= 1e-6


def xxhash_of(text):
    """Spark's xxhash64 of a text."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def voted(text):
    """The fingerprint of a text by plain counting."""
    words = [w for w in re.split("[ \t\n\r\f\v]", (text or "").lower()) if w]
    pairs = list(zip(words, [*words[1:], None]))
    votes = [0] * 64
    total = 0
    for a, b in pairs:
        seed = xxhash.xxh64_intdigest(a.encode(), 42)
        value = xxhash.xxh64_intdigest(b.encode(), seed) if b is not None else seed
        weight = min(16, len(a) + len(b or ""))
        total += weight
        for j in range(64):
            votes[j] += weight * (value >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


class TestSimhash:
    def test_whole_operator_against_plain_counting(self, spark):
        rng = random.Random(4)
        text = lambda: " ".join(f"word{rng.randrange(300)}" for _ in range(60))
        base = [text() for _ in range(6)]
        texts = [t for b in base for t in (b, b, b + " end", b.replace(" ", "  "), text())]
        rows = [(i * 25, t) for i, t in enumerate(texts)] + [(0, texts[0]), (100, None), (7, ""), (None, base[0])]
        frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, f string").repartition(4)
        plain = sorted({(-1 if i is None else i, xxhash_of(t or ""), t or "") for i, t in rows}, reverse=True)
        following = {x: y for x, y in zip(plain, plain[1:] + plain[:1])}
        bits = [voted(t) for _, t in rows]
        want = []
        for (i, t), f in zip(rows, bits):
            t = t or ""
            after = following[-1 if i is None else i, xxhash_of(t), t][2]
            edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
            like = lambda g, f=f: 1 - (f ^ g).bit_count() / 64
            near = sum((f ^ g).bit_count() <= simhash.RADIUS for g in bits) - 1 if i is not None and i % 100 == 0 else None
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{f:016x}", f"{voted(edited):016x}", like(voted(edited)), like(voted(after)), near))
        got = [tuple(r) for r in compared_documents(frame).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(r[-1] for r in got)

    def test_empty_table(self, spark):
        assert compared_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []

    def test_large_keys_are_dealt_over_parts(self, spark, monkeypatch):
        monkeypatch.setattr(simhash, "KEY_ROWS", 5)
        values = [1 << a | 1 << b for a in range(12) for b in range(a)]  # alike in most blocks
        frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
        want = {(a, b, (a ^ b).bit_count()) for a in values for b in values if (a ^ b).bit_count() <= 2}
        found = [tuple(r) for r in near_fingerprints(frame, frame, 2).collect()]
        assert len(found) == len(set(found)) and set(found) == want

    def test_edited_texts(self, spark, documents):
        rows, _ = edited_documents(documents, Scratch(spark))
        got = sorted((r.k, r.text, r.edited) for r in rows.collect())
        lowest = -(1 << 63)
        plain = sorted({(lowest if r.doc_id is None else r.doc_id, r.text or "") for r in documents.collect()}, reverse=True)
        edited = {}
        for (k, text), (_, after) in zip(plain, plain[1:] + plain[:1]):
            edited[k, text] = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        want = sorted((k, t, edited[k, t]) for k, t in ((lowest if r.doc_id is None else r.doc_id, r.text or "") for r in documents.collect()))
        assert [tuple(map(str, g[:2])) for g in got] == [tuple(map(str, w[:2])) for w in want]
        assert {hashlib.md5(g[2].encode()).hexdigest() for g in got} == {hashlib.md5(w[2].encode()).hexdigest() for w in want}

    def test_one_document_follows_itself(self, spark):
        slim = spark.createDataFrame([(5, 7, 9)], "k bigint, h bigint, n int")
        assert [tuple(r) for r in next_documents(slim, Scratch(spark)).collect()] == [(5, 7, 4, 5, 7)]
        assert next_documents(slim.limit(0), Scratch(spark)).collect() == []

    def test_fingerprints(self, spark):
        texts = ["the cat sat on the mat today", "The  cat\nsat on the mat today", "", None, "x", "quite other words stand in here now"]
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        got = {r.i: r.fingerprint for r in fingerprints(frame, "i").collect()}
        assert got[0] == got[1] and got[2] == got[3] == 0 and len(set(got.values())) == 4
        again = {r.i: r.fingerprint for r in fingerprints(frame.repartition(5), "i").collect()}
        assert again == got

    @pytest.mark.parametrize("radius", [0, 1, 3])
    def test_radius_search(self, spark, radius):
        rng = random.Random(radius)
        base = [rng.getrandbits(64) for _ in range(60)]
        every = base + [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 5))) for b in base] + base[:5]
        signed = [v - (1 << 64) if (v & ((1 << 64) - 1)) >> 63 else v for v in (v & ((1 << 64) - 1) for v in every)]
        frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
        queries = frame.limit(70)
        asked = {r.fingerprint for r in queries.collect()}
        mask = (1 << 64) - 1
        want = {(a, b, ((a ^ b) & mask).bit_count()) for a in asked for b in set(signed) if ((a ^ b) & mask).bit_count() <= radius}
        found = [tuple(r) for r in near_fingerprints(spark.createDataFrame([(v,) for v in asked], "fingerprint bigint"), frame, radius).collect()]
        assert len(found) == len(set(found)) and set(found) == want
