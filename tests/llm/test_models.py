"""Operators 5, 6, 7 and 8: held-out accuracy, exact sums, brute force; and the pipeline."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import common, language_id, licenses, quality, registry, toxicity
from gleanery.llm.minhash import near_duplicates

SMALL = "/root/testdata/sf0.01"


class TestLanguage:
    def test_forward_sums_all_cuts(self):
        pieces = ["", "a", "b", "ab", "▁a", "▁ab", "ba"]
        lattices, probability = language_id.Lattices(pieces), np.random.default_rng(1).random((len(pieces), 2))

        def brute(rest, first):
            if not rest:
                return np.ones(2)
            total = np.zeros(2)
            for n in range(1, len(rest) + 1):
                name = rest[:n]
                if name in pieces:
                    total += probability[pieces.index(name)] * brute(rest[n:], False)
                elif n == 1:
                    total += probability[0] * brute(rest[n:], False)
                if first and "▁" + name in pieces:
                    total += probability[pieces.index("▁" + name)] * brute(rest[n:], False)
            return total

        words = ["ab", "aab", "abab", "xab", "bba", "q"]
        arcs = lattices.arcs(words)
        alpha, logs = language_id.forward(arcs, probability[arcs[3]])
        for row, word in enumerate(words):
            assert np.allclose(alpha[row, len(word) + 1], brute(word, True))
        assert np.allclose(language_id.word_logs(alpha, logs, arcs[4]), np.log([brute(w, True) for w in words]))

    @staticmethod
    def long_words():
        """Words of 10 to 3000 letters, and runs of scripts that are written without spaces."""
        rng = random.Random(4)
        alphabets = ["ab", "abxyz", "的一是在不了有和人这", "กขคงจฉชซ"]
        return ["".join(rng.choice(letters) for _ in range(n)) for letters in alphabets for n in (10, 15, 16, 17, 24, 25, 33, 64, 200, 3000)]

    @staticmethod
    def log_sums(word, pieces, probability):
        """Forward sums in logs, place by place; pieces as a plain set of names."""
        number, out = {name: i for i, name in enumerate(pieces)}, []
        for lang in range(probability.shape[1]):
            at = [0.0]
            for end in range(1, len(word) + 1):
                ways = []
                for begin in range(max(0, end - 6), end):
                    name = word[begin:end]
                    if begin == 0 and "▁" + name in number:
                        ways.append(np.log(probability[number["▁" + name], lang]))
                    if name in number:
                        ways.append(at[begin] + np.log(probability[number[name], lang]))
                    elif len(name) == 1:
                        ways.append(at[begin] + np.log(probability[0, lang]))
                at.append(np.logaddexp.reduce(ways))
            out.append(at[-1])
        return out

    def test_no_word_is_too_long(self):
        pieces = ["", "a", "b", "ab", "ba", "bab", "abxyz", "x", "▁a", "▁ab", "的", "一是", "在不了", "▁กข", "ค"]
        probability = np.random.default_rng(5).random((len(pieces), 3)) * 1e-4
        words, lattices = self.long_words(), language_id.Lattices(pieces)
        scorer = language_id.LanguageScorer({"langs": ["x", "y", "z"], "pieces": pieces, "probability": probability})
        got = scorer.of_words(words)
        assert np.allclose(got, [self.log_sums(w, pieces, probability) for w in words], rtol=1e-10)
        assert np.isfinite(got).all() and sorted(sum(language_id.by_length(words, 3), [])) == list(range(len(words)))
        # expected uses: the derivative of the log sum by the log of a piece's probability
        for word in (words[3], words[8], words[15], words[28], words[38]):
            arcs = lattices.arcs([word])
            counts = language_id.expected_counts(arcs, probability, np.array([[2.0, 2.0, 2.0]]))
            for piece in (0, 2, 3, 10, 13):
                raised, step = probability.copy(), 1e-6
                raised[piece] *= np.exp(step)
                slope = (np.array(self.log_sums(word, pieces, raised)) - self.log_sums(word, pieces, probability)) / step
                assert np.allclose(counts[piece], 2 * slope, rtol=1e-3, atol=1e-3)

    def test_sums_are_held_in_groups_of_similar_length(self, monkeypatch):
        monkeypatch.setattr(language_id, "CELLS", 300)
        words = ["a" * n for n in (1, 2, 3, 50, 400, 4, 5)]
        groups = list(language_id.by_length(words, 3))
        assert [4] in groups and all(len(g) == 1 or len(g) * (max(len(words[r]) for r in g) + 2) * 3 <= 300 for g in groups)

    def test_held_out(self, spark):
        got = registry.QUERIES["op6_language_id"](spark, SMALL)
        truth = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
        right = got.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
        assert got.count() == truth.count() and right > 0.97

    def test_edges(self, spark, documents):
        model = language_id.learn_languages(documents, language_id.vocabulary(_pieces()), max_words=500, rounds=1)
        rows = language_id.identify(documents, model).collect()
        assert len(rows) == documents.count()
        assert all(r.lang_pred == "und" and r.score == 0 for r in rows if not (r.text or "").strip())
        assert all(0 < r.score <= 1 for r in rows if (r.text or "").strip())
        nothing = language_id.learn_languages(documents.limit(0), ["", "a"])
        assert {r.lang_pred for r in language_id.identify(documents, nothing).collect()} == {"und"}
        assert language_id.identify(documents.limit(0), model).collect() == []


def _pieces():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class TestWorkers:
    def test_one_model_a_worker(self):
        made = []

        def build(value):
            made.append(value)
            return [value]

        model = {"weights": np.zeros(3)}
        first = common.built_once(model, build)
        assert common.built_once(model, build) is first and made == [model]
        assert common.built_once("text", str.upper) == "TEXT" and common.built_once("te" + "xt", str.upper) == "TEXT"
        assert common.built_once(model, build) is not first and len(common._BUILT) == 3

    def test_scratch_tables_go_when_swept(self, spark):
        scratch = common.Scratch(spark)
        kept, gone, dropped = (scratch.keep(spark.range(n)) for n in (3, 4, 5))
        scratch.drop(dropped, dropped, None, spark.range(2))
        scratch.sweep(kept)
        assert kept.count() == 3 and scratch.kept == [kept._scratch_path]
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FAILED_READ_FILE|FILE_NOT_EXIST"):
            spark.read.parquet(gone._scratch_path).count()


class TestSamples:
    def test_copies_of_one_row_count_once(self, spark):
        """Rows that repeat id and text are sampled together; the sample must stay bounded."""
        copies = spark.range(30_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("awful words here").alias("text"), F.lit(1).alias("toxic"))
        others = spark.range(200).select("id", F.concat(F.lit("fine text "), "id"), F.lit(0))
        rows = copies.union(others)
        model = toxicity.learn_toxicity(rows, max_rows=100_000)
        again = toxicity.learn_toxicity(rows.dropDuplicates(), max_rows=100_000)
        assert model["lexicon"] == again["lexicon"] and np.allclose(model["weights"], again["weights"])
        made = quality.learn_quality(rows.withColumnRenamed("toxic", "quality"), max_rows=100_000)
        same = quality.learn_quality(rows.dropDuplicates().withColumnRenamed("toxic", "quality"), max_rows=100_000)
        assert all(np.allclose(a, b) for a, b in zip(made["tables"], same["tables"]))


class TestSuppression:
    @staticmethod
    def plain(found):
        kept = []
        for first, last, priority, rule in sorted(set(found), key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
            inside = any(a <= first and last <= b for a, b, _, _ in kept)
            around = any(first <= a and b <= last and p > priority for a, b, p, _ in kept)
            if not inside and not around:
                kept.append((first, last, priority, rule))
        return sorted(kept)

    def test_against_all_pairs(self):
        rng = random.Random(6)
        for _ in range(300):
            found = [(a := rng.randint(0, 30), a + rng.randint(0, 12), rng.randint(1, 4), rng.randint(0, 5)) for _ in range(rng.randint(0, 40))]
            assert licenses.suppressed(found) == self.plain(found)

    def test_a_million_detections(self):
        found = [(3 * i, 3 * i + 2, 2 + i % 3, i % 50) for i in range(300_000)]
        assert len(licenses.suppressed(found)) == 300_000


class TestToxicity:
    def test_held_out(self, spark):
        got = registry.QUERIES["op5_toxicity"](spark, SMALL)
        labels = spark.read.parquet(f"{SMALL}/labels.parquet")
        right = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0]
        assert got.count() == 1000 and right > 0.9
        assert got.where("score IS NULL OR score < 0 OR score > 1").count() == 0

    def test_label_model_overrules_a_wrong_annotation(self):
        rng = np.random.default_rng(2)
        truth = rng.random(600) < 0.3
        votes = np.stack([np.where(truth, rng.random(600) < 0.9, rng.random(600) < 0.005) for _ in range(5)], axis=1).astype(float)
        said = truth.copy()
        said[np.flatnonzero(truth)[0]] = False
        posterior = toxicity.label_model(votes, said)
        assert ((posterior > 0.5) == truth).mean() > 0.99

    def test_edges(self, spark, documents):
        model = toxicity.learn_toxicity(documents.withColumn("toxic", F.lit(None).cast("int")))
        rows = toxicity.score_toxicity(documents, model).collect()
        assert len(rows) == documents.count() and {r.toxic_score for r in rows} == {0.5}
        one = toxicity.learn_toxicity(documents.withColumn("toxic", F.lit(0)))
        assert all(r.toxic_score < 0.5 for r in toxicity.score_toxicity(documents, one).collect())
        assert toxicity.score_toxicity(documents.limit(0), model).collect() == []


class TestQuality:
    def test_held_out(self, spark):
        got = registry.QUERIES["op8_quality"](spark, SMALL)
        labels = spark.read.parquet(f"{SMALL}/labels.parquet")
        right = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
        assert got.count() == 1000 and right > 0.9

    def test_tables_learn_an_interaction(self):
        rng = np.random.default_rng(3)
        x = rng.random((4000, len(quality.FEATURES))).astype(np.float32)
        y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
        score = quality.AdditiveModel(quality.fit_additive(x, y)).score(x)
        assert ((score > 0.5) == (y > 0.5)).mean() > 0.9

    def test_edges(self, spark, documents):
        assert np.isfinite(quality.text_features(pa.array(["", " ", "\n\n", "a", "é" * 50_000, "A B\nA B"]))).all()
        none = quality.learn_quality(documents.withColumn("quality", F.lit(None).cast("int")))
        rows = quality.score_quality(documents, none).collect()
        assert len(rows) == documents.count() and {r.score for r in rows} == {0.5}
        assert quality.score_quality(documents.limit(0), none).collect() == []


class TestLicenses:
    def brute(self, text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places, labels = [], set()
        for phrase, label in licenses.BASE:
            own = phrase.split()
            at = [i for i in range(len(words)) if words[i:i + len(own)] == own]
            places += at
            labels |= {label} if at else set()
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))

    def test_base_against_brute_force(self, spark, documents):
        rng = random.Random(7)
        parts = ["MIT", "License", "license,", "cc", "-by", "by", "GNU General", "Public_License", "Apache", "é", "\n", "x"]
        texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)]
        rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000 + i, t) for i, t in enumerate(texts)]
        frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, labels string")
        got = licenses.scan_licenses(frame).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == self.brute(r.text)
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))

    @pytest.mark.parametrize("text,labels", [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("SPDX-License-Identifier: GPL-3.0-only", "gpl-3.0"),
        ("released under CC BY-SA 4.0", "cc-by,cc-by-sa-4.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("nothing of the kind", ""),
    ])
    def test_rules(self, text, labels):
        got = licenses.Scanner(None).scan(pa.array([text]))[5][0]
        assert set(labels.split(",")) <= set(got.split(","))

    def test_statements_are_found(self):
        plain = [s for s in licenses.STATEMENTS if re.fullmatch(r"[a-z0-9 ]+", s[2])]
        assert len(plain) > 120
        scanner = licenses.Scanner(None)
        for label, keyword, pattern, *_ in plain:
            assert keyword in pattern.split(), pattern
            found = scanner.scan(pa.array([f"Some text, then: {pattern.upper()}. And more."]))[5][0].split(",")
            assert label in found, (pattern, found)

    def matching(self, parsed, rng):
        """A random text that a parsed pattern matches."""
        made = ""
        for op, value in parsed:
            name = str(op)
            if name == "LITERAL":
                made += chr(value)
            elif name == "IN":
                kind, what = rng.choice(value)
                made += chr(what) if str(kind) == "LITERAL" else "7"
            elif name == "BRANCH":
                made += self.matching(rng.choice(value[1]), rng)
            elif name == "SUBPATTERN":
                made += self.matching(value[-1], rng)
            elif name == "MAX_REPEAT":
                made += "".join(self.matching(value[2], rng) for _ in range(rng.randint(value[0], min(value[1], 2))))
            else:
                assert name == "ASSERT"
        return made

    def test_keywords_leave_no_rule_out(self):
        rng, gated, every = random.Random(8), licenses.Scanner(None), licenses.Scanner(None)
        every.gate, every.by_keyword = re.compile("^"), {"": list(range(len(licenses.rules())))}
        for rule in licenses.rules():
            parsed = re._parser.parse(rule.pattern.pattern)
            for text in {self.matching(parsed, rng) for _ in range(8)}:
                assert rule.pattern.search(f" {text} ") and rule.keyword in text.split()
                labels, score = every.scan_words(text.split())[2:]
                got = gated.scan(pa.array([text]))
                assert labels and (got[5][0], got[6][0]) == (",".join(sorted(labels)), score)

    @pytest.mark.parametrize("name", ["BSL-1.0", "OFL-1.1", "OSL-3.0", "AFL-3.0", "MS-PL", "MS-RL", "PSF-2.0", "ODbL-1.0", "BUSL-1.1", "SSPL-1.0", "EDL-1.0", "CPL-1.0", "IPL-1.0"])
    def test_spdx_names(self, name):
        got = licenses.Scanner(None).scan(pa.array([f"// SPDX-License-Identifier: {name}"]))
        assert got[5][0].startswith(name.lower()[:3]) and got[6][0] > 0.9

    def test_suppression(self):
        inner, outer, strong = (5, 6, 2, 0), (3, 9, 2, 1), (4, 5, 5, 2)
        assert licenses.suppressed([inner, outer]) == [outer]
        assert licenses.suppressed([inner, outer, strong]) == [strong, inner]
        assert licenses.suppressed([(0, 3, 1, 4), (0, 3, 1, 2)]) == [(0, 3, 1, 2)]


class TestPipeline:
    def test_stages(self, spark, tmp_path):
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs
            stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            assert docs.columns == before.columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
            if name == "minhash_dedup":
                kept = {r.doc_id for r in near_duplicates(before).where("kept").collect()}
                assert {r.doc_id for r in docs.collect()} == kept
        _, pack = corpus_pipeline.STAGES[-1]
        packed = pack(spark, docs, SMALL)
        assert packed.select("doc_id").distinct().count() == docs.count()
        assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0

    def test_language_decides(self, spark):
        """The same texts go or stay as their language is wanted; none goes otherwise."""
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        lettered = docs.where(F.col("text").rlike(r"\p{L}"))
        kept = corpus_pipeline.keep_languages(spark, docs, SMALL)
        assert kept.count() == lettered.count() and kept.join(lettered, "doc_id", "left_anti").count() == 0
        some = corpus_pipeline.keep_languages(spark, docs, SMALL, wanted=["de", "fr"])
        assert some.columns == docs.columns
        counts = {r.lang: r["count"] for r in some.groupBy("lang").count().collect()}
        true = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
        assert sum(counts.get(x, 0) for x in ("en", "es")) <= 2 and all(abs(counts[x] - true[x]) <= 2 for x in ("de", "fr"))
        assert corpus_pipeline.keep_languages(spark, docs, SMALL, lowest=1.01).count() == 0

    def test_run_returns_the_last_stage(self, spark, monkeypatch):
        seen = []

        def stage(name, keep):
            return name, lambda session, docs, sf_dir: seen.append((name, docs.count())) or docs.where(keep)

        monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("a", "doc_id < 500"), stage("b", "doc_id % 2 = 0"), stage("c", "doc_id > 10")])
        assert corpus_pipeline.run(spark, SMALL).count() == 244 and seen == [("a", 1000), ("b", 500), ("c", 250)]

    def test_rows_without_an_own_id(self, spark):
        rng = random.Random(10)
        words = [f"w{i}" for i in range(3000)]
        text = lambda: [rng.choice(words) for _ in range(100)]
        alone = [(i if i % 3 else None, " ".join(text())) for i in range(60)]  # a third has no id
        alone += [(1000, " ".join(text())) for _ in range(5)] + [(None, "short one")]
        groups = []
        for ids in ([None, 2000, None], [None, None], [2001, 2001], [3000, 2002, 1000]):
            base = text()
            groups.append([(i, " ".join([*base[:98], f"x{k}", "y"])) for k, i in enumerate(ids)])
        copies = [(None, " ".join(text()))] * 3
        rows = [*alone, *copies, *(r for g in groups for r in g)]
        rng.shuffle(rows)
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
        got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()]
        assert set(alone) <= set(got) and len(got) == len(set(got)) == len(alone) + 1 + len(groups)
        assert copies[0] in got and [sum(r in got for r in g) for g in groups] == [1] * len(groups)
        assert [i for g in groups for i, t in got if (i, t) in g] == [None, None, 2001, 1000]

    def test_nothing_learned(self, spark, monkeypatch):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        texts = ["one two three", "vier fünf", "é", "12 34", "", None, "you idiot"]
        docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], schema)
        lettered = {0, 1, 2, 6}
        assert {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs, SMALL).collect()} == lettered
        none = spark.createDataFrame([], "doc_id bigint, toxic int")
        for labels in (none, spark.createDataFrame([(99, 1)], none.schema)):
            monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_, found=labels: found)
            assert corpus_pipeline.drop_toxic(spark, docs, SMALL).count() == len(texts)
        only = spark.createDataFrame([(i, 1) for i in range(7)], none.schema)  # no clean row
        monkeypatch.setattr(corpus_pipeline, "read_table", lambda *_: only)
        assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SMALL).collect()} >= {0, 1, 2, 3, 4, 5}
