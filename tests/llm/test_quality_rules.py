"""Operator 11: measures, sketches and verdicts against plain Python, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.llm import oracle
from gleanery.llm.quality_rules import (
    FEATURES, LEAST, MEASURES, REACH, bin_of, judged_documents, kept_documents, least_in_bin, op11_quality_rules, quartiles, sketches,
    with_measures,
)
from tests.oracle_check import compare, oracle_connection

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string, kept int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(3)


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    runs = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + o for i in range(len(words) - 4) if runs[tuple(words[i:i + 5])] > 1 for o in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered))


def values(m):
    n, chars, symbols, lines, dup, rep = m
    return {"word_length": chars * 100 // n, "symbols": symbols * 1000 // n, "repeated_words": rep * 1000 // n, "repeated_lines": dup * 1000 // lines}


def floor_of_bin(v):
    shift = max(0, v.bit_length() - 6)
    return v >> shift << shift


def brute_kept(rows):
    """Verdicts by exact quartiles, each rounded down as its bin does."""
    pools = defaultdict(list)
    for _, text, lang, source in rows:
        if (m := brute(text))[0]:
            for name, v in values(m).items():
                for group in ((lang, source), (lang,), ()):
                    pools[group, name].append(v)
    out = []
    for _, text, lang, source in rows:
        m = brute(text)
        base = m[0] < 10 or 100 * m[5] > 20 * m[0]
        kept = not base
        if m[0]:
            for name, v in values(m).items():
                group = next(g for g in ((lang, source), (lang,), ()) if g == () or len(pools[g, name]) >= LEAST)
                pool = sorted(pools[group, name])
                q1, q3 = (floor_of_bin(pool[-(-q * len(pool) // 4) - 1]) for q in (1, 3))
                spread = REACH * max(q3 - q1, FEATURES[name][1])
                kept &= v <= q3 + spread and (not FEATURES[name][2] or v >= q1 - spread)
        out.append((base, kept))
    return out


ODD = [None, "", " \n\t\x0b\x0c\r", "one", "a b c d e", "a b c d e a b c d e", "x x x x x x x", "##\n##\n##  \n ##", "é ü ß z # | <", "a\nb\n\na\nb \r\nb"]


class TestMeasures:
    def test_against_python(self, spark):
        rng = random.Random(1)
        texts = ODD + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
        texts += ["\n".join(rng.choice(["a b", "c", " ", "a  b", "$ %"]) for _ in range(rng.randint(0, 12))) for _ in range(40)]
        df = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
        got = with_measures(df.select("doc_id", "text")).select("doc_id", "_q.*").collect()
        assert {r.doc_id: tuple(r[m] for m in MEASURES) for r in got} == {i: brute(t) for i, t in enumerate(texts)}

    def test_very_long_text(self, spark):
        rng = random.Random(2)
        text = " ".join(f"w{rng.randint(0, 40)}" for _ in range(200_000)) + " q" * 100_000
        got = with_measures(spark.createDataFrame([(text,)], "text string")).select("_q.*").first()
        assert tuple(got) == brute(text)

    def test_no_python_and_no_shuffle_on_the_way(self, spark):
        plan = with_measures(table(spark, [(1, "a", "b", "c")]).select("doc_id", "text")).repartition(1)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2  # those of the fixture and the test

    def test_clashing_names(self, spark):
        with pytest.raises(ValueError, match="_q_words"):
            with_measures(spark.createDataFrame([("a", 1)], "text string, _q_words int"))


class TestSketch:
    def test_bins_keep_five_bits(self, spark):
        numbers = [0, 1, 31, 32, 63, 64, 65, 127, 128, 1000, 12345, 1 << 40, (1 << 50) - 1]
        rows = spark.createDataFrame([(n,) for n in numbers], "v bigint").select("v", least_in_bin(bin_of(F.col("v"))).alias("low")).collect()
        assert {r.v: r.low for r in rows} == {n: floor_of_bin(n) for n in numbers}

    def test_quartiles_are_those_of_the_binned_values(self, spark):
        rng = random.Random(4)
        texts = [" ".join("x" * rng.randint(1, 40) for _ in range(rng.randint(1, 30))) for _ in range(237)]
        slim = with_measures(table(spark, [(i, t, "en", None) for i, t in enumerate(texts)]).select("doc_id", "lang", "source", "text"))
        got = {r.feature: (r.n, r.q1, r.q3) for r in quartiles(sketches(slim.select("lang", "source", "_q.*")), "lang", "source").collect()}
        for name in FEATURES:
            pool = sorted(floor_of_bin(values(brute(t))[name]) for t in texts)
            assert got[name] == (237, pool[-(-237 // 4) - 1], pool[-(-3 * 237 // 4) - 1])


class TestVerdicts:
    def rows(self):
        rng = random.Random(5)
        rows = []
        for i in range(600):
            lang, source = rng.choice(["en", "de", None]), rng.choice(["hot"] * 6 + ["s1", None])
            words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 60))]
            if i % 17 == 0:
                words = [w + "#$" for w in words]
            if i % 23 == 0:
                words = [w * 6 for w in words]
            rows.append((i, " ".join(words) + ("\nsame\nsame\nsame" if i % 31 == 0 else ""), lang, source))
        return rows + [(None, ODD[6], "xx", "rare"), (3, *rows[3][1:]), (9001, None, "zz", "none"), (9002, "", None, None)]

    def test_against_python(self, spark):
        rows = self.rows()
        got = judged_documents(table(spark, rows)).collect()
        expected = [(i, brute(t)[0], *brute(t)[1:3], *brute(t)[4:], *verdict) for (i, t, _, _), verdict in zip(rows, brute_kept(rows))]
        assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
        assert 0 < sum(r.kept for r in got) < sum(not r.base_failed for r in got)

    def test_kept_documents_carry_all_columns(self, spark):
        rows = self.rows()
        got = kept_documents(table(spark, rows))
        assert got.columns == ["doc_id", "text", "lang", "source", "n_words", "kept"]
        expected = [(*r, "x", 3) for r, (_, kept) in zip(rows, brute_kept(rows)) if kept]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)

    def test_empty_table(self, spark):
        assert judged_documents(table(spark, [])).collect() == [] and kept_documents(table(spark, [])).collect() == []
        assert [r.kept for r in judged_documents(table(spark, [(1, None, None, None)])).collect()] == [False]

    def test_query_and_sql(self, spark):
        folder = "/root/testdata/sf0.01"
        assert compare(spark, oracle_connection(folder), folder, "op11", op11_quality_rules, oracle.OP11) is None
        labels = spark.read.parquet(f"{folder}/labels.parquet")
        good = op11_quality_rules(spark, folder).where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
        kept = {r.quality: r.kept for r in good.collect()}
        assert kept[1] > 0.99 and kept[0] < 0.1
