"""Operator 12: against a trie of plain dictionaries."""

import hashlib
import random
import zlib

import duckdb
import pytest

from gleanery.llm import oracle
from gleanery.llm.common import Scratch
from gleanery.llm.prefix_trie import SpillingQueue, op12_prefix_trie, prefix_trie
from gleanery.llm.running import running_sums
from tests.oracle_check import compare, oracle_connection

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, rep int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in own.items()}
    members = {}
    lengths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + own[c][h:]
        lengths[c] = len(turns)
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children.get(path, [])]
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        totals[path] = (sum(n for n, _ in below) or 1, own_saved + sum(s for _, s in below))
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if lengths[c] == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children.get(path, [])),
                    *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(frame):
    return sorted((tuple(r[n] for n in NAMES) for r in frame.collect()), key=repr)


def dialogues(rng, convs, words, longest):
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(words)))
    return rows


class TestTrie:
    def test_against_dictionaries(self, spark):
        rng = random.Random(1)
        rows = dialogues(rng, [*range(0, 60), 205, 206, 209, 1001], ["a", "b", "", None, "ü" * 9], 14)
        assert found(prefix_trie(table(spark, rows))) == brute(rows)

    def test_heavy_nodes_and_bands(self, spark):
        rng = random.Random(2)
        rows = dialogues(rng, range(40), ["a", "b"], 12)
        for c in (7, 13, 22):  # long chains that share much
            rows += [(c, turn, "user", "same" if turn < 70 else f"{c}") for turn in range(20, 90 + c)]
        # light subtrees of a few turns, bands of four levels: many pieces of the heavy tree
        assert found(prefix_trie(table(spark, rows), light_least=6, band_least=4)) == brute(rows)

    def test_one_conversation_holds_most_rows(self, spark):
        rows = [(11, turn, "user", f"t{turn % 5}") for turn in range(600)] + [(c, 0, "user", "t0") for c in range(10)]
        assert found(prefix_trie(table(spark, rows, 6), light_least=50, band_least=16)) == brute(rows)

    def test_equal_conversations(self, spark):
        rows = [(c, turn, "user", "hello") for c in range(300) for turn in range(10)]
        assert found(prefix_trie(table(spark, rows), light_least=20, band_least=4)) == brute(rows)

    def test_nulls_repeats_and_turnless(self, spark):
        rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "x"), (2, 0, "user", "x"), (2, 1, "user", "x" * 200_000),
                (3, 0, "u", "a"), (3, 1, "u", "a"), (-7, 0, "u", "a"), (2, 5, "user", "")]
        mine = [r for r in rows if r[0] is None or r[0] >= 0]
        assert found(prefix_trie(table(spark, mine))) == brute(mine)
        assert found(prefix_trie(table(spark, rows)))  # below zero the sign of c % 5 is Spark's
        repeated = mine + [(3, 1, "u", "a"), (3, 1, "u", "a")]
        assert found(prefix_trie(table(spark, repeated))) == brute(repeated)

    def test_empty_table(self, spark):
        assert found(prefix_trie(table(spark, []))) == []
        assert found(prefix_trie(table(spark, [(None, 1, "a", "b")]))) == []

    def test_ties_of_turn_do_not_depend_on_partitions(self, spark):
        rows = [(c, 0, "user", f"{k}") for c in range(6) for k in range(12)]
        assert found(prefix_trie(table(spark, rows, 1))) == found(prefix_trie(table(spark, rows[::-1], 5)))

    def test_query_and_sql(self, spark):
        folder = "/root/testdata/sf0.001"
        assert compare(spark, oracle_connection(folder), folder, "op12", op12_prefix_trie, oracle.OP12) is None
        whole = found(op12_prefix_trie(spark, folder))
        rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{folder}/conversations.parquet'").fetchall()
        assert whole == brute(rows)


class TestQueue:
    @pytest.mark.parametrize("limit", [1, 3, 50, 10_000])
    def test_sums_whatever_is_spilled(self, limit):
        rng = random.Random(limit)
        queue, sums = SpillingQueue(limit), {}
        for _ in range(500):
            key, value = (-rng.randint(5, 8), rng.randint(0, 9)), rng.randint(0, 1 << 70)
            queue.push((*key, 1, 2, value))
            old = sums.get(key, (0, 0, 0))
            sums[key] = (old[0] + 1, old[1] + 2, old[2] + value)
        for level in range(-8, -4):
            for rep in range(10):
                assert queue.take(level, rep) == sums.get((level, rep), (0, 0, 0))
        assert not queue.heap and not queue.heads


class TestRunningSums:
    def test_long_keys_over_many_ranges(self, spark):
        rng = random.Random(3)
        rows = [(rng.choice([1, 1, 1, 2, 3]), i, (1 << 62) - rng.randint(1, 1 << 61)) for i in range(3000)]
        scratch = Scratch(spark)
        df = scratch.keep(spark.createDataFrame(rows, "k bigint, at bigint, v bigint").repartition(4))
        got = running_sums(df, "k", ["at"], {"s": "v"}, scratch).collect()
        so_far, expected = {}, {}
        for k, at, v in rows:
            so_far[k] = (so_far.get(k, 0) + v) % (1 << 62)
            expected[at] = so_far[k]
        assert {r["at"]: r["s"] for r in got} == expected and len(got) == len(rows)
