"""Quality scores by a generalised additive model with pairwise interactions (operator 8).

Texts become a few dozen shape features: shares of character kinds, word lengths and
repetition, lines and their repetition. Each feature is cut into bins; cyclic boosting
of shallow trees, one feature after another, builds a lookup table per feature, then a
table per chosen pair of features on what is left. A score is the sum of the values that
a text's bins select, through a logistic.

Fitted on a bounded sample of labelled rows, about ``max_rows``; all rows are scored.
Null text is the empty text, whose features are zero. Without labelled rows, or with one
label only, every score is the smoothed share of label 1. Rows are independent.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import chunks, read_table, scored, ship_package
from gleanery.llm.words import remainder, sample_fraction

MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, RIDGE, LEAVES = 150, 60, 0.15, 2.0, 4

KINDS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!?",
    b"\"'();:-", b"#$%&*+=<>@^~`", b"|_/\\[]{}",
)
FEATURES = (
    "lower", "upper", "digit", "space", "newline", "stop", "comma", "shout", "mark", "symbol", "bar", "other",
    "chars", "words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "word_again",
    "lines", "line_length", "lines_again", "capital_words", "symbol_words", "word_run",
)


def _by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return np.diff(total[np.concatenate([[0], np.cumsum(sizes)])])


def _pairs(of: np.ndarray, item: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items of each text and the largest count of one."""
    if not len(of):
        return np.zeros(texts), np.zeros(texts)
    both, counts = np.unique(of * (int(item.max()) + 1) + item, return_counts=True)
    owner = both // (int(item.max()) + 1)
    most = np.zeros(texts)
    np.maximum.at(most, owner, counts)
    return np.bincount(owner, minlength=texts).astype(float), most


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    n = len(texts)
    raw = texts.cast(pa.large_binary())
    cuts = np.frombuffer(raw.buffers()[1], np.int64, n + 1, raw.offset * 8)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[cuts[0]:cuts[-1]]
    sizes = np.diff(cuts)
    kind = np.full(256, len(KINDS), np.uint8)
    for i, members in enumerate(KINDS):
        kind[list(members)] = i
    of_byte = kind[data]
    chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
    shares = np.stack([_by_text(of_byte == i, sizes) for i in range(len(KINDS) + 1)], axis=1) / np.maximum(sizes, 1)[:, None]

    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy()
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    capital = pc.match_substring_regex(words, r"^\p{Lu}").to_numpy(zero_copy_only=False)
    signs = pc.match_substring_regex(words, r"[^\p{L}\p{N}\s]{2,}$").to_numpy(zero_copy_only=False)
    of_word = np.repeat(np.arange(n), count)
    again = np.zeros(len(at), bool)
    again[1:] = (at[1:] == at[:-1]) & (of_word[1:] == of_word[:-1])
    distinct, most = _pairs(of_word, at, n)
    some = np.maximum(count, 1)
    word_shares = [_by_text(v[at], count) / some for v in (length, length > 8, length < 4)]

    line_lists = pc.split_pattern(texts, "\n")
    line_count = pc.list_value_length(line_lists).to_numpy(zero_copy_only=False).astype(np.int64)
    line_coded = line_lists.flatten().dictionary_encode()
    of_line = np.repeat(np.arange(n), line_count)
    distinct_lines, _ = _pairs(of_line, line_coded.indices.to_numpy().astype(np.int64), n)
    columns = [
        *shares.T, np.log1p(chars), np.log1p(count), *word_shares, distinct / some, most / some, _by_text(again, count) / some,
        np.log1p(line_count), np.log1p(chars / line_count), 1 - distinct_lines / line_count,
        _by_text(capital[at], count) / some, _by_text(signs[at], count) / some, np.log1p(most),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _tree(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Leaf value of each bin of a tree with LEAVES leaves at most."""
    cuts = [0, len(gain)]
    g, h = np.concatenate([[0], np.cumsum(gain)]), np.concatenate([[0], np.cumsum(weight)])
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    while len(cuts) <= LEAVES:
        best = (1e-9, 0)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                m = np.arange(a + 1, b)
                more = worth(a, m) + worth(m, b) - worth(a, b)
                i = int(more.argmax())
                best = max(best, (float(more[i]), int(m[i])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    leaf = [(g[b] - g[a]) / (h[b] - h[a] + RIDGE) for a, b in zip(cuts[:-1], cuts[1:])]
    return np.repeat(leaf, np.diff(cuts))


def _pair_tree(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Cell values of the best tree that cuts either side once."""
    g = np.zeros((PAIR_BINS + 1, PAIR_BINS + 1))
    h = g.copy()
    g[1:, 1:], h[1:, 1:] = gain.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    i, j = np.meshgrid(np.arange(1, PAIR_BINS), np.arange(1, PAIR_BINS), indexing="ij")

    def quarters(s):
        low, left, top = s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j]
        return np.stack([low, left, top, s[-1, -1] - low - left - top])

    leaf = quarters(g) / (quarters(h) + RIDGE)
    best = int((leaf * quarters(g)).sum(0).argmax())
    a, b = i.ravel()[best], j.ravel()[best]
    cell = leaf.reshape(4, -1)[:, best]
    out = np.empty((PAIR_BINS, PAIR_BINS))
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = cell
    return out


class AdditiveModel:
    """Edges and lookup tables; ``state`` is plain data."""

    def __init__(self, state: dict):
        self.state = state

    def score(self, features: np.ndarray) -> np.ndarray:
        s = self.state
        total = np.full(len(features), s["base"])
        for f, (edges, table) in enumerate(zip(s["edges"], s["tables"])):
            total += table[np.searchsorted(edges, features[:, f], side="right")]
        for (a, b), table in s["pairs"]:
            total += table[tuple(np.searchsorted(s["coarse"][f], features[:, f], side="right") for f in (a, b))]
        return 1 / (1 + np.exp(-total))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        score = self.score(text_features(texts)) if len(texts) else np.zeros(0)
        return (score,)


def fit_additive(features: np.ndarray, label: np.ndarray) -> dict:
    """Edges and tables from a sample that fits in memory."""
    share = (label.sum() + 1) / (len(label) + 2)
    state = {"base": float(np.log(share / (1 - share))), "edges": [], "tables": [], "coarse": [], "pairs": []}
    if len(np.unique(label)) < 2:
        return state
    # edges lie between values, so equal values share a bin in float32 and float64
    edges_of = lambda x, bins: np.unique(np.quantile(x, np.arange(1, bins) / bins).astype(np.float32))
    columns = features.T
    state["edges"] = [edges_of(x, BINS) for x in columns]
    state["coarse"] = [edges_of(x, PAIR_BINS) for x in columns]
    bins = [np.searchsorted(e, x, side="right") for e, x in zip(state["edges"], columns)]
    coarse = [np.searchsorted(e, x, side="right") for e, x in zip(state["coarse"], columns)]
    tables = [np.zeros(len(e) + 1) for e in state["edges"]]
    total = np.full(len(label), state["base"])
    for _ in range(ROUNDS):
        for b, table in zip(bins, tables):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _tree(np.bincount(b, label - p, len(table)), np.bincount(b, p * (1 - p), len(table)))
            table += step
            total += step[b]
    cells = lambda a, b, v: np.bincount(coarse[a] * PAIR_BINS + coarse[b], v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
    p = 1 / (1 + np.exp(-total))

    def worth(pair):
        g, h = cells(*pair, label - p), cells(*pair, p * (1 - p))
        return float((_pair_tree(g, h) * g).sum())

    chosen = sorted(combinations(range(len(bins)), 2), key=worth, reverse=True)[:PAIRS]
    grids = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in chosen]
    for _ in range(PAIR_ROUNDS):
        for (a, b), grid in zip(chosen, grids):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _pair_tree(cells(a, b, label - p), cells(a, b, p * (1 - p)))
            grid += step
            total += step[coarse[a], coarse[b]]
    state["tables"], state["pairs"] = tables, list(zip(chosen, grids))
    return state


def learn_quality(labelled: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """The model from rows (doc_id, text, quality) with a label."""
    usable = labelled.where("quality IS NOT NULL")
    share = min(1.0, max_rows / max(1, usable.count()))

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                made = text_features(pc.fill_null(part.column("text"), ""))
                values = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("quality"), values], names=["quality", "features"])

    ship_package(labelled.sparkSession)
    # equal rows are sampled together and count once, or copies of one could be all of the sample
    sample = usable.where(sample_fraction(F.lit(share), F.col("doc_id"), F.col("text"))).dropDuplicates(["doc_id", "text", "quality"])
    sample = sample.select("text", F.col("quality").cast("int"))
    rows = sample.mapInArrow(run, "quality int, features array<float>").toPandas()  # about max_rows
    if rows.empty:
        return fit_additive(np.zeros((0, len(FEATURES))), np.zeros(0))
    order = np.lexsort(np.stack(rows["features"]).T)  # a fixed order, so sums do not vary
    return fit_additive(np.stack(rows["features"])[order], (rows["quality"].to_numpy()[order] == 1).astype(float))


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    return scored(docs, model, AdditiveModel, "score double", AdditiveModel.of_texts)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    held = remainder(F.col("doc_id"), 4) == 2
    model = learn_quality(docs.select("doc_id", "text").where(~held).join(labels, "doc_id"))
    texts = docs.select("doc_id", held.alias("held_out"), "text")
    return score_quality(texts, model).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
