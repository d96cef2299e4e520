"""Language identification by segmentation-marginalised unigrams (operator 6).

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, by the forward algorithm; a
text's is the product over its words. Piece probabilities come from expectation
maximisation over the same lattices: forward and backward sums give expected counts.

Learned from a bounded sample of labelled rows: about ``docs_per_lang`` documents of each
language, all their words unless ``max_words`` asks for the relatively most frequent only.
Everything else covers all rows.

Words are stretches of letters, lower-cased, of any length: sums are rescaled every STEP
places, so also a text written without spaces is summed over all its segmentations, in
memory that grows with its longest word. A letter outside the vocabulary is the unknown
piece. A text that is null or has
no letter is ``und`` with score 0, as is every text if nothing could be learned. The
score is the posterior of the predicted language under equal priors; ties go to the
first language by name. Rows are independent; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, built_once, mapped, read_table, scored, ship_package
from gleanery.llm.words import letter_words, remainder, sample_fraction, sums_by_text

UNDETERMINED = "und"
MARK = "▁"  # begins a word in the vocabulary
DOCS_PER_LANG, ROUNDS = 1000, 4
STEP = 16  # places between which sums are rescaled
CELLS = 1 << 19  # sums of a group of words
SHARES = 1 << 20  # parts of a use that sums are whole numbers of
SMOOTHING = 0.05
CACHE_BYTES = 72 << 20  # of words that a worker remembers


def vocabulary(model: str) -> list[str]:
    """Pieces of a public sentencepiece file, the unknown piece first."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    names = {pieces.id_to_piece(i) for i in range(pieces.get_piece_size())}
    own = {n.lower() for n in names if MARK not in n[1:] and not n.startswith("<")}
    return ["", *sorted(n for n in own if n and n != MARK)]


class Lattices:
    """All pieces that occur in words, as arcs (word, begin, end, piece)."""

    def __init__(self, pieces: list[str]):
        # a match is one number: its last place, then the piece's length and number
        self.piece_bits, self.length_bits = len(pieces).bit_length(), max(map(len, pieces)).bit_length()
        self.matcher = ahocorasick.Automaton()
        for number, name in enumerate(pieces):
            if name:
                self.matcher.add_word(name, len(name) << self.piece_bits | number)
        self.matcher.make_automaton()

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Last place, length and number of all pieces in a text."""
        shift = self.piece_bits + self.length_bits
        codes = np.fromiter((last << shift | value for last, value in self.matcher.iter(text)), np.int64)
        return codes >> shift, codes >> self.piece_bits & ((1 << self.length_bits) - 1), codes & ((1 << self.piece_bits) - 1)

    def arcs(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Arcs in order of their end, and each word's length. The word's mark is part of
        its first piece or, as an arc that costs nothing, alone."""
        joined = "".join([MARK + w for w in words])
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(lengths) - lengths
        last, size, piece = self._matches(joined)
        word = np.searchsorted(first, last, side="right") - 1
        end = last - first[word] + 1
        begin = end - size
        # letters that no piece of one letter covers are the unknown piece
        covered = np.zeros(len(joined), bool)
        covered[last[size == 1]] = True
        covered[first] = True
        bare = np.flatnonzero(~covered)
        of = np.searchsorted(first, bare, side="right") - 1
        place = bare - first[of]
        word, begin = np.concatenate([word, of]), np.concatenate([begin, place])
        end, piece = np.concatenate([end, place + 1]), np.concatenate([piece, np.zeros(len(bare), np.int64)])
        order = np.argsort(end, kind="stable")
        return word[order], begin[order], end[order], piece[order], lengths


def forward(arcs: tuple[np.ndarray, ...], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all paths from the start to each place, per word, place and language, as
    (alpha, logs): the sum is ``alpha * exp(logs[block])`` with STEP places to a block, so
    that no word is too long for a double."""
    word, begin, end, _, lengths = arcs
    size, langs = int(lengths.max(initial=1)) + 1, weight.shape[1]
    alpha = np.zeros((len(lengths), size, langs))
    logs = np.zeros((len(lengths), size // STEP + 1, langs))
    alpha[:, 0] = alpha[:, 1] = 1.0  # the mark alone costs nothing
    cuts = np.searchsorted(end, np.arange(size + 1))
    for place in range(2, size):
        block = place // STEP
        if place % STEP == 0:
            before = alpha[:, place - 1]
            logs[:, block] = logs[:, block - 1] + np.log(np.where(before > 0, before, 1.0))
        own = slice(cuts[place], cuts[place + 1])
        if own.start < own.stop:
            gained = alpha[word[own], begin[own]] * weight[own]
            if block:
                gained *= np.exp(logs[word[own], begin[own] // STEP] - logs[word[own], block])
            for lang in range(langs):
                alpha[:, place, lang] += np.bincount(word[own], gained[:, lang], len(lengths))
    return alpha, logs


def word_logs(alpha: np.ndarray, logs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-probabilities of whole words."""
    rows = np.arange(len(lengths))
    return np.log(np.maximum(alpha[rows, lengths], 1e-300)) + logs[rows, lengths // STEP]


def expected_counts(arcs: tuple[np.ndarray, ...], probability: np.ndarray, word_counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, per language, over all cuts of all words."""
    word, begin, end, piece, lengths = arcs
    weight = probability[piece]
    alpha, logs = forward(arcs, weight)
    beta, back = np.zeros_like(alpha), np.zeros_like(logs)
    beta[np.arange(len(lengths)), lengths] = 1.0
    order = np.argsort(begin, kind="stable")
    cuts = np.searchsorted(begin[order], np.arange(alpha.shape[1] + 1))
    for place in range(alpha.shape[1] - 1, -1, -1):
        block = place // STEP
        if place % STEP == STEP - 1 and place + 1 < alpha.shape[1]:
            after = beta[:, place + 1]
            back[:, block] = back[:, block + 1] + np.log(np.where(after > 0, after, 1.0))
        own = order[cuts[place]:cuts[place + 1]]
        if len(own):
            gained = beta[word[own], end[own]] * weight[own]
            gained *= np.exp(back[word[own], end[own] // STEP] - back[word[own], block])
            for lang in range(weight.shape[1]):
                beta[:, place, lang] += np.bincount(word[own], gained[:, lang], len(lengths))
    scale = logs[word, begin // STEP] + back[word, end // STEP] - word_logs(alpha, logs, lengths)[word]
    share = alpha[word, begin] * weight * beta[word, end] * np.exp(scale) * word_counts[word]
    return np.stack([np.bincount(piece, share[:, i], len(probability)) for i in range(weight.shape[1])], axis=1)


def normalised(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING
    return counts / counts.sum(axis=0)


def by_length(words: list[str], langs: int) -> Iterator[list[int]]:
    """Rows of words of similar length, as many as CELLS sums hold; a longer word alone."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    group: list[int] = []
    for row in np.argsort(lengths, kind="stable").tolist():
        if group and (len(group) + 1) * int(lengths[row]) * langs > CELLS:
            yield group
            group = []
        group.append(row)
    if group:
        yield group


class LanguageScorer:
    def __init__(self, model: dict):
        self.langs, self.probability = model["langs"], model["probability"]
        self.lattices = Lattices(model["pieces"])
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)))

    def of_words(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of words, one column per language."""
        if (len(self.rows) + len(words)) * (200 + 8 * len(self.langs)) > CACHE_BYTES:
            self.rows, self.scores = {}, np.zeros((0, len(self.langs)))
        new = [w for w in words if w not in self.rows]
        for group in by_length(new, len(self.langs)):
            part = [new[row] for row in group]
            arcs = self.lattices.arcs(part)
            made = word_logs(*forward(arcs, self.probability[arcs[3]]), arcs[4])
            self.rows.update(zip(part, range(len(self.scores), len(self.scores) + len(part))))
            self.scores = np.concatenate([self.scores, made])
        return self.scores[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, at, sizes = letter_words(texts)
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        totals = sums_by_text(self.of_words(words)[at], sizes)
        best = totals.argmax(axis=1)
        score = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        return [self.langs[b] if yes else UNDETERMINED for b, yes in zip(best, lettered)], np.where(lettered, score, 0.0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over rows (lang, text); counts of a batch are combined first."""

    def run(batches):
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                words, at, _ = letter_words(own.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(np.bincount(at, minlength=len(words)))],
                    names=["lang", "word", "n"])

    ship_package(docs.sparkSession)
    made = mapped(docs.select("lang", "text"), run, "lang string, word string, n bigint")
    return made.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn_languages(
    labelled: DataFrame, pieces: list[str], docs_per_lang: int = DOCS_PER_LANG, max_words: int | None = None, rounds: int = ROUNDS,
) -> dict:
    """The model from rows (doc_id, text, lang) with a language."""
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    langs = sorted(totals)
    if not langs:
        return {"langs": [], "pieces": pieces, "probability": np.zeros((len(pieces), 0))}
    share = F.create_map(*[F.lit(x) for n in langs for x in (n, min(1.0, docs_per_lang / totals[n]))])
    counted = word_counts(usable.where(sample_fraction(share[F.col("lang")], F.col("doc_id"), F.col("text"))))
    weight = F.create_map(*[F.lit(x) for n in langs for x in (n, 1.0 / min(totals[n], docs_per_lang))])
    if max_words is not None:
        counted = counted.orderBy(F.desc(F.col("n") * weight[F.col("lang")]), "word", "lang").limit(max_words)
    scratch = Scratch(labelled.sparkSession)
    number = F.create_map(*[F.lit(x) for i, n in enumerate(langs) for x in (n, i)])
    words = scratch.keep(counted.groupBy("word").agg(F.collect_list(F.struct(number[F.col("lang")].alias("lang"), "n")).alias("counts")))
    probability = normalised(piece_uses(words, pieces, len(langs), None))
    for _ in range(rounds):
        probability = normalised(piece_uses(words, pieces, len(langs), probability))
    scratch.drop(words)
    return {"langs": langs, "pieces": pieces, "probability": probability}


def piece_uses(words: DataFrame, pieces: list[str], langs: int, probability: np.ndarray | None) -> np.ndarray:
    """Expected uses of each piece per language over all cuts of rows (word, counts: list
    of (lang, n)); without probabilities, how often it could be used. Tasks sum over their
    words; the driver gets a number per piece and language. Sums are of whole numbers, in
    parts of SHARES, so that they do not depend on the order."""
    shared = words.sparkSession.sparkContext.broadcast({"pieces": pieces})

    def run(batches):
        used = np.zeros((len(pieces), langs))
        for batch in batches:
            names = batch.column("word").to_pylist()
            lists = batch.column("counts")
            row = np.repeat(np.arange(len(names)), lists.value_lengths().to_numpy(zero_copy_only=False))
            entries = lists.flatten()
            counts = np.zeros((len(names), langs))
            counts[row, entries.field("lang").to_numpy()] = entries.field("n").to_numpy()
            lattices = built_once(shared.value, lattices_of)
            for group in by_length(names, langs):
                arcs = lattices.arcs([names[r] for r in group])
                if probability is None:
                    used += np.stack([np.bincount(arcs[3], counts[group][arcs[0], i], len(pieces)) for i in range(langs)], axis=1)
                else:
                    used += expected_counts(arcs, probability, counts[group])
        piece, lang = np.nonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(np.rint(used[piece, lang] * SHARES).astype(np.int64))],
            names=["piece", "lang", "n"])

    sums = mapped(words, run, "piece int, lang int, n bigint").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
    shared.unpersist()
    made = np.zeros((len(pieces), langs))
    made[sums["piece"], sums["lang"]] = sums["n"] / SHARES
    return made


def lattices_of(model: dict) -> Lattices:
    return Lattices(model["pieces"])


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred and score."""
    return scored(docs, model, LanguageScorer, "lang_pred string, score double", LanguageScorer.predict)


def learn_from_documents(docs: DataFrame, vocabulary_path: str) -> dict:
    """The model from rows of ``docs`` outside the held-out quarter."""
    labelled = docs.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    return learn_languages(labelled, vocabulary(vocabulary_path))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    model = learn_from_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    texts = docs.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return identify(texts, model).select("doc_id", "held_out", "lang_pred", "score")
