"""Toxicity by weak supervision (operator 5).

Voters say "toxic" or nothing about a text:

* lexicon voters, a hand-written list of insults and threats, and words or word
  beginnings that stand out in toxic rows of the training sample (a log-likelihood ratio
  above what chance would give once among all candidates);
* pattern voters, regular expressions over the lower-cased text;
* the annotation of a training row, with given error rates.

A generative label model estimates by expectation maximisation how often each voter
speaks on toxic and on clean texts, and from what it leaves unexplained which voters go
together; the evidence of a voter is divided by its total correlation with others, so
ten beginnings of one word count about once. Its posterior labels train a linear
classifier on the voters of the text alone, which scores every row.

The sample is bounded: about ``max_rows`` labelled rows; of the CANDIDATES words that
stand out most, ``max_voters`` become voters.
Null text is the empty text: no voter speaks. Without labelled rows every score is the
smoothed share of toxic ones, 0.5. Words are stretches of letters. Rows are independent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import chunks, mapped, read_table, scored, ship_package
from gleanery.llm.words import letter_words, remainder, sample_fraction

MAX_ROWS, MAX_VOTERS = 10_000, 400
CANDIDATES = 20_000
# How often an annotation says toxic on toxic and on clean texts.
ANNOTATED = (0.97, 0.01)
PREFIXES = (3, 4, 5, 6)
ROUNDS, STEPS, RIDGE = 8, 15, 1e-5

# Common insults and threats of English; fixed words of the lexicon voters.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "trash", "scum", "clown", "pathetic", "worthless", "disgusting", "dumb", "imbecile",
    "jerk", "creep", "freak", "coward", "liar", "filth", "garbage", "vermin", "parasite", "degenerate", "hate", "despise",
    "kill", "ugly", "fool", "retard", "bastard", "bitch", "asshole", "shit", "fuck", "fucking", "damn", "whore", "slut",
)
PATTERNS = (
    r"\byou(?:'re| are)? (?:an? |such an? |so )?(?:idiot|moron|loser|fool|stupid|pathetic|worthless|disgusting)",
    r"\bshut (?:up|your)\b",
    r"\bgo (?:to hell|away and die|die)\b",
    r"\b(?:i|we) (?:will|am going to|are going to) (?:kill|hurt|find) you",
    r"\b(?:piece of|bunch of) (?:shit|crap|trash|garbage)",
    r"\b[a-z]+[*@#$]{2,}[a-z]*\b",
    r"\bkill your ?self\b",
)


def word_features(word: str) -> list[str]:
    """The word itself, closed by a mark, and its beginnings."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def present(texts: pa.Array, number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, voter) pairs of lexicon voters."""
    words, at, sizes = letter_words(texts)
    votes = [[number[f] for f in word_features(w) if f in number] for w in words]
    counts = np.fromiter(map(len, votes), np.int64, len(votes))
    flat = np.fromiter((v for own in votes for v in own), np.int64, int(counts.sum()))
    starts = np.cumsum(counts) - counts
    speaks = counts[at] > 0
    of, at = np.repeat(np.arange(len(sizes)), sizes)[speaks], at[speaks]
    each = counts[at]
    place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    keys = np.unique(np.repeat(of, each) * (len(number) + 1) + flat[np.repeat(starts[at], each) + place])
    return keys // (len(number) + 1), keys % (len(number) + 1)


class ToxicScorer:
    """Weights of voters; patterns follow the lexicon."""

    def __init__(self, state: dict):
        self.state = state
        self.number = {name: i for i, name in enumerate(state["lexicon"])}

    def votes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, voters = [], []
        of, voter = present(texts, self.number)
        rows.append(of), voters.append(voter)
        lower = pc.utf8_lower(texts)
        for i, pattern in enumerate(PATTERNS):
            said = np.flatnonzero(pc.match_substring_regex(lower, pattern).to_numpy(zero_copy_only=False))
            rows.append(said), voters.append(np.full(len(said), len(self.number) + i))
        return np.concatenate(rows), np.concatenate(voters)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        rows, voters = self.votes(texts)
        total = self.state["base"] + np.bincount(rows, self.state["weights"][voters], len(texts))
        return (1 / (1 + np.exp(-np.clip(total, -50, 50))),)


def label_model(votes: np.ndarray, annotation: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior of the true label from a 0/1 matrix of voters and the annotations, whose
    own error rates are given; those of the voters are estimated."""
    said = np.where(annotation, np.log(ANNOTATED[0] / ANNOTATED[1]), np.log((1 - ANNOTATED[0]) / (1 - ANNOTATED[1])))
    posterior = np.where(annotation, 0.99, 0.01)
    for _ in range(rounds):
        toxic, clean = posterior.sum(), (1 - posterior).sum()
        on_toxic = (posterior @ votes + 0.05) / (toxic + 1)
        on_clean = ((1 - posterior) @ votes + 0.05) / (clean + 1)
        # what the two classes leave unexplained shows which voters go together
        left = [(votes - mean) * np.sqrt(weight)[:, None] for mean, weight in ((on_toxic, posterior), (on_clean, 1 - posterior))]
        covariance = (left[0].T @ left[0] + left[1].T @ left[1]) / len(votes)
        deviation = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = np.clip(covariance / np.outer(deviation, deviation), 0, 1)
        correlation[correlation < 0.1] = 0
        np.fill_diagonal(correlation, 1)
        spoken = np.log(on_toxic / on_clean) / correlation.sum(axis=1)
        silent = np.log((1 - on_toxic) / (1 - on_clean)) / correlation.sum(axis=1)
        share = (toxic + 1) / (len(votes) + 2)
        evidence = np.log(share / (1 - share)) + said + votes @ (spoken - silent) + silent.sum()
        posterior = 1 / (1 + np.exp(-np.clip(evidence, -30, 30)))
    return posterior


def fit_linear(votes: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton steps."""
    share = (target.sum() + 1) / (len(target) + 2)
    table = np.hstack([votes, np.ones((len(votes), 1))])
    weights = np.zeros(table.shape[1])
    weights[-1] = np.log(share / (1 - share))
    ridge = np.diag(np.append(np.full(votes.shape[1], RIDGE), 1e-9))

    def loss(w: np.ndarray) -> float:
        z = table @ w
        return float((np.logaddexp(0, z) - target * z).mean() + w @ ridge @ w / 2)

    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(table @ weights, -30, 30)))
        slope = table.T @ (p - target) / len(target) + ridge @ weights
        curve = (table * (p * (1 - p) + 1e-6)[:, None]).T @ table / len(target) + ridge
        move, now, pace = np.linalg.solve(curve, slope), loss(weights), 1.0
        while pace > 1e-4 and loss(weights - pace * move) > now:
            pace /= 2
        weights = weights - pace * move
    return weights[:-1], float(weights[-1])


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): texts of either label that hold it."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                texts = pc.fill_null(part.column("text"), "")
                words, at, sizes = letter_words(texts)
                number: dict[str, int] = {}
                for word in words:
                    for feature in word_features(word):
                        number.setdefault(feature, len(number))
                rows, voters = present(texts, number)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)[rows] == 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(number), pa.string()), pa.array(np.bincount(voters[toxic], minlength=len(number))),
                     pa.array(np.bincount(voters[~toxic], minlength=len(number)))], names=["feature", "toxic", "clean"])

    ship_package(sample.sparkSession)
    made = mapped(sample, run, "feature string, toxic bigint, clean bigint")
    return made.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def standing_out(counts: DataFrame, toxic: int, clean: int, max_voters: int) -> list[str]:
    """Features more common in toxic texts than chance would give once among all."""
    tested = counts.where("toxic > 1")
    n = float(toxic + clean)
    part = lambda got, expected: F.when(got > 0, got * F.log(got / expected)).otherwise(0.0)
    all_of = F.col("toxic") + F.col("clean")
    ratio = 2 * (part(F.col("toxic"), all_of * (toxic / n)) + part(F.col("clean"), all_of * (clean / n))
                 + part(F.lit(toxic) - F.col("toxic"), (F.lit(n) - all_of) * (toxic / n))
                 + part(F.lit(clean) - F.col("clean"), (F.lit(n) - all_of) * (clean / n)))
    threshold = 2 * float(np.log(max(2, tested.count())))
    more = F.col("toxic") * clean > 2 * F.col("clean") * toxic
    rows = tested.where(more).withColumn("ratio", ratio).where(F.col("ratio") > threshold)
    found: dict[str, float] = {}
    for r in rows.orderBy(F.desc("ratio"), "feature").limit(CANDIDATES).collect():
        name, purity = r["feature"], r["toxic"] / (r["toxic"] + r["clean"])
        # a beginning that is as pure says all that a longer form would
        shorter = [name[:n] for n in PREFIXES if n < len(name)]
        if not any(s in found and found[s] >= purity - 0.02 for s in shorter):
            found[name] = purity
    return list(found)[:max_voters]


def learn_toxicity(labelled: DataFrame, max_rows: int = MAX_ROWS, max_voters: int = MAX_VOTERS) -> dict:
    """The scorer's state from rows (doc_id, text, toxic) with a label."""
    usable = labelled.where("toxic IS NOT NULL")
    share = min(1.0, max_rows / max(1, usable.count()))
    # equal rows are sampled together and count once, or copies of one could be all of the sample
    sample = usable.where(sample_fraction(F.lit(share), F.col("doc_id"), F.col("text"))).dropDuplicates(["doc_id", "text", "toxic"])
    sample = sample.select("text", F.col("toxic").cast("int"))
    size = {r["t"]: r["n"] for r in sample.groupBy((F.col("toxic") == 1).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(True, 0), size.get(False, 0)
    found = standing_out(feature_counts(sample), toxic, clean, max_voters) if toxic and clean else []
    lexicon = list(dict.fromkeys([*(w + "$" for w in LEXICON), *found]))
    voters = len(lexicon) + len(PATTERNS)
    state = {"lexicon": lexicon, "weights": np.zeros(voters), "base": 0.0}

    def run(batches):
        scorer = ToxicScorer(state)
        for batch in batches:
            for part in chunks(batch):
                rows, own = scorer.votes(pc.fill_null(part.column("text"), ""))
                order = np.argsort(rows, kind="stable")
                cuts = np.searchsorted(rows[order], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(own[order].astype(np.int32)))], names=["toxic", "voters"])

    rows = mapped(sample, run, "toxic int, voters array<int>").toPandas()  # about max_rows
    if not len(rows):
        return state
    rows = rows.iloc[np.argsort([",".join(map(str, (t, *v))) for t, v in zip(rows["toxic"], rows["voters"])], kind="stable")]
    votes = np.zeros((len(rows), voters))
    for i, own in enumerate(rows["voters"]):
        votes[i, own] = 1
    weights, base = fit_linear(votes, label_model(votes, rows["toxic"].to_numpy() == 1))
    return {"lexicon": lexicon, "weights": weights, "base": base}


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with toxic_score, the probability of label 1."""
    return scored(docs, model, ToxicScorer, "toxic_score double", ToxicScorer.score)


def learn_from_documents(docs: DataFrame, labels: DataFrame) -> dict:
    """The model from labelled rows outside the held-out fifth."""
    known = labels.select("doc_id", "toxic")
    return learn_toxicity(docs.select("doc_id", "text").where(remainder(F.col("doc_id"), 5) != 0).join(known, "doc_id"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn_from_documents(docs, read_table(spark, sf_dir, "labels"))
    texts = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    found = score_toxicity(texts, model).withColumnRenamed("toxic_score", "score")
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
