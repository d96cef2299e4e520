"""Quality rules whose thresholds follow each language and source (operator 11), all as
DataFrame expressions.

Words are runs of anything but ASCII white space. Four measures are looked at as whole
numbers: word length (characters of 100 words), symbols, repeated words (of 1000 words) and
repeated lines (of 1000 lines).

* Every group of language and source has a mergeable sketch of each measure: counts per
  log-linear bin, 32 to an octave, so a quantile read from it is off by 1/32 at most, at
  any size and whatever the order of merging. Sketches of groups add up to sketches of
  languages, these to one of all documents. A group under LEAST documents goes by its
  language, a language under LEAST by all.
* A measure passes up to the third quartile plus REACH times the spread, word length also
  down to the first quartile minus that. The spread is the distance of the quartiles, at
  least the measure's own unit (FEATURES): where most documents have no symbol at all, a
  few are no reason to go.
* Measures meet the bounds of their group by a join. The bounds are a table, which Spark
  broadcasts only if its files are small; beyond that a hot source is a skewed join to split.

All documents with a word are in the sketches. Before that, the fixed base rule fails
documents under ten words, or with more than a fifth of their words in repeated runs of
five. Measures are of whole texts, on one row and without a shuffle; runs are compared by
64-bit hashes. Null text has no words and fails. Null language and null source are groups
like others. Rows that repeat count and are judged each on its own; a null doc_id is kept
as it is. An empty table gives no rows. ``kept_documents`` carries all other columns;
names that start with ``_q`` are its own, a clash raises ValueError.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, read_table

SPACE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
RUN = 5
FEWEST, MOST_REPEATED = 10, 20  # base rule: words, percent
# measure: (per, least spread, whether small values fail too)
FEATURES = {"word_length": (100, 80, True), "symbols": (1000, 50, False), "repeated_words": (1000, 60, False), "repeated_lines": (1000, 120, False)}
REACH, LEAST = 3, 100
FINE = 5  # bits of a value that its bin keeps
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_q`` of MEASURES. Each step is a projection of its own, so
    that no array is computed again for each of its elements."""
    taken = [c for c in docs.columns if c.startswith("_q")]
    if taken:
        raise ValueError(f"Rename these columns first: {taken}")
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    words = F.array_remove(F.split(F.translate(whole, SPACE, " " * len(SPACE)), " "), "")
    step = docs.select("*", lines.alias("_q_lines"), F.transform(words, lambda word: F.xxhash64(word)).alias("_q_words"))
    at = lambda i, k: F.get("_q_words", i + k)
    runs = F.transform(F.slice("_q_words", 1, F.greatest(F.size("_q_words") - (RUN - 1), F.lit(0))),
                       lambda word, i: F.xxhash64(word, *[at(i, k) for k in range(1, RUN)]))
    step = step.select("*", runs.alias("_q_runs"))
    twice = F.size(F.array_distinct("_q_runs")) < F.size("_q_runs")
    ordered = F.sort_array(F.transform("_q_runs", lambda run, i: F.struct(run.alias("run"), i.alias("at"))))
    step = step.select("*", F.when(twice, ordered).alias("_q_ordered"))
    beside = lambda j: F.get("_q_ordered", j)["run"]
    found = F.filter("_q_ordered", lambda x, j: (x["run"] == beside(j - 1)) | (x["run"] == beside(j + 1)))
    step = step.select("*", F.sort_array(F.transform(found, lambda x: x["at"])).alias("_q_places"))
    covered = F.transform("_q_places", lambda p, j: F.least(F.lit(RUN), F.coalesce(F.get("_q_places", j + 1) - p, F.lit(RUN))))
    repeated = F.coalesce(F.aggregate(covered, F.lit(0).cast("bigint"), lambda total, x: total + x), F.lit(0))
    values = (F.size("_q_words"), F.length(F.translate(whole, SPACE, "")), F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
              F.size("_q_lines"), F.size("_q_lines") - F.size(F.array_distinct("_q_lines")), repeated)
    packed = F.struct(*[value.cast("bigint").alias(name) for name, value in zip(MEASURES, values)])
    return step.select(*docs.columns, packed.alias("_q"))


def features(m: dict[str, Column]) -> dict[str, Column]:
    """The compared numbers of a document with a word; else null."""
    share = lambda part, whole, per: F.when(whole > 0, F.floor(part * per / whole))
    parts = {"word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "repeated_words": ("n_repeat_words", "n_words"),
             "repeated_lines": ("n_dup_lines", "n_lines")}
    return {name: share(m[part], m[whole], FEATURES[name][0]) for name, (part, whole) in parts.items()}


def bin_of(value: Column) -> Column:
    """Log-linear bin of a bigint from 0: its value below 2^FINE, then 2^FINE to an octave.
    ``bin`` writes the binary digits."""
    above = F.greatest(F.length(F.bin(value)) - (FINE + 1), F.lit(0))
    return (above * (1 << FINE)).cast("bigint") + F.floor(value / F.pow(F.lit(2.0), above))


def least_in_bin(number: Column) -> Column:
    """The smallest value of a bin."""
    above = F.greatest(F.floor(number / (1 << FINE)) - 1, F.lit(0))
    return ((number - above * (1 << FINE)) * F.pow(F.lit(2.0), above)).cast("bigint")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, feature, bin, docs) of rows (lang, source, MEASURES)."""
    made = features({name: F.col(name) for name in MEASURES})
    entries = F.array(*[F.struct(F.lit(name).alias("feature"), bin_of(value).alias("bin")) for name, value in made.items()])
    rows = measured.where("n_words > 0").select("lang", "source", F.explode(entries).alias("e")).select("lang", "source", "e.*")
    return rows.groupBy("lang", "source", "feature", "bin").agg(F.count(F.lit(1)).alias("docs"))


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """(by, feature, n, q1, q3) of the merged sketches of each group."""
    merged = sketch.groupBy(*by, "feature", "bin").agg(F.sum("docs").alias("docs"))
    group = Window.partitionBy(*by, "feature")
    counted = merged.withColumn("upto", F.sum("docs").over(group.orderBy("bin"))).withColumn("n", F.sum("docs").over(group))
    reached = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("n"), F.col("bin")))
    found = counted.groupBy(*by, "feature").agg(F.max("n").alias("n"), reached(1).alias("q1"), reached(3).alias("q3"))
    return found.select(*by, "feature", "n", least_in_bin(F.col("q1")).alias("q1"), least_in_bin(F.col("q3")).alias("q3"))


def bounds(sketch: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, source, bounds): a map from feature to (low, high) for every group."""
    own = quartiles(sketch, "lang", "source")
    per_lang = quartiles(sketch, "lang").select(F.col("lang").alias("l"), F.col("feature").alias("f"), F.struct("n", "q1", "q3").alias("by_lang"))
    of_all = quartiles(sketch).select(F.col("feature").alias("g"), F.struct("q1", "q3").alias("by_all"))
    met = own.join(per_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("feature") == F.col("f")))
    met = met.join(F.broadcast(of_all), F.col("feature") == F.col("g"))  # a row per feature
    chosen = F.when(F.col("n") >= LEAST, F.struct("q1", "q3")).when(
        F.col("by_lang.n") >= LEAST, F.struct(F.col("by_lang.q1").alias("q1"), F.col("by_lang.q3").alias("q3"))).otherwise(F.col("by_all"))
    least = reduce(lambda rest, f: F.when(F.col("feature") == f[0], f[1][1]).otherwise(rest), FEATURES.items(), F.lit(0))
    spread = REACH * F.greatest(F.col("c.q3") - F.col("c.q1"), least)
    placed = met.withColumn("c", chosen).select("lang", "source", "feature", F.struct((F.col("c.q1") - spread).alias("low"), (F.col("c.q3") + spread).alias("high")).alias("b"))
    return scratch.keep(placed.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("feature", "b"))).alias("bounds")))


def base_failed(m: dict[str, Column]) -> Column:
    return (m["n_words"] < FEWEST) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def verdict(m: dict[str, Column], of_group: Column) -> Column:
    """Whether a document passes the base rule and the bounds of its group."""
    inside = ~base_failed(m)
    for name, value in features(m).items():
        inside = inside & (value <= of_group[name]["high"])
        if FEATURES[name][2]:
            inside = inside & (value >= of_group[name]["low"])
    return F.coalesce(inside, F.lit(False))


def with_bounds(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (lang, source, ...) with ``_q_bounds`` of their group, null for a group
    without words."""
    groups = found.select(F.col("lang").alias("_q_lang"), F.col("source").alias("_q_source"), F.col("bounds").alias("_q_bounds"))
    same = F.col("lang").eqNullSafe(F.col("_q_lang")) & F.col("source").eqNullSafe(F.col("_q_source"))
    return rows.join(groups, same, "left").drop("_q_lang", "_q_source")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Texts are measured twice, once for
    the sketches and once where they meet the bounds, and sent nowhere for it."""
    scratch = Scratch(docs.sparkSession)
    measured = with_measures(docs)
    found = bounds(scratch.keep(sketches(measured.select("lang", "source", "_q.*"))), scratch)
    fields = {name: F.col(f"_q.{name}") for name in MEASURES}
    return with_bounds(measured, found).where(verdict(fields, F.col("_q_bounds"))).select(*docs.columns)


def judged_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept) of every document."""
    scratch = Scratch(docs.sparkSession)
    slim = scratch.keep(with_measures(docs.select("doc_id", "lang", "source", bounded())).select("doc_id", "lang", "source", "_q.*"))
    found = bounds(scratch.keep(sketches(slim)), scratch)
    fields = {name: F.col(name) for name in MEASURES}
    return with_bounds(slim, found).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed(fields).alias("base_failed"),
        verdict(fields, F.col("_q_bounds")).alias("kept"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_documents(read_table(spark, sf_dir, "documents"))
