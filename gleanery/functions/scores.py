"""Rules -> Catalyst expressions. Short rules stay in one ``Project`` with codegen; long
ones are a sized broadcast join with the rules as a table."""

from __future__ import annotations

import functools
import logging
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.rules import ColumnScoring, ScoringConfig
from gleanery.runtime import BROADCAST_BYTES

# A map literal is searched label by label; beyond so many a hash lookup takes over.
LISTED = 32
LABEL_BYTES = 128

log = logging.getLogger(__name__)


def typed_labels(name: str, rule: ColumnScoring, data_type: T.DataType) -> list[tuple]:
    """The rule's (label, score), labels fit for a column of this type."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(
            f"Column '{name}' is {data_type.simpleString()}; only single-value labels can be scored"
        )
    labels = []
    for label, score in rule.category_scores.items():
        if score is None:
            continue
        if isinstance(data_type, T.StringType) and not isinstance(label, str):
            raise TypeError(
                f"Label {label!r} of string column '{name}' is not a string; quote it in the YAML file"
            )
        if isinstance(data_type, T.IntegralType) and not isinstance(label, str):
            if label != int(label):
                raise ValueError(f"Label {label!r} can never equal a value of the integer column '{name}'")
            label = int(label)
        labels.append((label, float(score)))
    return labels


def category_score(name: str, rule: ColumnScoring, data_type: T.DataType) -> Column:
    """Score of one label column; unlisted labels and NULL get the default."""
    labels = typed_labels(name, rule, data_type)
    default = F.lit(float(rule.default_score))
    if not labels:
        return default
    pairs = [part for label, score in labels for part in (F.lit(label).cast(data_type), F.lit(score))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(name)), default)


def looked_up(annotations: DataFrame, name: str, rule: ColumnScoring, data_type: T.DataType) -> tuple[DataFrame, Column]:
    """The same by a left join with the rule's labels, broadcast if they are small. Labels
    are unique, so no row is repeated."""
    labels = [(str(label), score) for label, score in typed_labels(name, rule, data_type)]
    if len({label for label, _ in labels}) < len(labels):
        raise ValueError(f"Column '{name}' has a label twice")
    key, score = f"_label_{name}", f"_score_{name}"
    rules = annotations.sparkSession.createDataFrame(labels, "label string, score double")
    rules = rules.select(F.col("label").cast(data_type).alias(key), F.col("score").alias(score))
    if len(labels) * LABEL_BYTES <= BROADCAST_BYTES:
        rules = F.broadcast(rules)
    joined = annotations.join(rules, F.col(name) == F.col(key), "left").drop(key)
    return joined, F.coalesce(F.col(score), F.lit(float(rule.default_score)))


def composite_score(annotations: DataFrame, config: ScoringConfig, listed: int = LISTED) -> tuple[DataFrame, Column]:
    """``(frame, score)``: the configured columns that the table has, folded into one raw
    score over the frame, which is the table with what long rules add to it."""
    types = {field.name: field.dataType for field in annotations.schema}
    present = {name: rule for name, rule in config.columns.items() if name in types}
    if not present:
        raise ValueError("No annotation columns matched the scoring config")
    absent = [name for name in config.columns if name not in types]
    if absent:
        log.warning("Annotations lack configured columns, ignored: %s", ", ".join(absent))

    scores = []
    for name, rule in present.items():
        if len(rule.category_scores) > listed:
            annotations, score = looked_up(annotations, name, rule, types[name])
        else:
            score = category_score(name, rule, types[name])
        scores.append(score)
    return annotations, _folded(scores, present, config)


def _folded(scores: list[Column], present: dict[str, ColumnScoring], config: ScoringConfig) -> Column:
    weights = [float(rule.weight) for rule in present.values()]
    if config.aggregation == "min":
        return F.least(*scores) if len(scores) > 1 else scores[0]
    if config.aggregation == "product":
        return functools.reduce(operator.mul, scores)
    weighted_sum = functools.reduce(
        operator.add, [score * F.lit(weight) for score, weight in zip(scores, weights)]
    )
    if config.aggregation == "weighted_sum":
        return weighted_sum
    total = sum(weights)
    if total == 0:
        raise ValueError("The weights of the matched columns sum to zero")
    return weighted_sum / F.lit(total)
