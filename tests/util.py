"""Fixtures in the shapes the library works on."""

import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from gleanery import ColumnScoring, ScoringConfig
from gleanery.operators.stats import Profile

QUALITY = {"excellent": 1.0, "good": 0.75, "adequate": 0.4, "poor": 0.1, "unacceptable": 0.0}


def quality_rules(**options) -> ScoringConfig:
    return ScoringConfig({"content_quality": ColumnScoring(QUALITY)}, **{"normalize": False, **options})


def scored_frame(spark, scores, parts=3):
    """(source_pos, score, matched) from a list of scores."""
    rows = [(i, None if s is None else float(s), True) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "source_pos bigint, score double, matched boolean").repartition(parts)


def profile_of(scores) -> Profile:
    weights = [s for s in scores if s > 0]
    return Profile(len(scores), len(scores), len(weights), sum(weights), max(weights, default=0.0))


def messages(i):
    return [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": f"a{i}"}]


def write_source(root, files=3, rows=40, sub="data"):
    """A sharded dataset whose ids sort like its rows."""
    folder = os.path.join(root, sub) if sub else str(root)
    os.makedirs(folder, exist_ok=True)
    sizes = rows if isinstance(rows, list) else [rows] * files
    start = 0
    for number, size in enumerate(sizes):
        ids = range(start, start + size)
        table = pa.table({"id": [f"d{i:04d}" for i in ids], "messages": [messages(i) for i in ids]})
        pq.write_table(table, os.path.join(folder, f"train-{number:05d}.parquet"))
        start += size
    return str(root)


def write_annotations(path, ids, quality, **columns):
    pd.DataFrame({"id": ids, "content_quality": quality, **columns}).to_parquet(path, index=False)
    return str(path)


def draws(frame):
    """Positions in draw order."""
    rows = frame.select("draw_pos", "source_pos").collect()
    assert sorted(r.draw_pos for r in rows) == list(range(len(rows)))
    return [r.source_pos for r in sorted(rows, key=lambda r: r.draw_pos)]
