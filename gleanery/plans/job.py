"""The on-disk job: read, curate, write shards, write the card.

    spark-submit ... -m gleanery.plans.job --dataset_path ... --annotations_path ...
        --output_dir ... --mode threshold --threshold 0.7
"""

from __future__ import annotations

import argparse
import datetime
import hashlib
import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession

from gleanery.operators.selection import MODES
from gleanery.operators.stats import distribution_frame
from gleanery.plans.curate import curate
from gleanery.rules import ScoringConfig
from gleanery.sinks.card import CurationInfo, provenance, render_card
from gleanery.sinks.files import Folder
from gleanery.sinks.shards import check_free, pending, publish, rows_per_shard, seal, stage_shards

log = logging.getLogger(__name__)

# The two writer names of the command line, as row orders.
WRITER_ORDER = {"load": "draw", "stream": "source"}


@dataclass(frozen=True, eq=False)
class JobResult:
    """Results are equal if the same was selected, whatever the output folder is called."""

    shards: int
    source_rows: int
    selected_rows: int
    provenance: Row
    before: Row
    ratio: float | None

    def _selected(self) -> tuple:
        facts = {name: value for name, value in self.provenance.asDict().items() if name != "name"}
        return self.shards, self.source_rows, self.selected_rows, facts, self.before, self.ratio

    def __eq__(self, other: object) -> bool:
        return self._selected() == other._selected() if isinstance(other, JobResult) else NotImplemented

    def __hash__(self) -> int:
        return hash((self.shards, self.source_rows, self.selected_rows))


def run(
    spark: SparkSession, dataset_path: str, annotations_path: str, output_dir: str, mode: str,
    *, config: str | None = None, threshold: float = 0.5, n_samples: int | None = None,
    max_duplications: int | None = None, seed: int = 42, force: bool = False,
    order: str = "draw", overwrite: bool = False,
) -> JobResult:
    """``order``: "draw" keeps the order of the draws, "source" that of the source.

    A run that was broken off while it published its shards is finished first, from its
    journal. If it had the same options and inputs, that is the result: nothing is read or
    computed again."""
    if order not in WRITER_ORDER.values():
        raise ValueError(f"Unknown order: {order}")
    inside = f"{str(output_dir).rstrip('/')}/"
    if f"{str(dataset_path).rstrip('/')}/".startswith(inside) or inside.startswith(f"{str(dataset_path).rstrip('/')}/"):
        raise ValueError("The output folder must lie apart from the dataset")
    token = _token(
        spark, [dataset_path, f"{dataset_path}/data", annotations_path], mode, config, threshold, n_samples, max_duplications, seed, order)
    journal = pending(spark, output_dir)
    if journal is not None:
        publish(spark, output_dir, journal)
        if journal.get("token") == token:
            return _result(journal)
    check_free(spark, output_dir, overwrite)
    curated = curate(
        dataset_path, annotations_path, mode, ScoringConfig.resolve(config), threshold=threshold,
        n_samples=n_samples, seed=seed, force=force, max_duplications=max_duplications, spark=spark,
    )
    with curated:
        source_rows = curated.totals.rows
        per_shard = rows_per_shard(source_rows, curated.source_files)
        rows, shards, selected, seen = curated.observed_shards(per_shard, order)
        staged = stage_shards(rows, shards, output_dir)
        after = curated.after() if seen is None else distribution_frame(spark, seen.get)
        info = CurationInfo(
            name=str(output_dir).rstrip("/").rsplit("/", 1)[-1],
            source_dataset=str(dataset_path), annotations_path=str(annotations_path),
            config_name=config or "default", mode=mode, threshold=threshold, n_samples=n_samples,
            seed=seed, source_rows=source_rows, selected_rows=selected,
            max_duplications=max_duplications, order=order,
        )
        row = provenance(info, after).first()
        journal = seal(
            spark, output_dir, staged, token=token, card=render_card(row, datetime.date.today()), provenance=row.asDict(),
            before=curated.before().first().asDict(),
        )
    publish(spark, output_dir, journal)
    log.info("Wrote %d of %d rows in %d shards to %s", selected, source_rows, shards, output_dir)
    return _result(journal)


def _token(spark: SparkSession, folders: Sequence[str], *options) -> str:
    """Tells runs apart by their options and the files that their folders hold."""
    files = [(folder, Folder(spark, folder).sizes("*.parquet"), Folder(spark, folder).sizes("")) for folder in folders]
    return hashlib.sha256(json.dumps([files, options]).encode()).hexdigest()


def _result(journal: dict) -> JobResult:
    row = Row(**journal["provenance"])
    ratio = row["selected_rows"] / row["source_rows"] if row["source_rows"] else None
    return JobResult(len(journal["parts"]), row["source_rows"], row["selected_rows"], row, Row(**journal["before"]), ratio)


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description="Select rows of a dataset by quality score, on Spark.")
    options.add_argument("--dataset_path", required=True, help="folder with parquet files, or with a data/ folder of them")
    options.add_argument("--annotations_path", required=True, help="parquet file or folder with an id column and labels")
    options.add_argument("--output_dir", required=True)
    options.add_argument("--mode", required=True, choices=MODES)
    options.add_argument("--config", help="bundled rule set or YAML file (default: default)")
    options.add_argument("--threshold", type=float, default=0.5, help="lowest score kept in threshold mode")
    options.add_argument("--n_samples", type=int, help="rows to draw (default: size of the dataset)")
    options.add_argument("--max_duplications", type=int, help="most draws of one row, with replacement only")
    options.add_argument("--seed", type=int, default=42)
    options.add_argument("--force", action="store_true", help="go on when under 20%% of the ids match")
    options.add_argument("--overwrite", action="store_true", help="replace shards in the output folder")
    order = options.add_mutually_exclusive_group()
    order.add_argument("--order", choices=sorted(WRITER_ORDER.values()), help="row order of the output (default: draw)")
    order.add_argument("--writer", choices=sorted(WRITER_ORDER), help="same choice: load = draw, stream = source")
    return options


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> JobResult:
    options = vars(parser().parse_args(argv))
    writer = options.pop("writer")
    options["order"] = options["order"] or WRITER_ORDER[writer or "load"]
    session = spark or SparkSession.builder.appName("gleanery").getOrCreate()
    return run(session, **options)


if __name__ == "__main__":
    main()
