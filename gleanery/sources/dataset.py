"""Dataset scan: a folder of parquet files, or its ``data/`` sub-folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _glob_count(spark: SparkSession, pattern: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matches = filesystem.globStatus(path)
    return 0 if matches is None else len(matches)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """``path/data/*.parquet`` if there is any, else ``path/*.parquet`` (neither
    recursive), else ``path`` itself when it is one parquet file. Spark globs in
    the JVM; no file list passes through Python."""
    root = str(path).rstrip("/")
    for pattern in (f"{root}/data/*.parquet", f"{root}/*.parquet"):
        if _glob_count(spark, pattern):
            return spark.read.parquet(pattern)
    if root.endswith(".parquet") and _glob_count(spark, root):
        return spark.read.parquet(root)
    raise FileNotFoundError(f"No .parquet files found in {path}")
