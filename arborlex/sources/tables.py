"""Driver tables (S4): one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A driver table.  With ``spread``, a scan that yields fewer splits than the
    session's parallelism (one file with one row group) is dealt round-robin over
    the cores before any per-row work; with many files (the large-scale case) the
    scan is left as it is and no shuffle is added."""
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_small_scan(df) if spread else df


def spread_small_scan(df: DataFrame) -> DataFrame:
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def read_split(spark: SparkSession, path: str, split: str | None = None, split_col: str = "split") -> DataFrame:
    """Parquet dataset with an optional named split.

    A split is either a sub-folder ``split=<name>`` (partition pruning applies) or a
    column; in both cases the filter is pushed into the scan.
    """
    df = spark.read.parquet(path)
    if split is not None and split_col in df.columns:
        df = df.where(df[split_col] == split)
    return df
