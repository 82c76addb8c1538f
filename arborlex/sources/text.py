"""Text, vocabulary, merge-rule and metrics sources; dataset sink."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import dense_index


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (cut at ``\\n`` only) with their global number: by file, then by the block's start in the file, then in the block.

    A file's blocks may be read in any order and by any tasks; ids that rise within a task keep a block's own order.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"), "value")
    return dense_index(raw, [F.col("_f"), F.col("_b"), F.col("_m")], name="line_no").drop("_f", "_b", "_m")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(sent_id, text)``, one row per line, ids in line order."""
    return _numbered_lines(spark, path).select(F.col("line_no").alias("sent_id"), F.col("value").alias("text"))


def split_lines(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """S1 on a text column: one row per line ``(id, line_no, text)``, line order kept."""
    return df.select(F.col(id_col), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "text")).select(
        id_col, F.col("line_no").cast("int").alias("line_no"), "text")


def vocab_entries(df: DataFrame, json_col: str, *keep: str) -> DataFrame:
    """S2 on a text column: each JSON object ``{token: id}`` -> its rows ``(token, id)`` beside the columns kept."""
    return df.select(*keep, F.explode(F.from_json(F.col(json_col), "map<string,bigint>")).alias("token", "id"))


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{token: id}`` -> ``(token, id)``."""
    return vocab_entries(spark.read.text(path, wholetext=True), "value")


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """S3: merge rules, one ``a b`` pair per line (a ``#version`` line is skipped); rank = order."""
    lines = _numbered_lines(spark, path).where(~F.col("value").startswith("#version") & (F.trim("value") != ""))
    ranked = dense_index(lines, [F.col("line_no")], name="rank")
    parts = F.split(F.col("value"), " ")
    return ranked.select("rank", parts[0].alias("a"), parts[1].alias("b"))


def write_lines(df: DataFrame, path: str, order: list[str], text_col: str = "text") -> None:
    """Text files of the rows in order: reading the folder by file and place gives the order back.  A null is an empty line."""
    df.orderBy(*order).select(F.coalesce(F.col(text_col), F.lit("")).alias("value")).write.option("lineSep", "\n").text(path)


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Save a processed dataset; returns its version.

    Rows go to a folder of their own, and when Spark has committed it, a manifest gets a row for each of its files with
    the file's number of rows.  Readers take the last version of the manifest: a write that failed or was repeated leaves no
    second copy of a row, and readers of the version before aren't disturbed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data/{uuid.uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{folder}")
    version = (_last_version(spark, path) or 0) + 1
    files = spark.read.parquet(f"{path}/{folder}").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    none = spark.createDataFrame([(None, 0)], "file string, n_rows bigint")  # an empty dataset has a version too
    files.unionByName(none).select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder"), "file", "n_rows").coalesce(
        1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _last_version(spark: SparkSession, path: str) -> int | None:
    try:
        manifest = spark.read.parquet(f"{path}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    return manifest.agg(F.max("version")).first()[0]


def read_dataset(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a dataset that ``write_dataset`` wrote (the last one if none is given)."""
    path = path.rstrip("/")
    wanted = version or _last_version(spark, path)
    held = spark.read.parquet(f"{path}/manifest").where(F.col("version") == wanted).select("folder").first()
    if held is None:
        raise FileNotFoundError(f"{path} has no version {wanted}")
    return spark.read.parquet(f"{path}/{held.folder}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSON (``{"eval_loss": ...}``) as one row per file."""
    return spark.read.json(path, multiLine=True)
