"""Operator 1: exact duplicates by a stateful stream (DataFrame functions only).

The table is read as a stream of files.  The stream's keyed state lives on disk (RocksDB), in the
shared folder, and never expires: for each digest of a normalised text it holds the smallest (stable
identifier, content locator) and the number of rows.  A later run over the same state folder goes
on from there and reads new files only.

A digest hit is not taken on trust.  Rows whose digest the state has seen more than once are
joined with the bytes of the row that the state names, and only equal bytes are a copy; rows that
share a digest but not the bytes are grouped by the bytes themselves.  Crowds of copies are cut
into chunks of ``CHUNK_ROWS`` rows for that comparison, each with its own copy of the kept bytes.

The identifier is the doc_id; of rows that share the smallest doc_id, the locator (file and row
in it) decides, so exactly one row of a group is kept.

A used state.  Groups count the rows of all paths that the state has seen, and a group's keeper may stand in an
earlier path: its bytes are read again by the locator (the file has to be there still).  Rows of the path asked for are returned,
and only those.

Edge cases.  A null text counts as empty, and empty texts are one group.  A null doc_id comes
after all others.  Columns besides doc_id and text are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_CLASS, fresh_path, written

#: Rows of one group of copies that one task compares.
CHUNK_ROWS = 4096
FILES_PER_BATCH = 512

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # a few MB a partition otherwise
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WS_CLASS}]+", " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed(rows: DataFrame, digest) -> DataFrame:
    """(digest, doc_id, file, row, text) with the normalised text."""
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised(F.col("text")).alias("text"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
                       ).withColumn("digest", digest(F.col("text")))


def _identity() -> Column:
    """Orders rows of a group: null doc_ids last, then doc_id, then the locator."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")


def _pattern(path: str) -> str:
    """``path`` as a pattern that only it matches: a file stream takes a single file that way too."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def update_state(spark: SparkSession, path: str, state: str, digest=sha256_digest,
                 files_per_batch: int = FILES_PER_BATCH) -> None:
    """Take the files of ``path`` that the state folder hasn't seen into its keyed state."""
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        rows = spark.readStream.schema("doc_id bigint, text string").option(
            "maxFilesPerTrigger", files_per_batch).parquet(_pattern(path))
        kept = _keyed(rows, digest).select("digest", _identity().alias("id")).groupBy("digest").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
        query = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(
            availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """(digest, keep_id, keep_file, keep_row, n): the keyed state of a stream over documents."""
    rows = spark.read.format("statestore").load(state)
    kept, n = (f"value.`{c}`" for c in rows.schema["value"].dataType.names[:2])
    return rows.select("key.digest", F.col(f"{kept}.doc_id").alias("keep_id"), F.col(f"{kept}.file").alias("keep_file"),
                       F.col(f"{kept}.row").alias("keep_row"), F.col(n).alias("n"))


def exact_duplicates(spark: SparkSession, path: str, state: str | None = None, digest=sha256_digest) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of the Parquet table at ``path``."""
    state = state or fresh_path(spark, "dedup-state")
    update_state(spark, path, state, digest)
    known = read_state(spark, state)
    rows = _keyed(spark.read.schema("doc_id bigint, text string").parquet(path), digest)
    rows = rows.withColumn("sha", F.sha2("text", 256)).join(known, "digest")
    # only hits need their bytes again
    rows = written(rows.withColumn("text", F.when(F.col("n") > 1, F.col("text"))), "dedup-rows")
    is_kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    out = ["doc_id", "file", "row", "keep_id", "n", "kept", "sha"]
    single = rows.where("n = 1").withColumn("kept", F.lit(True)).select(*out)
    hits = rows.where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK_ROWS).cast("int")
    keepers = hits.where(is_kept).select("digest", "n", F.col("text").alias("keep_text"))
    away = hits.select("digest", "n", "keep_file", "keep_row").distinct().join(keepers.select("digest"), "digest", "left_anti")
    files = [r.keep_file for r in away.select("keep_file").distinct().collect()]  # of earlier paths
    if files:
        read = _keyed(spark.read.schema("doc_id bigint, text string").parquet(*files), digest)
        keepers = keepers.unionByName(away.join(read.select(F.col("file").alias("keep_file"), F.col("row").alias("keep_row"), F.col(
            "text").alias("keep_text")), ["keep_file", "keep_row"]).select("digest", "n", "keep_text"))
    keepers = keepers.select("digest", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "keep_text")
    checked = hits.withColumn("chunk", F.pmod(F.xxhash64("file", "row"), chunks).cast("int")).join(
        keepers, ["digest", "chunk"]).withColumn("same", F.col("text") == F.col("keep_text")).drop("keep_text")
    checked = written(checked.withColumn("text", F.when(~F.col("same"), F.col("text"))), "dedup-checked")
    wrong = checked.where(~F.col("same")).select("digest", "text", "doc_id", "file", "row", "sha")
    if wrong.isEmpty():
        copies = checked.withColumn("kept", is_kept).select(*out)
    else:
        copies = _apart(checked, wrong, is_kept, out)
    return single.unionByName(copies).select(
        "doc_id", "keep_id", F.col("n").cast("bigint").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def _apart(checked: DataFrame, wrong: DataFrame, is_kept: Column, out: list[str]) -> DataFrame:
    """Groups of rows whose digests agree though their bytes don't."""
    right = checked.where("same").drop("n")
    sizes = right.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    right = right.join(sizes, "digest").withColumn("kept", is_kept).select(*out)
    groups = wrong.groupBy("text").agg(F.min(_identity()).alias("id"), F.count(F.lit(1)).alias("n"))
    wrong = wrong.join(groups, "text").withColumn("keep_id", F.col("id.doc_id")).withColumn(
        "kept", (F.col("file") == F.col("id.file")) & (F.col("row") == F.col("id.row"))).select(*out)
    return right.unionByName(wrong)
