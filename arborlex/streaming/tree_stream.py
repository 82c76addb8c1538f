"""Incremental tree preparation over a file stream (the batch operators per micro-batch).

Sentences are independent, so each micro-batch runs validate/expand on its own rows.
Each batch writes to ``<out>/<table>/batch_id=<n>`` with overwrite, so a replayed
batch (after a failure) replaces its own output: the sink is effectively exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import trees as T
from ..operators import vocab as V

ARRAY_SCHEMA = "sent_id BIGINT, actions ARRAY<STRING>"
TEXT_SCHEMA = "sent_id BIGINT, text STRING"


def _actions(batch: DataFrame, vocab: DataFrame | None) -> DataFrame:
    if "actions" in batch.columns:
        return T.from_arrays(batch)
    if vocab is None:
        # whitespace tokens framed with <s> ... </s>, no vocabulary lookup
        return batch.select("sent_id", F.posexplode(T.frame(V.split_words(F.col("text")))).alias("pos", "tok")) \
            .select("sent_id", F.col("pos").cast("int").alias("pos"), "tok")
    return V.tokenize(batch, vocab)


def process_batch(batch: DataFrame, batch_id: int, out_dir: str, vocab: DataFrame | None = None) -> None:
    acts = T.materialize(_actions(batch, vocab))
    T.validate(acts).write.mode("overwrite").parquet(f"{out_dir}/rejects/batch_id={batch_id}")
    T.expand(acts).drop("chunk").write.mode("overwrite").parquet(f"{out_dir}/inputs/batch_id={batch_id}")


def start(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_location: str,
          schema: str = ARRAY_SCHEMA, vocab: DataFrame | None = None, available_now: bool = True) -> StreamingQuery:
    """Watch ``source_dir`` (parquet files of sentences) and prepare every new file."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    w = stream.writeStream.foreachBatch(lambda df, bid: process_batch(df, bid, out_dir, vocab)).option(
        "checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
