"""A corpus pipeline of five of the operators: each stage reads what the one before it wrote.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All stages but the last return the columns of ``documents``, and each works on every row that its
predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlex.llm import line_dedup, mixing, near_dedup, quality_nbsvm, sentencepieces
from arborlex.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_nbsvm.accepted(docs.select(*COLUMNS), model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text.  A family of near copies counts
    as one page of its source, so that its own lines stay for the copy that the next stage keeps."""
    out = line_dedup.drop_boilerplate(docs.select(*COLUMNS), families=True)
    n_chars = F.when(F.col("_n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, null last, then of the smallest text digest
    (rows without shingles all stay)."""
    return near_dedup.survivors(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its shards."""
    return mixing.mixed(docs.select(*COLUMNS))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, with the digest of what they decode to."""
    return sentencepieces.encode(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("source_mix", source_mix),
    ("sentencepieces", piece_encoding),
]

#: Trained, hashed and sampled stages: no SQL gives the same rows; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
