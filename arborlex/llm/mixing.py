"""Operator 7: mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are put in a random but reproducible order (a keyed hash), which makes a
stream of words.  The stream is cut into blocks of ``block_words`` words; the source's quota is the
blocks that cover its target, the last one cut to fit, and a second turn begins where a source is
used up.  The quotas of all sources are split recursively among output shards: at each node of
a binary tree the left half draws its number of blocks without replacement, a multivariate
hypergeometric draw, so that every shard has exact counts and the shards together have exactly the
quotas.  Each shard takes the next blocks of each source's stream, and is shuffled locally.

Word positions come from a range-partitioned sort with one sum per (partition, source) carried on,
so a source with most of the rows is spread like any other.  Sources are a table too: their
ranks come from a distributed numbering, their targets from sums, and the tree runs per chunk of
``CHUNK`` sources below a tree over chunk totals.

Edge cases.  Null and empty texts have size 0 and are never taken.  A null source is a source,
the last one.  Identical rows are one unit whose words they share evenly.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_index
from .common import WS_CLASS, shuffle_parts, written

WEIGHTS, SHARE, LIMIT = (5, 2, 1), 1.5, 2
BLOCK_WORDS, SHARDS, SEED = 64, 64, 20
#: Sources in one node vector of the tree; chunk totals make the vector above.
CHUNK = 1024
#: The draws' generator takes fewer than 10**9 blocks in a vector, so blocks grow with the corpus beyond that.
MOST_BLOCKS = 5 * 10**8


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WS_CLASS}]+")), F.lit(0)).cast("bigint")


def split_tree(counts: np.ndarray, totals: list[int], path: tuple[int, ...]) -> list[np.ndarray]:
    """``counts`` split among shards of the given totals: one vector a shard, in order."""
    if len(totals) == 1:
        return [counts]
    half = len(totals) // 2
    rng = np.random.default_rng(path)
    left = rng.multivariate_hypergeometric(counts, int(sum(totals[:half])), method="marginals")
    return split_tree(left, totals[:half], (*path, 0)) + split_tree(counts - left, totals[half:], (*path, 1))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """sources(source, source_size) with ``rank`` by code point (null last), ``weight`` and ``target``.

    The level is found by sums alone: sources above their limit are held at it and the rest
    reshared by weight, until none is above.
    """
    ranked = dense_index(sources, [F.col("source").asc_nulls_last()], name="rank")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    top, want = F.col("source_size") * F.lit(float(limit)), F.col("weight")
    words, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, held = (share * words / weight if words else 0.0), -1
    while words:
        over = F.lit(level) * want > top
        n, kept, rest = ranked.agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, top)), F.lit(0.0)),
                                   F.coalesce(F.sum(F.when(~over, want)), F.lit(0))).first()
        if n == held or not rest:
            break
        held, level = n, (share * words - kept) / rest
    return ranked.withColumn("target", F.least(F.lit(level) * want, top).cast("double"))


def _units(docs: DataFrame, seed: int) -> DataFrame:
    """Identical rows as one unit: (source, turn, doc_id, digest, size, n)."""
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       digest.alias("digest"), n_words(F.col("text")).alias("size"))
    return rows.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "digest")).groupBy(
        "source", "turn", "doc_id", "digest", "size").agg(F.count(F.lit(1)).alias("n"))


def _placed(units: DataFrame) -> DataFrame:
    """units with ``start``: the words before them in their source's stream."""
    order = ["source", "turn", "doc_id", "digest"]
    parts = shuffle_parts(units.sparkSession)
    rows = written(units.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "stream")
    rows = rows.withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    words = F.col("size") * F.col("n")
    before = Window.partitionBy("_part", "_key").orderBy("turn", "doc_id", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    pieces = rows.groupBy("_part", "_key").agg(F.sum(words).alias("_words")).withColumn(
        "_off", F.sum("_words").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    return rows.withColumn("_in", F.sum(words).over(before)).join(
        pieces.select("_part", "_key", "_off"), ["_part", "_key"]).withColumn(
        "start", F.coalesce("_off", F.lit(0)) + F.coalesce("_in", F.lit(0))).drop("_part", "_in", "_off")


def _quotas(table: DataFrame, blocks: int, shards: int, seed: int) -> DataFrame:
    """(key, bounds): the first block of each shard in the source's stream, and the end."""
    table = table.select(F.col("key"), (F.col("rank") / CHUNK).cast("bigint").alias("chunk"), "rank",
                         F.ceil(F.col("words") / blocks).cast("bigint").alias("n"))
    chunks = sorted((r.chunk, r.n) for r in table.groupBy("chunk").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in chunks)
    even = [total * (i + 1) // shards - total * i // shards for i in range(shards)]
    split = split_tree(np.array([n for _, n in chunks], np.int64), even, (seed,)) if chunks else []
    of_chunk = {c: [int(v[i]) for v in split] for i, (c, _) in enumerate(chunks)}

    def run(pdf):
        pdf = pdf.sort_values("rank")
        chunk = int(pdf["chunk"].iloc[0])
        parts = split_tree(pdf["n"].to_numpy(np.int64), of_chunk[chunk], (seed, chunk + 1))
        bounds = np.concatenate([np.zeros((1, len(pdf)), np.int64), np.cumsum(parts, axis=0)])
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "bounds": [b.tolist() for b in bounds.T]})

    return table.groupBy("chunk").applyInPandas(run, "key string, bounds array<bigint>")


def _drawn(docs: DataFrame, weights, share: float, limit: int, block_words: int, shards: int, seed: int) -> tuple[DataFrame, int]:
    """Units with their place in the stream, their source's quota ``_words`` and the ``bounds`` of its shards, and the words of a block."""
    units = written(_units(docs, seed), "units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    table = targets(sources, weights, share, limit).withColumn("words", F.round("target").cast("bigint")).withColumn(
        "key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    table = written(table, "targets")
    words = table.agg(F.sum("words")).first()[0] or 0
    blocks = max(block_words, math.ceil(words / MOST_BLOCKS))
    table = table.join(_quotas(table, blocks, shards, seed), "key", "left").select(
        F.col("key").alias("_key"), "source_size", "target", F.col("words").alias("_words"), "bounds")
    return _placed(units).join(table, "_key"), blocks


def plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, block_words: int = BLOCK_WORDS,
         shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """What the mix takes of each unit of identical rows.

    (doc_id, source, digest, size, n, source_size, target, words, shard): ``words`` and ``shard``
    are arrays with an entry for each turn through the source, the words taken of the unit in it
    and the shard that its first block is dealt to (null where none is taken).
    """
    out, blocks = _drawn(docs, weights, share, limit, block_words, shards, seed)
    turns = F.array(*[F.lit(i) for i in range(math.ceil(limit))])
    first = lambda i: F.col("start") + i * F.col("source_size")
    taken = F.transform(turns, lambda i: F.greatest(
        F.lit(0), F.least(F.col("size") * F.col("n"), F.col("_words") - first(i))).cast("bigint"))
    shard = F.transform(turns, lambda i: F.when(
        first(i) < F.col("_words"), F.size(F.filter("bounds", lambda b: b <= F.floor(first(i) / blocks))) - 1))
    return out.select("doc_id", "source", "digest", "size", "n", "source_size", "target", taken.alias("words"), shard.alias("shard"))


def taken(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, block_words: int = BLOCK_WORDS,
          shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``: the words that the shards' blocks take of it.

    In every turn through the source a unit's words are cut with each shard's blocks, the quota's last block at the quota's end,
    and added up over the shards.
    """
    out, blocks = _drawn(docs, weights, share, limit, block_words, shards, seed)
    n_shards = F.size("bounds") - 1
    begins, ends = F.slice("bounds", F.lit(1), n_shards), F.slice("bounds", F.lit(2), n_shards)

    def within(turn: Column) -> Column:
        first = F.col("start") + turn * F.col("source_size")
        last = F.least(first + F.col("size") * F.col("n"), F.col("_words"))
        parts = F.zip_with(begins, ends, lambda a, b: F.greatest(F.lit(0), F.least(last, b * blocks) - F.greatest(first, a * blocks)).cast("bigint"))
        return F.when(first < F.col("_words"), F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total + x)).otherwise(F.lit(0))

    total = F.aggregate(F.transform(F.array(*[F.lit(i) for i in range(math.ceil(limit))]), within), F.lit(0).cast("bigint"), lambda a, x: a + x)
    rows = out.select("doc_id", "size", "n", "source_size", "target", total.alias("_total")).withColumn(
        "_each", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return rows.select("doc_id", "size", "source_size", "target", F.floor(F.col("_total") / F.col("n")).cast("bigint").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: whole documents, one row each time a document is
    taken (a document that the end of a quota cuts counts if half of it or more is in), dealt to their
    shards and shuffled there by a keyed hash.  Empty documents are never taken."""
    seed = options.get("seed", SEED)
    draws = plan(docs, **options).select(
        F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("digest").alias("_h"),
        F.expr("filter(arrays_zip(words, shard), x -> x.words > 0 and 2 * x.words >= size * n)").alias("_draws")
    ).where(F.size("_draws") > 0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    rows = rows.join(draws, F.col("_doc.source").cast("string").eqNullSafe(F.col("_s"))
                     & F.col("_doc.doc_id").cast("bigint").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))
    rows = rows.select("_doc", "_hash", F.posexplode("_draws").alias("_turn", "_draw"))
    rows = rows.withColumn("_shard", F.col("_draw.shard")).withColumn(
        "_order", F.xxhash64(F.lit(seed + 1), "_turn", "_doc.doc_id", "_hash"))
    return rows.repartitionByRange(shuffle_parts(docs.sparkSession), "_shard", "_order").sortWithinPartitions(
        "_shard", "_order").select("_doc.*")
