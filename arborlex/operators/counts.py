"""Sparse counts keyed by group (K1-K9): ``counts(grp, key, value DOUBLE)``; missing key = 0.

Aggregates carry map-side partial sums; per-group totals are joined back rather
than computed by a group-wide window, and top-k is salted, so a group holding a
third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import dense_index, grouped_index


def increment_all(df: DataFrame, grp: str, keys: str, count: float | Column = 1.0) -> DataFrame:
    """K1: add ``count`` to every key of an array column."""
    c = F.lit(count) if not isinstance(count, Column) else count
    return df.select(F.col(grp).alias("grp"), F.explode(keys).alias("key"), c.cast("double").alias("v")).groupBy(
        "grp", "key").agg(F.sum("v").alias("value"))


def argmax(counts: DataFrame) -> DataFrame:
    """K2: key with the largest value per group; ties -> smallest key."""
    return counts.groupBy("grp").agg(
        F.min_by("key", F.struct((-F.col("value")).alias("v"), F.col("key").alias("k"))).alias("key"))


def top_k(counts: DataFrame, k: int, salts: int = 16) -> DataFrame:
    """K3 top-k: keys by value descending (ties by key), rank 1..k per group.

    Exact two-step: rank inside (group, salt) slices, keep k per slice, then rank the
    at most ``salts * k`` survivors per group.
    """
    order = [F.col("value").desc(), F.col("key").asc()]
    salted = counts.withColumn("_s", F.pmod(F.xxhash64("key"), F.lit(salts)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("grp", "_s").orderBy(*order))).where(
        F.col("_r") <= k)
    final = first.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)))
    return final.where(F.col("rank") <= k).select("grp", F.col("rank").cast("bigint").alias("rank"), "key", "value")


def sorted_keys(counts: DataFrame) -> DataFrame:
    """K3 full order: rank of every key within its group, any group size."""
    r = grouped_index(counts, ["grp"], [F.col("value").desc(), F.col("key").asc()], start=1, name="rank")
    return r.select("grp", F.col("rank").cast("bigint").alias("rank"), "key", "value")


def total(counts: DataFrame) -> DataFrame:
    """K4."""
    return counts.groupBy("grp").agg(F.sum("value").alias("total"))


def normalize(counts: DataFrame) -> DataFrame:
    """K5: value / group total; unchanged when the total is 0."""
    t = total(counts)
    j = counts.join(t, "grp")
    return j.select("grp", "key", F.when(F.col("total") == 0, F.col("value")).otherwise(
        F.col("value") / F.col("total")).alias("value"))


def divide_all(counts: DataFrame, divisor: float) -> DataFrame:
    """K6."""
    return counts.withColumn("value", F.col("value") / F.lit(float(divisor)))


def dot(left: DataFrame, right: DataFrame) -> DataFrame:
    """K7: sum of products over shared keys, for every (left grp, right grp) sharing a key.

    Use with a right side holding few groups per key (e.g. one reference vector);
    for arbitrary pairs use :func:`dot_pairs`.
    """
    l = left.select(F.col("grp").alias("grp_a"), "key", F.col("value").alias("va"))
    r = right.select(F.col("grp").alias("grp_b"), "key", F.col("value").alias("vb"))
    return l.join(r, "key").groupBy("grp_a", "grp_b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))


def dot_pairs(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """K7 for explicit ``pairs(grp_a, grp_b)``: work is proportional to the listed pairs."""
    a = counts.select(F.col("grp").alias("grp_a"), "key", F.col("value").alias("va"))
    b = counts.select(F.col("grp").alias("grp_b"), "key", F.col("value").alias("vb"))
    return pairs.join(a, "grp_a").join(b, ["grp_b", "key"]).groupBy("grp_a", "grp_b").agg(
        F.sum(F.col("va") * F.col("vb")).alias("dot"))


def add(a: DataFrame, b: DataFrame) -> DataFrame:
    """K8: key union, values summed."""
    return a.select("grp", "key", "value").unionByName(b.select("grp", "key", "value")).groupBy("grp", "key").agg(
        F.sum("value").alias("value"))


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """K9: key union, missing = 0, zero results kept."""
    nb = b.select("grp", "key", (-F.col("value")).alias("value"))
    return a.select("grp", "key", "value").unionByName(nb).groupBy("grp", "key").agg(F.sum("value").alias("value"))


def dot_top(left: DataFrame, right: DataFrame, k: int, block: int = 1024, salts: int = 16) -> DataFrame:
    """K7 for many groups: the ``k`` left groups of the largest dot product with each right group, as
    ``(grp_b, rank, grp_a, dot)``; ties go to the smaller left group, groups without a shared key aren't listed.

    The right groups are dealt to blocks of ``block`` groups, and each block goes over the left groups, which stay where
    they are: a task multiplies sparse rows with the block and keeps its ``k`` best of each right group.  A left group whose norm
    times a right group's can't reach the last of those is passed over (products are at most the norms').  The tasks'
    rows are ranked in two steps.  Sums are exact while values and products are whole numbers below 2**53.
    """
    from ..session import cut_lineage
    spark = left.sparkSession
    kinds = left.schema["grp"].dataType, right.schema["grp"].dataType
    # a key that no right group has can't add to a product
    kept = left.join(right.select("key").distinct(), "key", "left_semi")
    rows = cut_lineage(kept.groupBy("grp").agg(F.collect_list("key").alias("keys"), F.collect_list("value").alias("values")))
    groups = cut_lineage(dense_index(right.select("grp").distinct(), [F.col("grp")], name="b"))
    n_blocks = groups.agg(F.coalesce(F.floor(F.max("b") / block) + 1, F.lit(0)).cast("int")).first()[0]
    out = None
    for i in range(n_blocks):
        held = right.join(groups.where(F.floor(F.col("b") / block) == i), "grp").select("b", "key", "value").collect()
        table: dict = {}
        for r in held:
            table.setdefault(r.key, []).append((r.b - i * block, r.value))
        size = min(block, 1 + max(r.b - i * block for r in held))
        shared = spark.sparkContext.broadcast((table, size))
        found = rows.mapInPandas(_best_products(shared, k, i * block), T.StructType([
            T.StructField("b", T.LongType()), T.StructField("grp_a", kinds[0]), T.StructField("dot", T.DoubleType())]))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("grp_b", kinds[1]), T.StructField("rank", T.LongType()),
                                                       T.StructField("grp_a", kinds[0]), T.StructField("dot", T.DoubleType())]))
    order = [F.col("dot").desc(), F.col("grp_a")]
    some = out.withColumn("_s", F.pmod(F.xxhash64("grp_a"), F.lit(salts)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("b", "_s").orderBy(*order))).where(F.col("_r") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("b").orderBy(*order)).cast("bigint")).where(F.col("rank") <= k)
    return ranked.join(groups, "b").select(F.col("grp").alias("grp_b"), "rank", "grp_a", "dot")


def _best_products(shared, k: int, first: int):
    def run(batches):
        import numpy as np
        import pandas as pd
        table, size = shared.value
        norms = np.zeros(size)
        table = {key: (np.array([b for b, _ in rows]), np.array([v for _, v in rows], float)) for key, rows in table.items()}
        for at, v in table.values():
            norms[at] += v * v  # a right group has a key once
        norms = np.sqrt(norms)
        best: list[list] = [[] for _ in range(size)]
        least = np.zeros(size)
        for batch in batches:
            for grp, keys, values in zip(batch["grp"], batch["keys"], batch["values"], strict=True):
                values = np.asarray(values, float)
                if not (np.sqrt((values * values).sum()) * norms * (1 + 1e-9) >= least).any():
                    continue
                dots, hit = np.zeros(size), np.zeros(size, bool)
                for key, v in zip(keys, values, strict=True):
                    if key in table:  # else another block has it
                        at, w = table[key]
                        dots[at] += v * w
                        hit[at] = True
                for b in np.flatnonzero(hit & ((dots >= least) | (least == 0))):
                    rows = best[b]
                    rows.append((-dots[b], grp))
                    if len(rows) >= 4 * k:
                        rows.sort()
                        del rows[k:]
                        least[b] = -rows[-1][0]
        out = [(first + b, grp, -d) for b, rows in enumerate(best) for d, grp in sorted(rows)[:k]]
        yield pd.DataFrame(out, columns=["b", "grp_a", "dot"])

    return run
