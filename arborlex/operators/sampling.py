"""Seeded draws from discrete distributions (K10-K12) and coordinate matrices.

Draws use a hash of (seed, key), so they are reproducible under retries and
independent of partitioning.  The inverse-CDF lookup is a sorted merge: bands of the
CDF and draws are sorted together once, and every draw takes the last band that began,
which is carried over partition boundaries; any number of values and draws works alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import uniform
from ..functions.ranking import carried_last, running_total


def cdf_bands(dist: DataFrame, value: str = "value", weight: str = "weight") -> DataFrame:
    """Normalised CDF bands ``(value, lo, hi, p)`` in value order (the order of sorted items).

    The last band ends at 1 exactly, whatever the rounding of the sums, so no draw falls behind it.  Without any
    weight the bands are null.
    """
    w = dist.groupBy(value).agg(F.sum(weight).alias("_w"))
    cum = running_total(w, [F.col(value).asc()], "_w", name="_hi")
    tot = w.agg(F.sum("_w").alias("_tot"), F.max(F.when(F.col("_w") > 0, F.col(value))).alias("_last"))
    j = cum.withColumn("_k", F.lit(1)).join(F.broadcast(tot.withColumn("_k", F.lit(1))), "_k").withColumn("_tot", F.nullif("_tot", F.lit(0)))
    return j.select(value, ((F.col("_hi") - F.col("_w")) / F.col("_tot")).alias("lo"),
                    F.when(F.col(value) >= F.col("_last"), F.lit(1.0)).otherwise(F.col("_hi") / F.col("_tot")).alias("hi"), (F.col("_w") / F.col("_tot")).alias("p"))


def weighted_draw(draws: DataFrame, key: str, dist: DataFrame, value: str = "value", weight: str = "weight",
                  seed: str = "42", inclusive_upper: bool = False, buckets: int | None = None) -> DataFrame:
    """One value per draw row, by inverse CDF of a uniform hash draw.

    ``inclusive_upper=False`` picks the first value with u < cdf (``nSample``);
    ``True`` picks the first with u <= cdf (``sample``).  Without a positive weight there is nothing to draw: no rows.
    ``buckets`` has no effect: the merge needs none, and callers of the bucketed form may still name it.
    """
    bands = cdf_bands(dist, value, weight).where(F.col("hi") > F.col("lo"))
    d = draws.select(key, uniform(seed, F.col(key)).alias("u"))
    # at equal places: a band before the draws it holds, and with an inclusive end after them (a draw of 0 is the first band's)
    band_at, draw_at = (1, F.when(F.col("u") == 0, 2).otherwise(0)) if inclusive_upper else (0, F.lit(1))
    kind = draws.schema[key].dataType
    rows = bands.select(F.col("lo").alias("at"), F.lit(band_at).alias("side"), F.lit(None).cast(kind).alias("key"),
                        F.struct(F.col(value).alias("v")).alias("band"))
    rows = rows.unionByName(d.select(F.col("u").alias("at"), draw_at.alias("side"), F.col(key).alias("key"),
                                     F.lit(None).cast(rows.schema["band"].dataType).alias("band")))
    drawn = carried_last(rows.withColumn("is_draw", F.col("band").isNull()), ["at", "side", "key"], "band", "last_band")
    return drawn.where(F.col("is_draw") & F.col("last_band").isNotNull()).select(
        F.col("key").alias(key), F.col("at").alias("u"), F.col("last_band.v").alias(value))


def value_probability(dist: DataFrame, value: str = "value", weight: str = "weight") -> DataFrame:
    """Total (normalised) weight of every value."""
    return cdf_bands(dist, value, weight).select(value, F.col("p").alias("probability"))


def bernoulli(df: DataFrame, key: str, p: float, seed: str = "42") -> DataFrame:
    """Keep a row when its draw r < p."""
    return df.where(uniform(seed, F.col(key)) < F.lit(p))


def to_coordinates(df: DataFrame, id_col: str, matrix_col: str, equal_to: float | Column) -> DataFrame:
    """``(id, row, col)`` of cells of a dense matrix equal to a value."""
    v = F.lit(equal_to) if not isinstance(equal_to, Column) else equal_to
    rows = df.select(id_col, F.posexplode(matrix_col).alias("row", "cells"))
    cells = rows.select(id_col, "row", F.posexplode("cells").alias("col", "x"))
    return cells.where(F.col("x") == v).select(id_col, F.col("row").cast("int"), F.col("col").cast("int"))


def transpose(coords: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """Swap rows and columns in coordinate form (any shape)."""
    return coords.withColumnRenamed(row, "_r").withColumnRenamed(col, row).withColumnRenamed("_r", col)
