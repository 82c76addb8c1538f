"""Distributed dense numbering (a DataFrame zipWithIndex).

A global ``row_number() over (order by ...)`` runs in one task.  Here a range
partitioned sort spreads the rows; each sorted partition is numbered locally and
shifted by the row counts of the partitions before it (a table with one row per
partition, so the broadcast is bounded by the partition count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Narrow rows that a task sorts, where their number is known.
ROWS_PER_TASK = 400_000


def tasks_for(df: DataFrame, rows: int, each: int | None = None) -> int:
    """Tasks for so many narrow rows.  Sorted rows take many times the bytes of their shuffle blocks, so a number of tasks that
    follows the blocks' size, as Spark would choose it, lets a task's memory grow with the input.  With fewer tasks than
    shuffle partitions, Spark would deal the rows out again for a join and choose."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (each or ROWS_PER_TASK)))


def _sorted_parts(df: DataFrame, order: list[Column], tasks: int | None = None, **tags: Column) -> DataFrame:
    """Range-sorted rows tagged with their sorted partition and with ``tags``, materialised once.

    The partition tag is read by two branches (local numbering and per-partition
    counts); a reliable checkpoint fixes it, whatever AQE or re-sampling would do on
    a recomputation.  With ``tasks``, there are so many partitions.
    """
    from ..session import cut_lineage
    parts = df.orderBy(*order) if tasks is None else df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return cut_lineage(parts.withColumns({"_part": F.spark_partition_id(), **tags}))


def _dealt(keyed: DataFrame, tasks: int | None, *by: str) -> DataFrame:
    return keyed if tasks is None else keyed.repartition(tasks, *by)


def dense_index(df: DataFrame, order: list[Column], start: int = 0, name: str = "id", tasks: int | None = None) -> DataFrame:
    """Add ``name`` = start + 0-based position of each row in the total ``order``, in ``tasks`` tasks if given.

    ``order`` must be a total order (break ties by a unique column).
    """
    # the place in the sorted partition: the bits above hold the partition
    keyed = _sorted_parts(df, order, tasks, _place=F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = keyed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    out = keyed.join(F.broadcast(offs), "_part").withColumn(
        name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_place") + F.lit(start)).cast("bigint")
    )
    return out.drop("_part", "_place", "_off")


def grouped_index(df: DataFrame, group: list[str], order: list[Column], start: int = 0,
                  name: str = "rank") -> DataFrame:
    """Dense position of each row inside its group, for groups of any size.

    Rows are range-partitioned by (group, order); a group spanning several sorted
    partitions is numbered per partition and shifted by the counts of its earlier
    pieces (one small row per (partition, group) piece), so no group is ever held
    by a single task.
    """
    gcols = [F.col(g) for g in group]
    keyed = _sorted_parts(df, [*gcols, *order])
    local = keyed.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_part", *group).orderBy(*order)) - 1)
    pieces = keyed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"))
    offs = pieces.select(
        "_part", *group,
        F.sum("_n").over(Window.partitionBy(*group).orderBy("_part")
                         .rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    # co-partitioned with `local` (both hash-partitioned on (_part, group)): no extra shuffle
    out = local.join(offs, ["_part", *group]).withColumn(
        name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local") + F.lit(start)).cast("bigint"))
    return out.drop("_part", "_local", "_off")


def grouped_total(df: DataFrame, group: list[str], order: list[Column], value: str, name: str = "before",
                  tasks: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, for groups of any size (see :func:`grouped_index`),
    in ``tasks`` tasks if given."""
    gcols = [F.col(g) for g in group]
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    keyed = _dealt(_sorted_parts(df, [*gcols, *order], tasks), tasks, "_part", *group)
    local = keyed.withColumn("_local", F.sum(value).over(before(Window.partitionBy("_part", *group).orderBy(*order))))
    pieces = keyed.groupBy("_part", *group).agg(F.sum(value).alias("_s"))
    offs = pieces.select("_part", *group, F.sum("_s").over(before(Window.partitionBy(*group).orderBy("_part"))).alias("_off"))
    out = local.join(offs, ["_part", *group]).withColumn(
        name, (F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_local"), F.lit(0))).cast("bigint"))
    return out.drop("_part", "_local", "_off")


def running_total(df: DataFrame, order: list[Column], value: str, name: str = "cum") -> DataFrame:
    """Inclusive running sum of ``value`` over a total ``order`` without a single-task window."""
    keyed = _sorted_parts(df, order)
    local = keyed.withColumn(
        "_local", F.sum(value).over(Window.partitionBy("_part").orderBy(*order)
                                    .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = keyed.groupBy("_part").agg(F.sum(value).alias("_s"))
    offs = sizes.select("_part", F.sum("_s").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    out = local.join(F.broadcast(offs), "_part").withColumn(
        name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local"))
    return out.drop("_part", "_local", "_off")


def carried_last(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name`` = the latest non-null ``value`` at or before each row in the total ``order`` (ascending columns).

    An as-of merge: the rows are range-sorted once, each partition carries its own last value on, and the value that enters a
    partition comes from a table with one row per partition (so the broadcast is bounded by the partition count).
    """
    cols = [F.col(c) for c in order]
    keyed = _sorted_parts(df, cols)
    local = keyed.withColumn("_local", F.last(value, ignorenulls=True).over(
        Window.partitionBy("_part").orderBy(*cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = keyed.groupBy("_part").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*cols))).alias("_end"))
    enters = ends.select("_part", F.last("_end", ignorenulls=True).over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_enters"))
    out = local.join(F.broadcast(enters), "_part").withColumn(name, F.coalesce("_local", "_enters"))
    return out.drop("_part", "_local", "_enters")
