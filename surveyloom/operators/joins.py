"""Joins and numbering that hold for hot keys and for any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import stored

#: Groups that are broadcast at most.
HOT_GROUPS = 10_000
#: Rows below which no group is hot.
HOT_ROWS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows left joined to groups, one row for each key, ``size`` of which is its number of rows; of total rows in all.

    Groups of more than a HOT_GROUPS-th of all rows are that many at most, however large the
    table: these are broadcast, so that no task gets a hot key; the others are shuffled.
    """
    hot = F.col(size) > max(HOT_ROWS, total // HOT_GROUPS)
    large = groups.filter(hot)
    cold = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.filter(~hot), keys, "left")
    return rows.join(F.broadcast(large), keys).unionByName(cold)


def dense_numbers(rows: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """rows with their place, from 1 without gaps, in the order of the columns (ties get different places in any order).

    Rows are dealt out by ranges and numbered inside them; a range begins after all rows of
    those before it.  Only the ranges' sizes, one row each, meet in one task.
    """
    ranged = stored(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"))
    before = F.coalesce(F.sum("__size").over(W.partitionBy(F.lit(1)).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # At most as many rows as there are shuffle partitions.
    starts = sizes.select("__range", before.alias("__before"))
    place: Column = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return ranged.withColumn("__place", place).join(F.broadcast(starts), "__range").withColumn(name, F.col("__before") + F.col("__place")).drop("__range", "__place", "__before")
