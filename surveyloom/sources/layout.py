"""Tables laid out for the serving views: rows of one poll in one bucket, years apart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder


def lay_out(rows: DataFrame, key: str, buckets: int, name: str, folder: str | None = None) -> str:
    """Write rows as a table of so many buckets of key, sorted by it, with a folder for each ``part`` (a year); returns the table's name.

    Tables of as many buckets of the same key are joined by it without a shuffle, and a lookup by
    key reads one bucket.  A task writes one bucket; buckets should be chosen so that a year's
    bucket is a file of some hundred MB.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    place = folder or shared_folder(rows.sparkSession, name)
    rows.repartition(buckets, key).write.partitionBy("part").bucketBy(buckets, key).sortBy(key).option("path", place).saveAsTable(table)
    return table


def laid_out(spark: SparkSession, polls: DataFrame, results: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(polls, results) laid out by poll id; both have ``part``, the poll's year."""
    return spark.table(lay_out(polls, "id", buckets, "polls")), spark.table(lay_out(results, "poll_id", buckets, "results"))
