"""Shared helpers: scratch tables in the cluster's shared folder, sizing from the input."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A run of the six ASCII white-space bytes; words are the runs between them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Groups that are broadcast at most, and the rows below which none is hot; see join_groups().
HOT_GROUPS, HOT_ROWS = 10_000, 100

_own_scratch: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's tables, in the one that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a folder of our own serves a local session; on a cluster it is an error,
    as executors would write to disks that the others don't see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_scratch:
            _own_scratch.append(tempfile.mkdtemp(prefix="spark-scratch-"))
        root = "file://" + _own_scratch[0]
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared scratch folder and read it back: lineage ends here, and a lost executor costs nothing already written."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all tables that this application has stored, by writing an empty one in their place.  Results must have been written before."""
    spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(scratch_root(spark))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) to groups, which has one row for each key and in ``size`` the number of rows with it.

    A shuffle would send all rows of a key to one task.  Keys of more than total / HOT_GROUPS
    rows are at most HOT_GROUPS many, whatever the table's size: their groups are broadcast,
    and only rows of smaller groups are shuffled.
    """
    hot = F.col(size) > max(HOT_ROWS, total // HOT_GROUPS)
    large = groups.filter(hot)
    cold = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.filter(~hot), keys, how)
    return rows.join(F.broadcast(large), keys).unionByName(cold)


def input_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of the tables under df: for those read from files, the bytes of the files.  Where Spark knows no size, texts are measured."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if total < 1 << 60:
        return total
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return df.agg(F.coalesce(F.sum(sum(texts, F.lit(16)).cast("long")), F.lit(0))).first()[0]


def buckets(df: DataFrame, mb: float) -> int:
    """As many buckets as give about ``mb`` MB of input files each; grows with the input and has no upper limit."""
    return max(1, math.ceil(input_bytes(df) / (mb * 1e6)))


def partitions(df: DataFrame) -> int:
    """Partitions for shuffles of whole texts: the session's setting, or more where those would exceed about 64 MB of input."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets(df, 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def sliced(batches, rows: int = 1000):
    """Arrow batches in slices, so that no more than so many texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
