"""Incremental ingest of newly landed files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import first_in_batch, reject_known
from ..operators.joins import dense_numbers
from ..operators.run import RAW, RAW_IDS, RunConfig, clean_run, commit_run
from ..session import stored
from ..sources.versions import Change, Versions


def _stored(spark: SparkSession, target: str, schema: StructType) -> DataFrame | None:
    """The target table, None before the first batch."""
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def ingest_new(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str, keys: list[str], order: str, partition_by: str | None = None) -> None:
    """Read the JSON files that landed since the last run, drop repeats (within the batch and against the target), append.

    The checkpoint holds which files were read.  A batch that is run again after a failure
    finds its own rows in the target, so nothing is appended twice.  With ``partition_by``, a
    column of the keys, the target is laid out by it, and of the target only the partitions
    that a batch touches are read: their values come to the driver (days, say), so it should
    be a column of few values in a batch.
    """
    if partition_by is not None and partition_by not in keys:
        raise ValueError("rows are told apart by keys: partition_by must be one of them")

    def append(batch: DataFrame, _: int) -> None:
        new, known = first_in_batch(batch, keys, order), _stored(spark, target, schema)
        if known is not None:
            if partition_by is not None:
                touched = [r[0] for r in batch.select(partition_by).distinct().collect()]
                c = F.col(partition_by)
                known = known.filter(c.isin([x for x in touched if x is not None]) | (c.isNull() if None in touched else F.lit(False)))
            new = reject_known(new, known, keys)
        (new.write.partitionBy(partition_by) if partition_by else new.write).mode("append").parquet(target)

    stream = spark.readStream.schema(schema).json(landing)
    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: What tells raw rows apart: all that their source says, not when they were fetched.
RAW_KEYS = ("publish_date", "survey_date_start", "survey_date_end", "respondents", "zeitraum", "parties", "institute_id", "provider", "source", "scope", "election_id", "method_id")


def ingest_and_clean(spark: SparkSession, landing: str, tables: Versions, checkpoint: str, order: str = "seq", cfg: RunConfig | None = None) -> None:
    """Raw rows (RAW without id, and a number to order them by) of the JSON files that landed since the last run, deduplicated, numbered and cleaned (D1 to D10, E, F), as new versions of the tables raw, polls, results and duplicates.

    Which rows have been seen is keyed streaming state in the checkpoint, a digest for each: no
    batch reads the raw table to know it (B1, B2); of rows of one batch that say the same any one
    stays.  A batch is one version, tagged with its
    number; one that is run again after a failure finds its tag and adds nothing.  Ids go on from
    the greatest one, so batches in order give the tables of one batch.
    """
    schema = StructType([f for f in spark.createDataFrame([], f"{RAW}, {order} long").schema.fields if f.name != "id"])
    digest = F.sha2(F.to_json(F.struct(*RAW_KEYS), {"ignoreNullFields": "false"}), 256)
    # The state of all days doesn't have to fit in memory.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(schema).json(landing).withColumn("digest", digest).dropDuplicates(["digest"]).drop("digest")
    clean = lambda batch, number: clean_batch(tables, batch, f"{checkpoint}#{number}", order, cfg)
    stream.writeStream.foreachBatch(clean).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def clean_batch(tables: Versions, batch: DataFrame, tag: str, order: str = "seq", cfg: RunConfig | None = None) -> bool:
    """Number and clean the new raw rows of a batch and commit them under its tag; False if that has been done."""
    spark = batch.sparkSession
    if tables.tagged(tag):
        return False
    rows = stored(batch, "batch")
    raw_schema = f"{RAW}, part int"
    known = tables.read("raw", raw_schema)
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    numbered = dense_numbers(rows, [order]).withColumn("id", (F.col("n") + top).cast("long"))
    new = stored(numbered.withColumn("part", F.floor(F.col("id") / RAW_IDS).cast("int")).select(*known.columns), "new-raw")
    blocks = [r["part"] for r in new.select("part").distinct().collect()]
    run = clean_run(spark, tables, new.drop("part"), "incremental", cfg=cfg)
    commit_run(tables, run, {"raw": Change(known.filter(F.col("part").isin(blocks)).unionByName(new), blocks)}, tag)
    return True
