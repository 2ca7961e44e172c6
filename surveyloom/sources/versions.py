"""Versions of tables: a run rewrites the partitions that it touches, and readers stay with the version they began with.

A version is a manifest, one small file: which folder holds which partition of which table.
Folders are written first, the manifest last, by one task whose file Spark's commit renames
into place; so a version is there as a whole or not at all, and what a lost run has left is in
no manifest.  Old folders stay, so old versions stay readable.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_MANIFEST = "version long, name string, part int, folder string, tag string"


@dataclass
class Change:
    """The rows of the touched partitions of a table, all of them, as they are from now on.

    rows has the column ``part`` (int) that partitions it; parts are those that are replaced,
    None for all.  What rows holds of other parts is an error that the caller makes: it is
    written but in no manifest.
    """

    rows: DataFrame
    parts: list[int] | None = None


class Versions:
    """The tables under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(f"{self.root}/manifests")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], _MANIFEST)
            raise

    def latest(self) -> int:
        """The last version, 0 if there is none yet."""
        return self._manifests().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def tagged(self, tag: str) -> bool:
        """Whether a version was committed under this tag."""
        return not self._manifests().filter(F.col("tag") == tag).isEmpty()

    def read(self, name: str, schema: StructType | str, version: int | None = None, parts: list[int] | None = None) -> DataFrame:
        """A table as of a version (the last one), with its column ``part``; of the given partitions only. It is empty before its first version."""
        at = self.latest() if version is None else version
        rows = self._manifests().filter((F.col("version") == at) & (F.col("name") == name))
        if parts is not None:
            rows = rows.filter(F.col("part").isin(parts))
        # One row for each partition of the table, years of publication say.
        folders = [r["folder"] for r in rows.select("folder").collect()]
        empty = self.spark.createDataFrame([], schema)
        return self.spark.read.schema(empty.schema).parquet(*folders) if folders else empty

    def commit(self, changes: dict[str, Change], tag: str | None = None) -> int:
        """Write the touched partitions and a manifest that names them beside the untouched ones of the version before; returns the new version.  Two writers of one version: the second one fails."""
        before = self.latest()
        kept = [r for r in self._manifests().filter(F.col("version") == before).collect() if not (r["name"] in changes and (changes[r["name"]].parts is None or r["part"] in changes[r["name"]].parts))]
        rows = [(before + 1, r["name"], r["part"], r["folder"], tag) for r in kept]
        for name, change in changes.items():
            folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
            # part stands in the files too, so that they can be read without their folder's name.
            change.rows.withColumn("__part", F.col("part")).write.partitionBy("__part").parquet(folder)
            written = self._parts(folder, change)
            rows += [(before + 1, name, part, f"{folder}/__part={part}", tag) for part in written]
        rows = rows or [(before + 1, "", None, "", tag)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("error").json(f"{self.root}/manifests/{before + 1:012d}")
        return before + 1

    def _parts(self, folder: str, change: Change) -> list[int]:
        try:
            found = [r[0] for r in self.spark.read.parquet(folder).select(F.col("__part").cast("int")).distinct().collect()]
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):  # no rows at all
                return []
            raise
        return [p for p in found if change.parts is None or p in change.parts]
