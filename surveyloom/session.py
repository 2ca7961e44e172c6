"""Making the package known to Python workers."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of the session, once: a zip of its sources, by Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / f"{top.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and a lost executor costs nothing that is written."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which driver and executors share; where that is unset, one of our own for a local session, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
