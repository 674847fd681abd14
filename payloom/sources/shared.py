"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, local runs get a temporary one; a cluster must name one."""
    context = spark.sparkContext
    found = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="payloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


_FOLDERS: list[str] = []


def measured(df: DataFrame, path: str, columns: list[str] | None = None, **measures: Column) -> dict:
    """Write rows, or some columns of them, as Parquet; the values of aggregates over them, taken as the rows go by, so without a further pass."""
    watch = Observation()
    seen = df.observe(watch, *[c.alias(name) for name, c in measures.items()]) if measures else df
    (seen.select(*columns) if columns else seen).write.mode("overwrite").parquet(path)
    return watch.get if measures else {}


def written(df: DataFrame, counts: dict | None = None, **measures: Column) -> DataFrame:
    """The same rows, computed once and written into the shared folder, so that lost executors cost only their tasks. `counts` takes the values of measures."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid4().hex}"
    found = measured(df, path, **measures)
    if counts is not None:
        counts.update(found)
    _FOLDERS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete all written rows but those of the first `keep` folders, once no later plan reads them."""
    for path in _FOLDERS[keep:]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    del _FOLDERS[keep:]


def mark() -> int:
    """How many folders are written so far, for release."""
    return len(_FOLDERS)
