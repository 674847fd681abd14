"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java class of the white space that separates words in every contract.
WHITESPACE = r"[ \t\n\x0B\f\r]+"

#: Rows of a file of a small table.
FILE_ROWS = 200_000
#: Rows in one Arrow batch: whole texts travel in it, so the default of 10,000 would be hundreds of MB.
ARROW_ROWS = 500


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small. This is a setting of the session, so it holds for other queries, too, which it costs little."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo the modulus; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir. Where none is set, local runs get a temporary one; a cluster must name one."""
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="payloom-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table into the shared folder and read it again: cuts the lineage, survives lost executors.

    If it's known to have at most so many rows, it is written in files of about FILE_ROWS."""
    path = shared_dir(df.sparkSession, name)
    (df if rows is None else df.coalesce(1 + rows // FILE_ROWS)).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    _FOLDERS.append(path)
    return out


_FOLDERS: list[str] = []


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the folders of materialized tables that no later plan reads; without tables, all that this process wrote."""
    for path in [f.written_to for f in frames] if frames else list(_FOLDERS):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        _FOLDERS.remove(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def keys_of(words: list[bytes]) -> np.ndarray:
    """64-bit keys of words. Hashing each anew takes half the time of looking it up among many, and no memory."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
