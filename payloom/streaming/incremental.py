"""A folder of CSV files as a stream: the stream finds new files, and each goes through the same ingest as a file does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from payloom.plans.ingest import ingest
from payloom.sources.store import Store

FOUND = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(spark: SparkSession, folder: str, store: Store, checkpoint: str, quarantine: str | None = None, files: int = 8) -> StreamingQuery:
    """Ingest the files that are there, so many per micro-batch, then stop; a later call takes up only new ones.

    A micro-batch is published with its ledger rows at once; one that is repeated after a failure finds its files in the ledger.
    Only the paths are read here (the bytes of a binary file are read if its content is asked for)."""
    found = spark.readStream.format("binaryFile").schema(FOUND).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files).load(folder).select("path", "modificationTime")

    def batch(df: DataFrame, number: int) -> None:
        paths = [r["path"] for r in df.orderBy("modificationTime", "path").collect()]  # at most `files`
        ingest(store, paths, quarantine=quarantine)

    return found.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
