"""Incremental runs over arriving files: every file once, exactly as far as the checkpoint says."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arriving(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """A stream of (path, sha256, at) of new files below a folder."""
    s = spark.readStream.format("binaryFile").schema(SCHEMA).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return s.select("path", F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("at"))


def run_once(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Handle what has arrived since the last run, then stop; ``handle`` gets each batch and its number."""
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
