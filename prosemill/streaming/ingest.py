"""Incremental ingestion: a file stream whose checkpoint is the manifest, each batch appended without known keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from prosemill.operators.incremental import append_new


def ingest_new(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "url", max_files: int = 1000) -> StreamingQuery:
    """Takes files that have come since the last run, transforms them, appends rows with new keys, then stops.

    A file counts as done when its batch is committed; a batch that failed runs again, and its keys go in once.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)

    def append(batch: DataFrame, _: int) -> None:
        append_new(transform(batch), target, key)

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
