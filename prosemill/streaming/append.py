"""Appends that keep the first row of each key: the keys met before are a stream's state, so the table is never read again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prosemill.session import ship

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Timestamps keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _sortable(df: DataFrame, column: str) -> Column:
    """A value of the same order that pandas holds exactly, nulls too: a decimal, a double or a string."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return c.cast("decimal(20,0)")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("decimal(20,0)")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("decimal(20,0)")
    return c if isinstance(kind, T.DecimalType) else c.cast("double") if isinstance(kind, T.FractionalType) else c.cast("string")


def first_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """Of each key the first row by the columns that follow it, nulls last. Only keys that are there twice are sorted."""
    twice = frame.duplicated("met_key", keep=False)
    if not twice.any():
        return frame
    first = frame[twice].sort_values(list(frame.columns[1:]), kind="stable", na_position="last").drop_duplicates("met_key")
    return pd.concat([frame[~twice], first])


#: Groups of keys of a batch that are settled at a time.
GROUPS = 4096


def first_of_keys(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of a stream whose key is met for the first time: the earliest batch's, in it the first by order.

    Rows without a key (null or empty) are left out. Nulls of the order come last (NaN as well), ties go by the row's JSON,
    in which rows are carried, so that Python changes no value. Rows are thinned to one a key in each Arrow batch before
    they are shuffled, so a key that holds a third of the rows sends a few of them. What is left of a batch is settled by
    groups of keys; then a key has one row, and Spark's own deduplication, whose state is the keys, tells whether it is new.
    """
    ship(stream.sparkSession)
    keyed = F.col(key).cast("string").alias("met_key")
    rows = stream.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    rows = rows.select(keyed, *[_sortable(stream, c).alias(f"order_{k}") for k, c in enumerate(order)], F.to_json(F.struct(*stream.columns), _JSON).alias("row_json"))
    schema = rows.schema

    def thinned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield first_rows(frame)

    thin = rows.mapInPandas(thinned, schema)
    settled = thin.groupBy(F.pmod(F.xxhash64("met_key"), F.lit(GROUPS)).alias("dealt")).applyInPandas(lambda frame: first_rows(frame[schema.names]), schema)
    return settled.dropDuplicates(["met_key"]).select(F.from_json("row_json", stream.schema, _JSON).alias("row")).select("row.*")


def append_first(spark: SparkSession, source: str, schema: T.StructType | str, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "url", order: tuple[str, ...] = (), max_files: int = 1000) -> StreamingQuery:
    """Takes Parquet files that have come since the last run and appends the rows of new keys, then stops.

    transform works on the stream. Each batch is one folder batch=<number> below target, written anew if the batch runs
    again, and the state goes back with it: a failed batch leaves nothing and loses nothing. One stream a checkpoint.
    """
    stream = transform(spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source))

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    before = spark.conf.get(_PROVIDER, None)
    # A query keeps the settings that it was started with.
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = first_of_keys(stream, key, list(order)).writeStream.foreachBatch(publish)
        return out.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
