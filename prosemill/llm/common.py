"""Shared pieces of the corpus operators: written intermediate tables, checked broadcasts, small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.session import shared_dir, ship

#: A side of a join is broadcast only if it was counted to be at most this many bytes.
BROADCAST_BYTES = 32 << 20


def tune(spark: SparkSession, batch_mb: int = 6, rows: int = 4096) -> None:
    """Ships the package and bounds Arrow batches by bytes, so that very long texts don't pile up in a Python worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_mb << 20))


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here, and a lost executor costs no recomputation.

    With by, the table is partitioned by these columns, so that a test on them reads the files of its values alone.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/prosemill/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows stay below BROADCAST_BYTES, else as it is (a shuffle join follows)."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def only_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """docs whose key is (left_semi) or isn't (left_anti) in ids; null keys equal each other."""
    right = checked_broadcast(ids.select(F.col(key).alias("__key")), 24)
    return docs.join(right, docs[key].eqNullSafe(right["__key"]), how)


def attach(left: DataFrame, right: DataFrame, key: str, size: str, total: int, row_bytes: int) -> DataFrame:
    """Left join with groups that may be very unequal: right has a row for each key and its size in rows of left.

    Groups of at least 1 / n of all rows number n at most, with n such that they fit BROADCAST_BYTES; so they are
    broadcast whatever the input is. The rest is broadcast if counted small, else it meets by a shuffle join in which no
    key has more than 1 / n of all rows.
    """
    if right.count() * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), key, "left")
    n = max(1, min(1 << 16, BROADCAST_BYTES // max(1, row_bytes)))
    hot = F.broadcast(right.where(F.col(size) * n >= total))
    cold = right.where(F.col(size) * n < total)
    some = left.join(hot, key, "inner")
    rest = left.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return some.select(*rest.columns).unionByName(rest)
