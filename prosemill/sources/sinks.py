"""Sinks: shards, JSON, debug samples, SQL inserts, schema files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosemill.operators.report import stratified_sample
from prosemill.operators.text import truncated


def write_shards(df: DataFrame, path: str, by: str = "segment_id") -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_validated(passing: DataFrame, flagged: DataFrame, path: str) -> list[str]:
    """Writes path/validated and, if there are flagged rows, path/flagged; returns what was written."""
    parts = {"validated": passing} | ({"flagged": flagged} if flagged.head(1) else {})
    for name, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    return list(parts)


def debug_sample(df: DataFrame, status: str, key: str, text: str, k: int = 50) -> DataFrame:
    """k rows of each status, texts cut to 300 characters."""
    return stratified_sample(df, status, key, k).withColumn(text, F.substring(F.col(text), 1, 300))


def _six_digits(x: Column) -> Column:
    """Six digits after the point, rounded as C does: ties go to the even digit, where Java's format goes up.

    A float has 24 bits and its product with 10^6 at most 38, so it is rounded without an error. Floats from 2^33 on are whole.
    """
    value = x.cast("double")
    return F.format_string("%.6f", F.when(F.abs(value) < 1 << 33, F.rint(value * 1e6) / 1e6).otherwise(value))


def insert_statements(df: DataFrame, table: str, texts: list[str], vector: str, most: int = 240) -> DataFrame:
    """One SQL insert a row: quotes doubled, texts cut, numbers of the vector with six digits."""
    quoted = [F.concat(F.lit("'"), F.replace(truncated(F.coalesce(F.col(c), F.lit("")), most), F.lit("'"), F.lit("''")), F.lit("'")) for c in texts]
    numbers: Column = F.concat(F.lit("'["), F.array_join(F.transform(vector, _six_digits), ","), F.lit("]'"))
    head = f"INSERT INTO {table} ({', '.join([*texts, vector])}) VALUES ("
    return df.select(F.concat(F.lit(head), F.concat_ws(", ", *quoted, numbers), F.lit(");")).alias("value"))


def schema_json(schema: T.StructType, notes: dict[str, dict]) -> str:
    """The schema with notes (description, nullable, range, max_length) as field metadata."""
    fields = [T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, **notes.get(f.name, {})}) for f in schema.fields]
    return json.dumps(json.loads(T.StructType(fields).json()), indent=2)


def provenance_json(spark: SparkSession, reports: list[str], **about) -> str:
    """The reports of the stages (paths of small JSON files, in the stages' order) as one chain; files that aren't there are left out."""
    hadoop, found = spark._jvm.org.apache.hadoop.fs.Path, []
    for path in reports:
        if hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(path)):
            found.append(json.loads(spark.read.text(path, wholetext=True).first()[0]))
    return json.dumps({**about, "pipeline_stages": found}, indent=2)


def report_json(df: DataFrame) -> str:
    """A report of one row as JSON."""
    return json.dumps(df.first().asDict(recursive=True), default=str)
