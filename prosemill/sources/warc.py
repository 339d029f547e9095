"""WET files: records split at line starts, headers by pattern, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.functions.patterns import strip


def _header(record: Column, name: str) -> Column:
    return strip(F.regexp_extract(record, rf"(?m)^{name}:([^\r\n]*)", 1))


def wet_records(raw: DataFrame, record: str = "value", at_least: int = 100, only: str | None = None) -> DataFrame:
    """url, crawl_date, text of raw records (what stands between WARC/1.0 lines); needs a URL and a body of that length.

    The header ends at the first blank line after the URL or date; only keeps one type of record, such as conversion.
    """
    r = F.regexp_replace(F.regexp_replace(F.col(record), r"\r\n", "\n"), r"^WARC/1\.0(?=\n)", "")
    body = strip(F.regexp_extract(r, r"(?s)WARC-(?:Target-URI|Date):.*?\n[ \t]*\n(.*)", 1))
    out = raw.select(_header(r, "WARC-Target-URI").alias("url"), _header(r, "WARC-Date").alias("crawl_date"), _header(r, "WARC-Type").alias("warc_type"), body.alias("text"))
    out = out.where((F.col("url") != "") & (F.length("text") >= at_least))
    return out.where(F.col("warc_type") == only) if only else out


def read_wet(spark: SparkSession, path: str, **options) -> DataFrame:
    """Reads WET files, compressed or not; the reader streams them record by record.

    A record starts where a line begins with WARC/1.0, whatever ends the lines; the same words inside a line are text.
    """
    return wet_records(spark.read.option("lineSep", "\nWARC/1.0").text(path), **options)


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """A list of paths, one a line; blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")
