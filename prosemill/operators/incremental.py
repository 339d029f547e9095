"""Incremental batch work: manifests, caches, content keys, atomic appends."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.operators.text import truncated

STAGES = ("ingest", "filter", "extract", "validate", "package")


def latest(entries: DataFrame, key: str, order: str) -> DataFrame:
    return entries.groupBy(key).agg(F.max_by(F.struct(*entries.columns), order).alias("__row")).select("__row.*")


def pending(selected: DataFrame, entries: DataFrame, key: str, order: str) -> DataFrame:
    """Selected keys whose latest entry isn't complete: failed ones come again."""
    done = latest(entries, key, order).where(F.col("status") == "complete").select(key)
    return selected.join(done, key, "left_anti")


def manifest_summary(entries: DataFrame, key: str, order: str) -> DataFrame:
    """Counts and sums over the latest entries, by status."""
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("records_retained", "records_scanned") if c in entries.columns]
    return latest(entries, key, order).groupBy("status").agg(F.count("*").alias("n"), *sums)


def invalidated(done: list[str], stage: str) -> list[str]:
    """Stages that stay done when one is run again: those before it."""
    return [s for s in done if STAGES.index(s) < STAGES.index(stage)]


def cache_key(text: Column) -> Column:
    """16 hex digits of the SHA-256 of the lower-cased text with white space collapsed."""
    norm = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "), "^ | $", "")
    return F.substring(F.sha2(norm, 256), 1, 16)


def content_key(url: Column, text: Column, mark: str = "c", chars: int = 50) -> Column:
    """url#mark and 8 hex digits of the MD5 of the text's beginning."""
    return F.concat(F.coalesce(url, F.lit("")), F.lit("#" + mark), F.substring(F.md5(F.encode(F.substring(F.coalesce(text, F.lit("")), 1, chars), "UTF-8")), 1, 8))


def with_cache(df: DataFrame, cache: DataFrame, text: str) -> DataFrame:
    """Adds cache_key, data and hit, from a cache (cache_key, data) with a row for each key."""
    own = df.withColumn("cache_key", cache_key(F.col(text)))
    return own.join(cache.select("cache_key", "data", F.lit(True).alias("hit")), "cache_key", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def cache_stats(looked_up: DataFrame) -> DataFrame:
    hits = F.count_if("hit")
    return looked_up.agg(hits.alias("n_hits"), (F.count("*") - hits).alias("n_misses"), F.bround(hits / F.greatest(F.count("*"), F.lit(1)), 4).alias("hit_rate"))


def fallback(df: DataFrame, cache: DataFrame, classify, text: str, value: str = "confidence", below: float = 0.4, most: int = 500) -> DataFrame:
    """Answers for the rows of least confidence (at most so many, a stated limit): from the cache, else from classify.

    classify takes a list of texts and returns a list of JSON strings or None; it is never called without being given.
    """
    low = df.where(F.col(value) < below).orderBy(value, text).limit(most)
    found = with_cache(low, cache, text)
    if classify is None:
        return found

    def ask(batches):
        for b in batches:
            miss = ~b["hit"]
            if miss.any():
                b.loc[miss, "data"] = classify(b.loc[miss, text].tolist())
            yield b

    return found.mapInPandas(ask, found.schema)


#: Keys that a classifier's answer must have.
ANSWER = ("decision_context", "criteria", "objection", "workflow_step", "industry_hint", "confidence")


def answered_rows(df: DataFrame, data: str = "data", most: int = 240) -> DataFrame:
    """Rows of the answers (JSON texts) that are whole: they have every key of ANSWER and no true skip mark.

    Adds the keys as columns (decision_context cut to most characters, confidence a double); other answers give no row.
    """
    answer = F.from_json(F.col(data), "map<string,string>")
    whole = reduce(lambda a, b: a & b, [F.map_contains_key("__answer", F.lit(k)) for k in ANSWER])
    skip = F.coalesce(F.col("__answer")["skip"], F.lit("false")).isin("", "0", "false", "null")
    out = df.withColumn("__answer", answer).where(F.col("__answer").isNotNull()).where(whole & skip)
    values = {k: F.col("__answer")[k] for k in ANSWER}
    values["decision_context"] = truncated(values["decision_context"], most)
    values["confidence"] = values["confidence"].try_cast("double")
    return out.withColumns(values).where("confidence IS NOT NULL").drop("__answer", data)


def cacheable(df: DataFrame, data: str = "data") -> DataFrame:
    """(cache_key, data) of answers: what can't be read is kept as a mark to skip, so that it isn't asked again."""
    bad = F.from_json(F.col(data), "map<string,string>").isNull()
    return df.select("cache_key", F.when(bad, F.lit('{"skip": true, "error": "not JSON"}')).otherwise(F.col(data)).alias("data")).dropDuplicates(["cache_key"])


def append_new(batch: DataFrame, path: str, key: str) -> None:
    """Appends rows with keys that the table at path doesn't have; rows without a key (null or empty) are left out.

    A key met twice in the batch comes once. The rows are written to a hidden folder below path, which is then renamed
    to batch=...: a batch is seen whole or not at all, and a retry adds nothing. One writer at a time.
    """
    spark = batch.sparkSession
    new = batch.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").dropDuplicates([key])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop(path)) and len(fs.listStatus(hadoop(path))):
        new = new.join(read_appended(spark, path).select(key), key, "left_anti")
    name = uuid.uuid4().hex
    new.write.parquet(f"{path}/_batch-{name}")
    if not fs.rename(hadoop(f"{path}/_batch-{name}"), hadoop(f"{path}/batch={name}")):
        raise OSError(f"could not publish {path}/batch={name}")


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The table that append_new writes, of all its batches, without the column that tells them."""
    return spark.read.parquet(path).drop("batch")
