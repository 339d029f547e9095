"""Filtered vector search and its evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.functions.patterns import has
from prosemill.session import ship


#: Scores that a task holds at a time, queries whose rows it gives at a time.
TILE, ROWS_OUT = 1 << 20, 4096


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def embedding_text(context: Column, criteria: Column, step: Column) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in (context, criteria, step)])


def row_hash(context: Column, criteria: Column, step: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (context, criteria, step)]), 256), 1, 12)


def hashed_encoder(dim: int = 64):
    """An encoder that needs no model: signed feature hashing of words, unit length. Any function texts -> matrix will do instead."""
    import zlib

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[i, h % dim] += 1 if h >> 16 & 1 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    return encode


def embedded(df: DataFrame, text: str, encode) -> DataFrame:
    """Adds embedding (array<float>) by an encoder that takes a list of texts, in Arrow batches."""

    ship(df.sparkSession)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(encode(s.fillna("").tolist())))

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("embedding", F.pandas_udf(of, "array<float>")(F.col(text)))


def embedded_incremental(df: DataFrame, known: DataFrame, key: str, text: str, encode) -> DataFrame:
    """All rows of df with their embedding: from known (key, embedding) where it has the key, else by the encoder.

    A vector goes to a row by the key (such as row_hash), never by its place; only texts of new keys are encoded, one
    for each key. A null key is never known, and each row with one is encoded.
    """
    old = known.where(F.col(key).isNotNull()).groupBy(key).agg(F.first("embedding").alias("embedding"))
    fresh = df.where(F.col(key).isNotNull()).join(old.select(key), key, "left_anti").groupBy(key).agg(F.first(text).alias("__text"))
    vectors = old.select(key, "embedding").unionByName(embedded(fresh, "__text", encode).select(key, "embedding"))
    keyed = df.where(F.col(key).isNotNull()).join(vectors, key)
    return keyed.unionByName(embedded(df.where(F.col(key).isNull()), text, encode))


def metadata_filter(step: str | None = None, industry: str | None = None, min_confidence: float = 0.0, columns: tuple[str, str, str] = ("workflow_step", "industry_hint", "confidence")) -> Column:
    """Rows whose step and industry hold a pattern, in any case, and whose confidence is high enough; null never matches."""
    out = F.lit(True)
    for pattern, column in ((step, columns[0]), (industry, columns[1])):
        if pattern:
            out = out & has(F.col(column), pattern)
    return out & (F.col(columns[2]) >= min_confidence) if min_confidence > 0 else out


def retrieved(rows: DataFrame, query: list[float], k: int = 10, threshold: float = 0.72, row_id: str = "vec_id", step: str | None = None, industry: str | None = None, min_confidence: float = 0.0) -> DataFrame:
    """The k best rows that the metadata filter lets through, with similarity_score in four digits."""
    found = top_k(rows, query, k, threshold, row_id, metadata_filter(step, industry, min_confidence))
    return found.withColumn("similarity_score", F.round("similarity", 4)).drop("similarity")


def top_k(rows: DataFrame, query: list[float], k: int = 10, threshold: float = 0.72, row_id: str = "vec_id", where: Column | None = None) -> DataFrame:
    """The k rows most similar to one query, at least the threshold. Filters come before scoring; ties go to the smaller id."""
    kept = rows.where(where) if where is not None else rows
    scored = kept.withColumn("similarity", dot(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query]))).drop("embedding")
    return scored.where(F.col("similarity") >= threshold).orderBy(F.desc("similarity"), row_id).limit(k)


def top_k_each(rows: DataFrame, queries: DataFrame, k: int = 10, threshold: float = 0.72, row_id: str = "vec_id", block: int = 10_000) -> DataFrame:
    """The k most similar rows for each of a stated set of queries (query_id, query_embedding), against all rows.

    Queries are taken in blocks by a hash, of about so many; a block goes with every task. Each task scores its rows in
    tiles of a fixed size and keeps its own k best, so its memory is that of the block, whatever the threshold lets through;
    what is shuffled is k rows for each query and task, and the final ranking is over those. For many
    queries over many rows there is the index of operators/vectors.
    """
    ship(rows.sparkSession)
    blocks = max(1, -(-queries.count() // block))
    parts = [_block_best(rows, queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b), k, threshold, row_id) for b in range(blocks)]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), row_id))
    return reduce(DataFrame.unionByName, parts).withColumn("rank", rank).where(F.col("rank") <= k)


def k_best(batches: Iterator[pa.RecordBatch], matrix: np.ndarray, k: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places of queries, row ids, scores) of the k best of all rows (id, embedding) for each query, a row of matrix."""
    n = len(matrix)
    # The k best so far of each query; a place without a row has the lowest score and the largest id.
    top_s, top_v = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(1)))
        if not len(batch) or not n:
            continue
        ids, x = batch.column(0).to_numpy(zero_copy_only=False), np.asarray(batch.column(1).flatten(), np.float64).reshape(len(batch), -1)
        step = max(1, TILE // len(x))
        for a in range(0, n, step):
            s = matrix[a : a + step] @ x.T
            floor = np.maximum(top_s[a : a + step, -1], threshold)[:, None]
            # Only queries that a row reaches the floor of are ranked anew.
            for q in np.flatnonzero((s >= floor).any(1)):
                near = np.flatnonzero(s[q] >= floor[q])
                if len(near) > k:  # the k-th best score and all that tie with it
                    near = near[s[q, near] >= np.partition(s[q, near], -k)[-k]]
                score, row = np.concatenate([top_s[a + q], s[q, near]]), np.concatenate([top_v[a + q], ids[near]])
                order = np.lexsort((row, -score))[:k]
                top_s[a + q], top_v[a + q] = score[order], row[order]
    for a in range(0, n, ROWS_OUT):
        q, place = np.nonzero(np.isfinite(top_s[a : a + ROWS_OUT]))
        yield a + q, top_v[a + q, place], top_s[a + q, place]


def _block_best(rows: DataFrame, queries: DataFrame, k: int, threshold: float, row_id: str) -> DataFrame:
    """Each task's k best rows for one block of queries."""
    found = queries.collect()
    ids = np.array([q["query_id"] for q in found], np.int64)
    matrix = np.array([q["query_embedding"] for q in found], np.float64).reshape(len(found), -1 if found else 0)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, v, score in k_best(batches, matrix, k, threshold):
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(v), pa.array(score)], names=["query_id", row_id, "similarity"])

    return rows.select(F.col(row_id).cast("long").alias(row_id), "embedding").mapInArrow(best, f"query_id long, {row_id} long, similarity double")


def eval_report(results: DataFrame, expectations: DataFrame) -> DataFrame:
    """For each expectation (query_id, min_results, expected): how many results, whether enough, whether a label is met.

    results: query_id, label. An expected text is met as a part of a label; without results the labels aren't tested.
    """
    got = results.join(expectations.select("query_id", "expected"), "query_id")
    got = got.groupBy("query_id").agg(F.count("*").alias("n_results"), F.max(F.exists("expected", lambda x: F.col("label").cast("string").contains(x.cast("string"))).cast("int")).alias("hit"))
    out = expectations.join(got, "query_id", "left").withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    count_pass, label_pass = F.col("n_results") >= F.col("min_results"), (F.col("n_results") == 0) | (F.col("hit") == 1)
    return out.select("query_id", "n_results", count_pass.alias("count_pass"), label_pass.alias("label_pass"), (count_pass & label_pass).alias("overall_pass"))
