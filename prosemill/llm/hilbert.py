"""Sharding along a Hilbert curve: quantised metadata dimensions, one curve index, runs cut into shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import attach, checked_broadcast, tune, written

#: Levels of each dimension: 2 ** BITS.
BITS = 6


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of rows of coordinates below 2 ** bits (Skilling's transform, for all rows at once)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _curve(*cells: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in cells], 1), BITS))


def string_rank(column: Column) -> Column:
    """The first seven bytes as a number: keeps the order of strings, so that quantiles of strings can be taken."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.coalesce(column, F.lit("")), "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")


def _below(cuts: list[float], value: Column) -> Column:
    return F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < value))


def _levels(df: DataFrame, names: list[str]) -> DataFrame:
    """Each column replaced by its level among 2 ** BITS quantiles over all rows; the cut points are a bounded list."""
    n = 1 << BITS
    cuts = df.agg(*[F.percentile_approx(c, [i / n for i in range(1, n)], 10_000).alias(c) for c in names]).first()
    out = df
    for c in names:
        found = sorted({x for x in cuts[c] or [] if x is not None})
        out = out.withColumn(c, _below(found, F.col(c)) if found else F.lit(0))
    return out


def hilbert_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Puts every document into one of so many shards: rows sorted along the curve, cut into runs of equal counts.

    Returns doc_id, size (UTF-8 bytes + 16), text_crc32, law ('rows'), shard, slot, grown_shard (null), hilbert.
    Dimensions: language, source and size. Equal texts take the place of the one with the smallest doc_id, so they
    follow each other and part only at a cut. A null text has no bytes, null metadata sorts as empty. Ties go by text
    hash, then doc_id. With fewer documents than shards the last shards are empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tune(spark)
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    have = set(docs.columns)
    meta = [F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("hash"), *meta)
    rows = written(rows, "shard-rows")
    total = rows.count()
    first = rows.groupBy("hash", "size").agg(F.min_by(F.struct("lang", "source"), F.struct(F.col("doc_id").isNull(), "doc_id")).alias("of"), F.count("*").alias("copies"))
    cells = first.select("hash", "size", "copies", string_rank(F.col("of.lang")).alias("a"), string_rank(F.col("of.source")).alias("b"), F.log2("size").alias("c"))
    cells = _levels(written(cells, "shard-cells"), ["a", "b", "c"])
    curve = F.pandas_udf(_curve, "long")
    placed = written(cells.select("hash", F.col("size").alias("__size"), "copies", curve("a", "b", "c").alias("hilbert")), "shard-curve")
    keyed = placed.select(F.struct("hash", F.col("__size").alias("size")).alias("key"), "copies", "hilbert")
    every = attach(rows.withColumn("key", F.struct("hash", "size")), keyed, "key", "copies", total, 48)
    # A global rank: ranges of the order, the count of each range (as many numbers as ranges), the place in the range.
    ranges = max(1, -(-total // 100_000))
    order = ["hilbert", "hash", "doc_id"]
    sorted_rows = every.select("doc_id", "size", "text_crc32", *order[:2]).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ranked = written(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "shard-order")
    counts = {r[0]: r[1] for r in ranked.groupBy(F.shiftright("at", 33).alias("p")).count().collect()}
    before, starts = 0, []
    for p in sorted(counts):
        starts.append((p, before))
        before += counts[p]
    # One row for each range: a table of its own, not a literal in every row's expression.
    bases = checked_broadcast(spark.createDataFrame(starts, "__range long, __base long"), 16)
    ranked = ranked.withColumn("__range", F.shiftright("at", 33)).join(bases, "__range")
    rank = F.col("__base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    small, more = divmod(total, shards)
    # The first `more` shards have small + 1 rows.
    edge = more * (small + 1)
    shard = F.when(F.col("rank") < edge, F.expr(f"rank div {small + 1}")).otherwise(F.expr(f"{more} + (rank - {edge}) div {max(1, small)}"))
    slot = F.when(F.col("rank") < edge, F.col("rank") % (small + 1)).otherwise((F.col("rank") - edge) % max(1, small))
    return ranked.withColumn("rank", rank).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )
