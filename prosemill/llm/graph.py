"""Connected components by alternating large-star and small-star rounds on DataFrames.

Each round only takes minima per node (aggregated before the shuffle) and joins them back; no neighbour list is
gathered, and nothing but two counters reaches the driver. Rounds cost shuffles whatever the size is, so edges that fit
WHOLE are solved by one task; the components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import BROADCAST_BYTES, written


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node of each node's component, by hooking and pointer jumping."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each partition's edges, replaced by a star for each of its local components."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    for batch in batches:
        u, v = (batch.column(i).to_numpy() for i in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        low = nodes[roots(at[: len(u)], at[len(u) :], len(nodes))]
        keep = low != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(low[keep])], schema=schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_forest of all edges at once."""
    cols = [np.concatenate(x) for x in zip(*([c.to_numpy() for c in batch.columns] for batch in batches))]
    if cols:
        yield from _forest(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["u", "v"])]))


#: Edges that one task solves, at most: as many as a broadcast side may have.
WHOLE = BROADCAST_BYTES // 16
#: Rounds at most; they grow with the square of the logarithm of the edges, so this is never reached in practice.
ROUNDS = 64


def _met(edges: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """edges (u, v) with their node's m. Nodes with 1 of 4096 edges or more are 4096 at most: they are broadcast, so that
    the edges of a hub stay where they are; the others meet by a shuffle."""
    low = written(low, "lows")
    hubs = F.broadcast(low.where(F.col("size") * 4096 >= total).select("u", "m"))
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(low.where(F.col("size") * 4096 < total).select("u", "m"), "u")
    return edges.join(hubs, "u").unionByName(rest)


def _rounds(e: DataFrame) -> DataFrame:
    """Edges (u, v) as stars: every node but a component's smallest with that."""
    was = None
    for _ in range(ROUNDS):
        said = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if not said[0] or said == was:
            return e
        was = said
        both = e.union(e.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("size"))
        large = _met(both, low, 2 * said[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
        small = _met(large, low, said[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).distinct()
        e = written(small, "edges")
    raise RuntimeError(f"components did not converge in {ROUNDS} rounds")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of an edge with the smallest node that it reaches. Loops are dropped."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(_forest, "u long, v long")
    e = written(e, "edges")
    if e.count() <= WHOLE:
        e = written(e.coalesce(1).mapInArrow(_whole, "u long, v long"), "edges")
    else:
        e = _rounds(written(e.distinct(), "edges"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
