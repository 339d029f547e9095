"""Inverted-file vector index: cells of a k-means model, residual codes, exact scores of the best by code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosemill.session import ship

#: Vectors that cells and probes are fitted on, at most; rounds of fitting; cells at most.
SAMPLE, ROUNDS, CELLS = 65_536, 10, 4096
#: Rows of a cell that one group holds on average, queries of a group, and how many times k are scored exactly.
BLOCK, QUERIES, RESCORED = 20_000, 2048, 4


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def drawn(rows: DataFrame, row_id: str = "vec_id") -> np.ndarray:
    """At most SAMPLE vectors, those with the smallest hash of their id; null vectors are left out."""
    some = rows.where(F.col("embedding").isNotNull()).orderBy(F.xxhash64(row_id), row_id).limit(SAMPLE)
    found = some.select("embedding").toArrow()
    return _matrix(found["embedding"]) if len(found) else np.zeros((0, 1))


def fit_cells(x: np.ndarray, cells: int) -> np.ndarray:
    """Centres of so many cells by k-means, the same on every run. A cell that loses all its vectors takes the vector farthest
    from its centre."""
    centres = np.unique(x, axis=0)
    centres = centres[np.random.default_rng(7).permutation(len(centres))][:cells].copy()
    for _ in range(ROUNDS if len(centres) else 0):
        near, far = _nearest(x, centres)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[np.argsort(-far, kind="stable")[: len(empty)]]
    return centres


def fit_probes(x: np.ndarray, centres: np.ndarray, target: float = 0.95, k: int = 10, queries: int = 256) -> int:
    """How many nearest cells hold the target's share of the k nearest of the sample's first vectors, in the sample.

    In the whole table the nearest are nearer still, so there their cells come no later.
    """
    if not len(x):
        return 1
    q, (cell, _) = x[:queries], _nearest(x, centres)
    top = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]
    place = np.argsort(_aim(q, centres), axis=1)
    needed = np.sort(np.take_along_axis(place, cell[top], 1).reshape(-1)) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])


def _aim(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The cells by distance from each query."""
    return np.argsort((centres**2).sum(1) - 2 * q @ centres.T, axis=1, kind="stable")


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector, and the squared distance."""
    at, far, own = np.empty(len(x), np.int64), np.empty(len(x)), (centres**2).sum(1)
    for a in range(0, len(x), 4096):
        d = own - 2 * x[a : a + 4096] @ centres.T
        at[a : a + 4096] = d.argmin(1)
        far[a : a + 4096] = d.min(1) + (x[a : a + 4096] ** 2).sum(1)
    return at, far


def write_index(rows: DataFrame, path: str, row_id: str = "vec_id", cells: int | None = None, target: float = 0.95) -> None:
    """Writes path/cells (the centres, a row each) and path/vectors: cell, block, row id, code, scale, embedding.

    There are as many cells as the root of the table's rows, at most CELLS, if no number is given; they and the number of
    cells that a query probes (for the target's share of neighbours) are fitted on a sample. Every vector is indexed. A code is the rest after the cell's centre, a byte a dimension with one scale; a block is a
    part of its cell by a hash, so a cell that holds most vectors is many groups. Files follow the order of cells.
    """
    ship(rows.sparkSession)
    sample = drawn(rows, row_id)
    centres = fit_cells(sample, cells or max(1, min(CELLS, round(rows.where(F.col("embedding").isNotNull()).count() ** 0.5))))
    probes = fit_probes(sample, centres, target)

    def coded(batches):
        for b in batches:
            x = _matrix(b.column(1))
            cell, _ = _nearest(x, centres)
            rest = x - centres[cell]
            scale = np.maximum(np.abs(rest).max(1), 1e-12) / 127
            code = np.rint(rest / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), b.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), b.column(1)], names=["cell", row_id, "code", "scale", "embedding"])

    own = rows.where(F.col("embedding").isNotNull()).select(F.col(row_id).cast("long").alias(row_id), F.col("embedding").cast("array<float>").alias("embedding"))
    vectors = own.mapInArrow(coded, f"cell int, {row_id} long, code binary, scale double, embedding array<float>")
    spark = rows.sparkSession
    vectors.write.parquet(f"{path}/unsorted")
    vectors = spark.read.parquet(f"{path}/unsorted")
    sizes = vectors.groupBy("cell").agg(F.count("*").alias("n"))
    table = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cell int, centre array<double>").join(sizes, "cell", "left")
    table = table.select("cell", "centre", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.ceil(F.coalesce("n", F.lit(0)) / BLOCK).cast("int").alias("blocks"), F.lit(probes).alias("probes"))
    table.coalesce(1).write.parquet(f"{path}/cells")
    blocks = F.broadcast(spark.read.parquet(f"{path}/cells").select("cell", "blocks"))  # CELLS rows at most
    block = F.pmod(F.xxhash64(row_id), F.greatest("blocks", F.lit(1))).cast("int")
    vectors.join(blocks, "cell").withColumn("block", block).drop("blocks").repartitionByRange("cell", "block").sortWithinPartitions("cell", "block").write.parquet(f"{path}/vectors")


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, threshold: float = 0.72, probes: int | None = None, row_id: str = "vec_id") -> DataFrame:
    """query_id, row id, similarity, rank: of the vectors in each query's nearest cells (as many as the index was fitted for, if no
    number is given), the k most similar, at least the threshold.

    queries: query_id, query_embedding; any number, as they are dealt with their cells. A group is a block of a cell with
    some of its queries: codes choose the RESCORED * k best, whose scores are then exact. With as many probes as cells
    only the codes stand between this and brute force. Ties go to the smaller id; null vectors are no queries.
    """
    ship(spark)
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()
    centres, blocks = (_matrix(cells["centre"]) if len(cells) else np.zeros((0, 1))), np.asarray(cells["blocks"])
    probes = probes or (cells["probes"][0].as_py() if len(cells) else 1)

    def aimed(batches):
        for b in batches:
            q = _matrix(b.column(1))
            best = _aim(q, centres)[:, :probes] if len(centres) else np.zeros((len(q), 0), np.int64)
            who, cell = np.repeat(np.arange(len(q)), best.shape[1]), best.reshape(-1)
            times = blocks[cell]
            who, cell = np.repeat(who, times), np.repeat(cell, times)
            block = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
            take = pa.array(who)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(block, pa.int32()), b.column(0).take(take), b.column(1).take(take)], names=["cell", "block", "query_id", "query_embedding"])

    own = queries.where(F.col("query_embedding").isNotNull()).select(F.col("query_id").cast("long").alias("query_id"), F.col("query_embedding").cast("array<float>").alias("query_embedding"))
    asked = own.mapInArrow(aimed, "cell int, block int, query_id long, query_embedding array<float>")

    def best(key: tuple, vectors: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(vectors) and len(wanted):
            x, ids = _matrix(vectors["embedding"]), vectors[row_id].to_numpy()
            code = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.int8).reshape(len(x), -1) * vectors["scale"].to_numpy()[:, None]
            centre, most = centres[key[0].as_py()], min(len(x), RESCORED * k)
            q_all, q_ids = _matrix(wanted["query_embedding"]), wanted["query_id"].to_numpy()
            for a in range(0, len(q_all), 256):
                q = q_all[a : a + 256]
                near = q @ code.T + (q @ centre)[:, None]
                chosen = np.argpartition(-near, most - 1, axis=1)[:, :most]
                exact = np.einsum("qd,qmd->qm", q, x[chosen])
                order = np.lexsort((ids[chosen], -exact), axis=1)[:, :k]
                s, v = np.take_along_axis(exact, order, 1), np.take_along_axis(ids[chosen], order, 1)
                r, c = np.nonzero(s >= threshold)
                out[0].append(q_ids[a + r]), out[1].append(v[r, c]), out[2].append(s[r, c])
        return pa.table({n: np.concatenate([np.zeros(0, t), *o]) for n, t, o in zip(("query_id", row_id, "similarity"), (np.int64, np.int64, np.float64), out)})

    # Queries of a cell may be many: they come in parts, each of which meets the cell's vectors.
    vectors = spark.read.parquet(f"{path}/vectors")
    # A row for each cell, CELLS at most.
    counts = [(r[0], -(-r[1] // QUERIES)) for r in asked.groupBy("cell").agg(F.count_distinct("query_id")).collect()]
    parts = F.broadcast(spark.createDataFrame(counts, "cell int, parts int"))
    asked = asked.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")).drop("parts")
    dealt = vectors.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    key = ["cell", "block", "part"]
    found = dealt.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(best, f"query_id long, {row_id} long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), row_id))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def recall(found: DataFrame, wanted: DataFrame, row_id: str = "vec_id") -> DataFrame:
    """n_queries, n_wanted and the share of wanted rows (query_id, row id) that were found."""
    hit = wanted.select("query_id", row_id).join(found.select("query_id", row_id, F.lit(1).alias("__hit")), ["query_id", row_id], "left")
    return hit.agg(F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_wanted"), (F.count("__hit") / F.greatest(F.count("*"), F.lit(1))).alias("recall"))

