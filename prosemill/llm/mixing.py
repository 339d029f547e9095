"""Mixing sources to target weights by minimum-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Capacity flows from a pattern,
in tiers of its size that cost 0 for the first reading, 1 for the second, 2 for the third (a convex cost of repetition),
through its sources to their quotas. What a pattern gives a source is then turned into whole readings of its documents
and a seeded selection for the remainder: documents in the order of a hash, up to a cut, which is found from a
histogram over all hashes. The decision for a document needs only its own hash and its pattern's cuts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import tune, written

#: Buckets of the hash histogram of a pattern.
BUCKETS = 4096
#: Patterns that the flow is solved for, at most: their sizes come to the driver and the plan goes to every task.
PATTERNS = 100_000
#: Documents of a pattern and source that are looked at to fill what its cut leaves open.
FILL = 16


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight; none above most times its size, the excess reshared by weight."""
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(sum(sizes))
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        left -= sum(most * sizes[i] for i in full)
        for i in full:
            out[i] = float(most * sizes[i])
        open_ = [i for i in open_ if i not in full]
    return out


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], tiers: int = 3) -> dict[tuple[int, int], int]:
    """Words that pattern p gives source s, (p, s) -> amount: as much of the quotas as can be met, at least repetition cost.

    patterns: (sources, size). Successive shortest paths with potentials; ties go to the smaller node.
    """
    n_p, n_s = len(patterns), len(quotas)
    sink, graph = 1 + n_p + n_s, [[] for _ in range(2 + n_p + n_s)]

    def edge(u: int, v: int, room: int, cost: int) -> list:
        graph[u].append(fore := [v, room, cost, len(graph[v])])
        graph[v].append([u, 0, -cost, len(graph[u]) - 1])
        return fore

    uses = {}
    for p, (sources, size) in enumerate(patterns):
        for t in range(tiers):
            edge(0, 1 + p, size, t)
        for s in sources:
            uses[p, s] = edge(1 + p, 1 + n_p + s, tiers * size, 0)
    for s, q in enumerate(quotas):
        edge(1 + n_p + s, sink, q, 0)
    potential = [0] * (sink + 1)
    while True:
        cost, via, heap = [None] * (sink + 1), [None] * (sink + 1), [(0, 0)]
        cost[0] = 0
        while heap:
            d, u = heapq.heappop(heap)
            if d > cost[u]:
                continue
            for k, (v, room, c, _) in enumerate(graph[u]):
                if room > 0 and (cost[v] is None or d + c + potential[u] - potential[v] < cost[v]):
                    cost[v] = d + c + potential[u] - potential[v]
                    via[v] = (u, k)
                    heapq.heappush(heap, (cost[v], v))
        if cost[sink] is None:
            return {k: tiers * patterns[k[0]][1] - e[1] for k, e in uses.items()}
        for v, c in enumerate(cost):
            potential[v] += c if c is not None else cost[sink]
        room, v = None, sink
        while v:
            u, k = via[v]
            room = graph[u][k][1] if room is None else min(room, graph[u][k][1])
            v = u
        v = sink
        while v:
            u, k = via[v]
            graph[u][k][1] -= room
            graph[v][graph[u][k][3]][1] += room
            v = u


def filling(missing: int, sizes: list[tuple[int, int, int | None]]) -> list[int]:
    """Of (size, hash, doc_id): the documents that come near to what is missing: the largest first as long as they fit, or
    one alone."""
    left, taken = missing, []
    for size, _, doc in sorted(set(sizes), key=lambda x: (-x[0], *x[1:])):
        if size <= left and doc is not None:
            left -= size
            taken.append(doc)
    alone = min(((abs(missing - size), h, doc) for size, h, doc in sizes if doc is not None), default=None)
    return [alone[2]] if alone and alone[0] < left else taken


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = A.buffers(batch.column(0))
        _, _, words = A.word_spans(data, at)
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(words)), *batch.columns[1:]], names=["size", *batch.schema.names[1:]])
        A.trim()


def _hash(seed: int) -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed))


def mixture(docs: DataFrame, members: Column, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(rows, plan). members: array of the names of a document's sources.

    rows: doc_id, pattern, size; plan: pattern, source, source_size, target, times, cut, extra - a document of the pattern is
    read `times` times for that source, once more if its hash is at most cut or it is an extra one. The plan has a row for each pair of a
    pattern and a source, and sizes of patterns come to the driver; their number doesn't follow the documents.
    """
    spark = docs.sparkSession
    tune(spark)
    key = F.to_json(F.array_sort(F.array_distinct(F.transform(members, lambda x: F.struct(x.isNull().alias("none"), x.alias("name"))))))
    own = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), key.alias("pattern"))
    rows = written(own.mapInArrow(_sizes, "size long, doc_id long, pattern string"), "mix-sizes")
    if (n := rows.select("pattern").distinct().count()) > PATTERNS:
        raise ValueError(f"{n} patterns of sources are more than the flow takes ({PATTERNS}): group the sources first")
    grouped = rows.groupBy("pattern").agg(F.sum("size").alias("size")).withColumn("sources", F.from_json("pattern", "array<struct<none:boolean,name:string>>")).collect()
    found = sorted(((tuple((x["none"], x["name"]) for x in g["sources"]), g["size"], g["pattern"]) for g in grouped), key=lambda x: repr(x[0]))
    names = sorted({s for x in found for s in x[0]}, key=lambda s: (s[0], (s[1] or "").encode("utf-32-be")))
    number = {s: i for i, s in enumerate(names)}
    sizes = [sum(x[1] for x in found if s in x[0]) for s in names]
    # Each document counts once in the total, however many sources it belongs to.
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], most)
    if (both := sum(aims)) > 0 and any(len(x[0]) > 1 for x in found):
        aims = [a * sum(x[1] for x in found) / both for a in aims]
    given = min_cost_flow([(tuple(number[s] for s in x[0]), x[1]) for x in found], [round(a) for a in aims], most)
    plan = []
    for (p, s), amount in given.items():
        times, rest = divmod(amount, found[p][1]) if found[p][1] else (0, 0)
        plan.append((found[p][2], names[s][1], sizes[s], aims[s], times, rest))
    schema = "pattern string, source string, source_size long, target double, times long, rest long"
    plan = spark.createDataFrame(plan, schema)
    # Where the running sum over hashes passes the rest: first the bucket, from a histogram, then the place in the bucket.
    h = _hash(seed)
    bucket = F.shiftright(h, 52)
    sums = rows.groupBy("pattern", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    running = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket")))
    wanted = plan.select("pattern", "source", "rest")
    edge = running.join(F.broadcast(wanted), "pattern").where("upto > rest AND upto - words <= rest")
    edge = edge.groupBy("pattern", "source").agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("more")), "bucket").alias("e")).select("pattern", "source", "e.*")
    inside = rows.withColumn("h", h).withColumn("bucket", bucket).join(F.broadcast(edge), ["pattern", "bucket"])
    order = Window.partitionBy("pattern", "source").orderBy("h", "doc_id")
    # The cut is the last place up to which the sum stays within the rest; what is then missing, further documents fill.
    inside = inside.withColumn("sum", F.sum("size").over(order)).where("sum <= more").groupBy("pattern", "source").agg(F.max("h").alias("last"), F.max("sum").alias("got"))
    cuts = edge.join(inside, ["pattern", "source"], "left").select("pattern", "source", F.coalesce("last", F.shiftleft("bucket", 52)).alias("cut"), (F.col("more") - F.coalesce("got", F.lit(0))).alias("missing"))
    cuts = spark.createDataFrame(cuts.collect(), "pattern string, source string, cut long, missing long")
    # Beyond the cut: some documents, in the hash's order, that fit what is missing, and the one whose size is nearest to it.
    beyond = rows.join(F.broadcast(cuts), "pattern").where((h > F.col("cut")) & (F.col("size") > 0)).select("pattern", "source", "missing", "size", h.alias("h"), "doc_id")
    place = F.row_number().over(Window.partitionBy("pattern", "source").orderBy("h", "doc_id"))
    fit = beyond.where("size <= missing").withColumn("place", place).where(F.col("place") <= FILL)
    near = beyond.groupBy("pattern", "source").agg(F.min_by(F.struct("missing", "size", "h", "doc_id"), F.struct(F.abs(F.col("missing") - F.col("size")), "h", "doc_id")).alias("x")).select("pattern", "source", "x.*")
    some: dict[tuple, list] = {}
    for r in [*fit.select(*near.columns).collect(), *near.collect()]:  # FILL + 1 rows of each row of the plan at most
        some.setdefault((r["pattern"], r["source"]), [r["missing"]]).append((r["size"], r["h"], r["doc_id"]))
    extra = [(*k, filling(x[0], x[1:])) for k, x in some.items()]
    extra = spark.createDataFrame(extra, "pattern string, source string, extra array<long>")

    def by(own: DataFrame, more: DataFrame, *cols: str) -> DataFrame:
        same = (own["pattern"] == more["pattern"]) & own["source"].eqNullSafe(more["source"])
        return own.join(F.broadcast(more), same, "left").select(own["*"], *[more[c] for c in cols])

    plan = by(by(plan, cuts, "cut"), extra, "extra").withColumn("cut", F.when(F.col("rest") > 0, F.col("cut")).otherwise(F.lit(-(1 << 63))))
    return rows, spark.createDataFrame(plan.collect(), schema + ", cut long, extra array<long>")


def _times(seed: int) -> Column:
    """How often a document is read, from the plan's row beside it."""
    more = (_hash(seed) <= F.coalesce("__cut", F.lit((1 << 63) - 1))) | F.coalesce(F.array_contains("__extra", F.col("doc_id").cast("long")), F.lit(False))
    return F.col("__times") + F.when(more, 1).otherwise(0)


def _beside(plan: DataFrame) -> DataFrame:
    """The plan under names that no document has."""
    return F.broadcast(plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns]))


def mixed(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken for documents that belong to the one source in their column source.

    Sources by code point, null last, weigh 1, 2, 3, repeating. taken: the words that the mix takes from the document,
    repeats counted, 3 times its size at most. A null text has no words, its document nothing to take. Repeated rows
    with one doc_id are taken together. An empty table gives no rows; other columns are ignored.
    """
    rows, plan = mixture(docs, F.array(F.col("source").cast("string")), seed=seed)
    out = rows.join(_beside(plan), F.col("pattern") == F.col("__pattern"))
    taken = (F.col("size") * _times(seed)).cast("long").alias("taken")
    return out.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken, F.col("__source").alias("source"))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """docs as the mix reads them: a row is left out, or there once, twice or three times.

    A null or empty text has no words and is never read. A null source is a source. Rows that repeat a doc_id are read
    equally often. An empty table gives no rows; columns of any name stay.
    """
    names = docs.columns
    _, plan = mixture(docs, F.array(F.col("source").cast("string")), seed=seed)
    out = docs.join(_beside(plan), docs["source"].cast("string").eqNullSafe(F.col("__source")))
    out = out.withColumn("__n", _times(seed).cast("int")).where("__n > 0")
    return out.withColumn("__again", F.explode(F.sequence(F.lit(1), "__n"))).select(*names)
