"""Merkle manifest of a table with proofs by coordinates.

Leaves are numbered in their group; nodes of every level are written as rows (group, level, place, digest). What a leaf has
to prove follows from its place and the group's size alone: at each level the others of its run. These coordinates are
exploded, met with the node table, put in order and folded. From level 1 upwards the leaves of a run need the same
siblings, so coordinates are exploded once for each run; the siblings of level 0 are the run itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import BROADCAST_BYTES, attach, checked_broadcast, tune, written

#: Nodes under a parent: 2 ** BITS.
BITS = 4
FAN = 1 << BITS
#: Columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a range when rows are numbered, and ranges at most.
RANGE, RANGES = 100_000, 20_000
#: A row of the node table in a broadcast: group, level, place and a digest of 64 digits.
NODE_BYTES = 160
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value that can't be taken for two others side by side: '-' for null, else its UTF-8 bytes' number, ':' and itself."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _parent(place: Column) -> Column:
    return F.shiftright(place, BITS)


def _size(n: Column, level: int | Column) -> Column:
    """Nodes at a level of a group of n leaves."""
    if isinstance(level, int):
        return F.shiftright(n + F.lit((1 << BITS * level) - 1), BITS * level)
    return F.call_function("shiftright", n + F.call_function("shiftleft", F.lit(1).cast("long"), level * BITS) - 1, level * BITS)


def numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """df with rank (from 0, in the order of the columns) and its number of rows: sorted ranges of which only the sizes meet."""
    rows = written(df, name)
    total = rows.count()
    ranges = max(1, min(RANGES, total // RANGE))
    at = written(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), f"{name}-order")
    before, starts = 0, []
    for r in at.groupBy(F.shiftright("__at", 33).alias("range")).count().orderBy("range").collect():
        starts.append((r[0], before))
        before += r[1]
    bases = checked_broadcast(df.sparkSession.createDataFrame(starts, "__range long, __base long"), 16)
    ranked = at.withColumn("__range", F.shiftright("__at", 33)).join(bases, "__range")
    return ranked.withColumn("rank", F.col("__base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__range", "__base"), total


@dataclass
class Tree:
    """Groups of digests as runs (g, r, n, members: place, digest, payload), the nodes above them, and a root for each group."""

    runs: DataFrame
    nodes: DataFrame
    counts: dict[int, int]
    roots: DataFrame


def tree(items: DataFrame, name: str) -> Tree:
    """The trees over items: g (group), i (place in it, from 0 without gaps), n (the group's size), d (digest), p (payload).

    A level is one grouping by the parent's place, whose groups have FAN rows at most; there are about log(n) / log(FAN).
    """
    runs = items.groupBy("g", "n", _parent(F.col("i")).alias("r")).agg(F.array_sort(F.collect_list(F.struct("i", "d", "p"))).alias("members"))
    runs = written(runs, f"{name}-runs")
    joined = lambda rows: F.sha2(F.array_join(F.transform(rows, lambda x: x["d"]), ""), 256)
    level, l, parts, counts = runs.where("n > 1").select("g", "n", F.col("r").alias("i"), joined(F.col("members")).alias("d")), 1, [], {}
    roots = [runs.where("n = 1").select("g", "n", F.col("members")[0]["d"].alias("root"))]
    while True:
        level = written(level, f"{name}-nodes")
        size = _size(F.col("n"), l)
        found = level.groupBy((size == 1).alias("done")).count().collect()
        counts[l] = sum(r[1] for r in found)
        roots.append(level.where(size == 1).select("g", "n", F.col("d").alias("root")))
        inner = level.where(size > 1)
        parts.append(inner.select("g", F.lit(l).alias("level"), "i", "d"))
        if all(r[0] for r in found):
            break
        level = inner.groupBy("g", "n", _parent(F.col("i")).alias("i")).agg(joined(F.array_sort(F.collect_list(F.struct("i", "d")))).alias("d"))
        l += 1
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return Tree(runs, union(parts), counts, union(roots))


def lookups(found: Tree, name: str) -> DataFrame:
    """For each run with siblings above it: g, r and path, the siblings' digests left and right of its ancestor, by level.

    Coordinates of nodes that all runs need (upper levels, counted small) meet a broadcast; below, a node is needed by
    few of many runs, so the shuffle join has no hot key.
    """
    top = max(found.counts)
    n, r = F.col("n"), F.col("r")
    levels = F.filter(F.sequence(F.lit(1), F.lit(top)), lambda l: _size(n, l) > 1)
    ask = found.runs.select("g", "r", "n", F.explode(levels).alias("level"))
    ask = ask.withColumn("own", F.call_function("shiftright", r, (F.col("level") - 1) * BITS))
    first = F.shiftleft(_parent(F.col("own")), BITS)
    last = F.least(first + FAN, _size(n, F.col("level"))) - 1
    ask = ask.select("g", "r", "level", "own", F.explode(F.sequence(first, last)).alias("i"))
    # The lowest level from which on all nodes fit a broadcast.
    cut = min((l for l in range(1, top + 2) if sum(c for k, c in found.counts.items() if k >= l) * NODE_BYTES <= BROADCAST_BYTES), default=top + 1)
    key = ["g", "level", "i"]
    met = ask.where(F.col("level") >= cut).join(F.broadcast(found.nodes.where(F.col("level") >= cut)), key)
    if cut > 1:
        met = met.unionByName(ask.where(F.col("level") < cut).join(found.nodes.where(F.col("level") < cut), key))
    side = lambda test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("i", "d")))), lambda x: x["d"]), "")
    steps = met.groupBy("g", "r", "level").agg(side(F.col("i") < F.col("own")).alias("left"), side(F.col("i") > F.col("own")).alias("right"))
    path = F.transform(F.array_sort(F.collect_list(F.struct("level", "left", "right"))), lambda x: F.struct(x["left"].alias("left"), x["right"].alias("right")))
    return written(steps.groupBy("g", "r").agg(path.alias("path")), f"{name}-paths")


def proofs(found: Tree, name: str) -> DataFrame:
    """Every item with its path to its group's root: g, n, i, d, p, path (array of left, right; empty for a lone item)."""
    both = found.runs.join(lookups(found, name), ["g", "r"], "left")
    rows = both.select("g", "n", "members", "path", F.explode("members").alias("m"))
    side = lambda test: F.array_join(F.transform(F.filter("members", test), lambda x: x["d"]), "")
    own = F.struct(side(lambda x: x["i"] < F.col("m.i")).alias("left"), side(lambda x: x["i"] > F.col("m.i")).alias("right"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    path = F.when(F.col("n") > 1, F.concat(F.array(own), F.coalesce("path", none))).otherwise(none)
    return rows.select("g", "n", "m.*", path.alias("path"))


def folded(leaf: Column, *paths: Column) -> Column:
    """The root that a leaf and the siblings of its paths give."""
    out = leaf
    for p in paths:
        out = F.aggregate(p, out, lambda acc, x: digest(x["left"], acc, x["right"]))
    return out


def siblings(*paths: Column) -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.concat(*[F.array_join(F.transform(p, lambda x: F.concat(x["left"], x["right"])), "") for p in paths])


def leaf_digest(docs: DataFrame, text: Column | None = None) -> Column:
    """A row's leaf; with text, that of the row with this text. Columns that aren't there are null."""
    have = {f: F.col(f) if f in docs.columns else F.lit(None) for f in FIELDS}
    return digest(*[field(text if f == "text" and text is not None else c) for f, c in have.items()])


def manifest_proofs(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A row for each document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source.

    Sources are trees of their documents by doc_id; their roots, by source (null first), are the leaves of one tree.
    tampered is a text to be put in place of the document's before its root is recomputed; null tampers with nothing.
    Documents without a doc_id come first in their source; equal doc_ids go by leaf, and equal rows have one leaf.
    Empty and null values differ. Other columns are ignored; an empty table gives no rows.
    """
    tune(docs.sparkSession)
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    doc_id = F.col("doc_id").cast("long")
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf_digest(docs, tampered))
    # Null comes before any text.
    rows = docs.select(F.concat(F.when(source.isNull(), "0").otherwise("1"), F.coalesce(source, F.lit(""))).alias("g"), doc_id.alias("doc_id"), leaf_digest(docs).alias("d"), changed.alias("changed"))
    ranked, total = numbered(rows, ["g", "doc_id", "d"], "merkle")
    groups = written(ranked.groupBy("g").agg(F.min("rank").alias("first"), F.count("*").alias("n")), "merkle-sources")
    longest = groups.agg(F.max(F.octet_length("g"))).first()[0] or 0
    placed = attach(ranked, groups, "g", "n", total, 64 + longest)
    items = placed.select("g", (F.col("rank") - F.col("first")).alias("i"), "n", "d", F.struct("doc_id", "changed").alias("p"))
    own = tree(items, "merkle")

    subroots, n = numbered(own.roots.select("g", F.col("n").alias("size"), F.col("root").alias("d")), ["g"], "merkle-subroots")
    over = tree(subroots.select(F.lit("").alias("g"), F.col("rank").alias("i"), F.lit(n).cast("long").alias("n"), "d", F.struct(F.col("g").alias("source"), "size").alias("p")), "merkle-top")
    root = (over.roots.first() or {"root": None})["root"]
    upper = written(proofs(over, "merkle-top").select(F.col("p.source").alias("g"), F.col("p.size").alias("size"), F.col("d").alias("subroot"), F.col("path").alias("upper")), "merkle-upper")
    wide = 64 * (FAN - 1) * (max(over.counts) + 1) + 256 + longest

    out = attach(proofs(own, "merkle"), upper, "g", "size", total, wide)
    path, upper_path = F.col("path"), F.col("upper")
    out = out.select(
        F.col("p.doc_id").alias("doc_id"), F.col("d").alias("leaf"), "subroot", F.lit(root).alias("root"), F.sha2(siblings(path, upper_path), 256).alias("proof_sha256"),
        folded(F.coalesce("p.changed", "d"), path, upper_path).alias("folded_root"), F.when(F.substring("g", 1, 1) == "1", F.expr("substring(g, 2)")).alias("source"),
    )
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source")


def lower_cased(docs: DataFrame) -> Column:
    """The contract's tampering: where 5 divides the CRC-32 of the decimal doc_id, the text with A-Z lower-cased, else null."""
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(F.col("text").cast("string"), UPPER, LOWER))
