"""Reversible line deduplication: exact reference counts of lines, with a cuckoo filter in front of each shard.

A line's key is a 128-bit hash of the line, stripped of ASCII white space at both ends and with A-Z lower-cased. The
state is a table (shard, k1, k2, refs): in how many documents a key occurs. Inserting or deleting documents adds or
subtracts their keys; keys that reach zero go, also from the shard's filter, so a deletion undoes an insertion exactly.
Filters answer "surely not frequent" for most lines; what passes is verified in the exact counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import BROADCAST_BYTES, tune, written

#: Line references of a shard, on average; the number of shards follows the input.
SHARD = 1 << 18
#: Distinct keys that a task holds before it hands its partial counts on.
HELD = 1 << 18
#: Keys that every task is given, at most: those that are 1 in so many of all references.
HOT = 8192


class CuckooFilter:
    """Buckets of four 16-bit tags; a key's two buckets are i and i xor hash(tag). Supports deletion of inserted keys."""

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(2, capacity / (0.84 * self.SLOTS))))))
        self.table = np.zeros((self.buckets, self.SLOTS), np.uint16)
        self.stash: list[tuple[int, int]] = []  # (bucket, tag) that found no place

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both buckets and the tag (1..65535) of unsigned 64-bit keys."""
        mask = np.uint64(self.buckets - 1)
        tag = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint64)
        one = keys & mask
        return one.astype(np.int64), ((one ^ (tag * np.uint64(0x5BD1E995))) & mask).astype(np.int64), tag.astype(np.uint16)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & (self.buckets - 1)

    def _put(self, bucket: int, tag: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = tag
        return bool(len(free))

    @property
    def room(self) -> int:
        """Keys that the filter takes without getting too full."""
        return self.buckets * self.SLOTS * 9 // 10

    def insert(self, keys: np.ndarray) -> None:
        for one, two, tag in zip(*(x.tolist() for x in self.places(keys))):
            if self._put(one, tag) or self._put(two, tag):
                continue
            at = two
            for kick in range(self.KICKS):
                slot = (tag + kick) % self.SLOTS
                tag, self.table[at, slot] = int(self.table[at, slot]), tag
                at = self._other(at, tag)
                if self._put(at, tag):
                    break
            else:
                self.stash.append((at, tag))

    def delete(self, keys: np.ndarray) -> None:
        for one, two, tag in zip(*(x.tolist() for x in self.places(keys))):
            for at in (one, two):
                hit = np.flatnonzero(self.table[at] == tag)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break
            else:
                for at in (one, two):
                    if (at, tag) in self.stash:
                        self.stash.remove((at, tag))
                        break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        one, two, tag = self.places(keys)
        found = (self.table[one] == tag[:, None]).any(1) | (self.table[two] == tag[:, None]).any(1)
        if self.stash:
            kept = np.array([at << 16 | t for at, t in self.stash], np.int64)
            found |= np.isin(one << 16 | tag, kept) | np.isin(two << 16 | tag, kept)
        return found

    def to_bytes(self) -> bytes:
        stash = np.array(self.stash, np.int64).reshape(-1, 2)
        return np.array([self.buckets, len(stash)], np.int64).tobytes() + stash.tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        out = cls(1)
        out.buckets, n = (int(x) for x in np.frombuffer(blob, np.int64, 2))
        out.stash = [tuple(x) for x in np.frombuffer(blob, np.int64, 2 * n, 16).reshape(-1, 2).tolist()]
        out.table = np.frombuffer(blob, np.uint16, offset=16 + 16 * n).reshape(out.buckets, cls.SLOTS).copy()
        return out


def _lines(batch: pa.RecordBatch, at: int) -> Iterator[tuple[bytes, list[bytes]]]:
    """Each text and the digests of its lines' keys (None for keys of no character)."""
    data, cuts = A.buffers(batch.column(at))
    raw = data.tobytes()
    low, cuts, x = raw.translate(A.LOWER), cuts.tolist(), xxhash.xxh3_128_digest
    for a, b in zip(cuts, cuts[1:]):
        keys = [k.strip(A.SPACE_BYTES) for k in low[a:b].split(b"\n")]
        yield raw[a:b], [x(k) if k else None for k in keys]


def _pairs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64).view(np.int64)
    return both[:, 0], both[:, 1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, int] = {}

    def out():
        k1, k2 = _pairs(list(seen))
        return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(list(seen.values()), pa.int64())], names=["k1", "k2", "n"])

    for batch in batches:
        for _, keys in _lines(batch, 0):
            for k in set(keys):
                if k:
                    seen[k] = seen.get(k, 0) + 1
        if len(seen) > HELD:
            yield out()
            seen.clear()
    if seen:
        yield out()


def reference_counts(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, k1, k2, refs): the documents that each line key occurs in; copies in a task are added up before the shuffle."""
    part = docs.select(F.col("text").cast("string")).mapInArrow(_count, "k1 long, k2 long, n long")
    return part.groupBy("k1", "k2").agg(F.sum("n").alias("refs")).select(F.pmod("k1", F.lit(shards)).alias("shard"), "k1", "k2", "refs")


def changed(counts: DataFrame, delta: DataFrame, sign: int) -> DataFrame:
    """Counts after inserting (sign 1) or deleting (sign -1) the documents whose counts are delta."""
    both = counts.union(delta.withColumn("refs", F.col("refs") * sign))
    return both.groupBy("shard", "k1", "k2").agg(F.sum("refs").alias("refs")).where("refs > 0")


FILTER = "shard long, room long, filter binary"


def filters(counts: DataFrame) -> DataFrame:
    """(shard, room, filter): a cuckoo filter of the keys of each shard, and how many keys it takes."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        own = CuckooFilter(len(rows))
        own.insert(np.sort(rows["k2"].to_numpy().view(np.uint64)))
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "room": [own.room], "filter": [own.to_bytes()]})

    return counts.groupBy("shard").applyInPandas(build, FILTER)


def updated_filters(old: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Filters brought from the keys of one table of counts to those of another by insertions and deletions alone.

    Shards without a filter, and those whose filter has no room for the keys of after, are built anew from after.
    """
    sizes = after.groupBy("shard").agg(F.count("*").alias("n"))
    full = written(sizes.join(old.select("shard", "room"), "shard", "left").where("room IS NULL OR n > room").select("shard"), "line-full")
    anew = filters(after.join(full, "shard", "left_semi"))
    gone = before.join(after, ["shard", "k1", "k2"], "left_anti").select("shard", "k2", F.lit(-1).alias("sign"))
    come = after.join(before, ["shard", "k1", "k2"], "left_anti").select("shard", "k2", F.lit(1).alias("sign"))

    def change(key, filter_rows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        own = CuckooFilter.from_bytes(filter_rows["filter"].iloc[0])
        own.delete(rows["k2"].to_numpy()[rows["sign"] == -1].view(np.uint64))
        own.insert(rows["k2"].to_numpy()[rows["sign"] == 1].view(np.uint64))
        return pd.DataFrame({"shard": [key[0]], "room": [own.room], "filter": [own.to_bytes()]})

    stay = old.join(full, "shard", "left_anti")
    moved = gone.union(come).join(stay.select("shard"), "shard", "left_semi")
    return stay.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(change, FILTER).union(anew)


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by shard, each shard's filter first: the occurrences that their filter lets through."""
    shard, own = None, None
    for batch in batches:
        shards, blobs = batch.column(0).to_numpy(), batch.column(1)
        k2, keep = batch.column(4).fill_null(0).to_numpy().view(np.uint64), np.zeros(len(shards), bool)
        with_filter = blobs.is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.append(True, np.diff(shards) != 0)) if len(shards) else []
        for i, j in zip(cuts, [*cuts[1:], len(shards)]):
            if shards[i] != shard:
                shard, own = shards[i], None
            if with_filter[i]:
                own = CuckooFilter.from_bytes(blobs[int(i)].as_py())
            if own is not None:
                keep[i:j] = own.contains(k2[i:j])
        keep &= ~with_filter
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in (2, 3, 4)], names=["doc_id", "k1", "k2"])


def _dropped(docs: DataFrame, frequent: DataFrame, front: DataFrame, refs: int, shards: int) -> DataFrame:
    """(doc_id, k1, k2): the frequent keys of each document. Occurrences meet their shard's filter in a stream, of which
    nothing but the filter is held; what passes is looked up in the exact counts."""
    # Keys of 1 in HOT references or more are HOT at most; every task gets them, so that no shard is hot.
    hot = frequent.where(F.col("refs") * HOT >= refs).select("k1", "k2").toArrow()
    packed = np.stack([hot.column(i).to_numpy() for i in (0, 1)], 1).view(np.uint64).astype(">u8").tobytes()
    hot_keys = frozenset(packed[i : i + 16] for i in range(0, len(packed), 16))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at, hits, hit_at = [], [], [], []
            for i, (_, own) in enumerate(_lines(batch, 1)):
                own = {k for k in own if k}
                hits += (found := own & hot_keys)
                hit_at += [i] * len(found)
                keys += (rest := own - hot_keys)
                at += [i] * len(rest)
            for keys, at, hot_one in ((keys, at, False), (hits, hit_at, True)):
                if keys:
                    k1, k2 = _pairs(keys)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(k1), pa.array(k2), pa.array([hot_one] * len(at))], names=["doc_id", "k1", "k2", "hot"])

    found = docs.mapInArrow(occurrences, "doc_id long, k1 long, k2 long, hot boolean")
    rest = found.where("NOT hot").select(F.pmod("k1", F.lit(shards)).alias("shard"), F.lit(None).cast("binary").alias("filter"), "doc_id", "k1", "k2")
    blank = [F.lit(None).cast("long").alias(c) for c in ("doc_id", "k1", "k2")]
    both = front.select("shard", "filter", *blank).union(rest).repartition("shard").sortWithinPartitions("shard", F.col("filter").isNull())
    maybe = both.mapInArrow(_passed, "doc_id long, k1 long, k2 long")
    sure = maybe.join(frequent.where(F.col("refs") * HOT < refs).select("k1", "k2"), ["k1", "k2"], "left_semi")
    return found.where("hot").select("doc_id", "k1", "k2").union(sure.select("doc_id", "k1", "k2"))


def line_dedup(docs: DataFrame, min_docs: int = 10, with_text: bool = False) -> DataFrame:
    """Drops lines whose key of at least one character occurs in min_docs documents or more, in every document.

    Returns doc_id, n_lines, n_dropped, kept_sha256 (and kept_text). A null or empty text is one empty line, which
    stays, as do all lines without a character. A line repeated in one document counts once for it and goes as a
    whole. Rows that repeat a doc_id are told apart by their text only in the counts: each counts as a document. An
    empty table gives no rows; other columns are ignored.
    """
    tune(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(reference_counts(own, 1 << 30).drop("shard"), "line-refs")
    refs = counts.agg(F.sum("refs")).first()[0] or 0
    shards = max(1, -(-refs // SHARD))
    frequent = written(counts.where(F.col("refs") >= min_docs).withColumn("shard", F.pmod("k1", F.lit(shards))), "line-frequent")
    front = written(filters(frequent.where(F.col("refs") * HOT < refs)), "line-filters")
    hits = written(_dropped(own, frequent, front, refs, shards), "line-hits")
    lists = hits.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("hits"))
    lists = F.broadcast(lists) if hits.count() * 32 <= BROADCAST_BYTES else lists
    lists = lists.withColumnRenamed("doc_id", "__id")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, digests, kept_texts = [], [], [], []
            for (text, keys), gone in zip(_lines(batch, 1), batch.column(2).to_pylist()):
                n_lines.append(len(keys))
                n_gone = 0
                if gone:
                    bad = {np.array([x["k1"], x["k2"]], np.int64).view(np.uint64).astype(">u8").tobytes() for x in gone}
                    stays = [k not in bad for k in keys]
                    n_gone = len(keys) - sum(stays)
                    text = b"\n".join(line for line, ok in zip(text.split(b"\n"), stays) if ok)
                n_dropped.append(n_gone)
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept_texts.append(text.decode())
            cols = [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept_texts, pa.string())] * with_text, names=["doc_id", "n_lines", "n_dropped", "kept_sha256"] + ["kept_text"] * with_text)

    both = own.join(lists, F.col("doc_id").eqNullSafe(F.col("__id")), "left").select("doc_id", "text", "hits")
    return both.mapInArrow(rewrite, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * with_text)
