"""Exact deduplication with counting quotient filters.

1. One pass over the texts writes (doc_id, 64-bit fingerprint, SHA-256) of the normalised text.
2. Each partition builds a counting quotient filter for each block of fingerprints: the upper bits (quotient) name a
   home slot, the lower bits (remainder) are stored there or in the next free slot; occupied and run-end bits make the
   pairs recoverable, and each slot has a counter. A copy met a million times in a partition is one slot.
3. Filters of a block are merged without loss: their pairs come out sorted, so remainders are merged and counters added.
4. Only documents whose fingerprint counts more than one are read again, and are grouped by their bytes.
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
from prosemill.llm.common import attach, checked_broadcast, only_ids, tune, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fingerprints of a block, on average; the number of blocks follows the input.
BLOCK = 1 << 18


class CountingQuotientFilter:
    """Pairs (quotient, remainder) with counters in linear-probing slots; quotient has qbits, remainder rbits."""

    def __init__(self, qbits: int, rbits: int, occupied: np.ndarray, runend: np.ndarray, used: np.ndarray, remainder: np.ndarray, count: np.ndarray):
        self.qbits, self.rbits = qbits, rbits
        self.occupied, self.runend, self.used, self.remainder, self.count = occupied, runend, used, remainder, count

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """keys: sorted distinct unsigned integers of so many bits. The load stays below 3/4."""
        qbits = max(1, min(bits, int(np.ceil(np.log2(max(2, len(keys) / 0.75))))))
        rbits = bits - qbits
        q = (keys >> np.uint64(rbits)).astype(np.int64)
        i = np.arange(len(keys))
        slot = np.maximum.accumulate(q - i) + i if len(keys) else i
        size = max(1 << qbits, int(slot[-1]) + 1 if len(keys) else 0)
        occupied, runend, used = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
        remainder, count = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        occupied[q] = True
        used[slot] = True
        if len(keys):
            runend[slot[np.append(q[1:] != q[:-1], True)]] = True
        remainder[slot] = keys & np.uint64((1 << rbits) - 1)
        count[slot] = counts
        return cls(qbits, rbits, occupied, runend, used, remainder, count)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The keys, sorted, and their counts: the k-th occupied quotient owns the k-th run."""
        slot = np.flatnonzero(self.used)
        run = np.cumsum(self.runend[slot]) - self.runend[slot]
        q = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (q << np.uint64(self.rbits)) | self.remainder[slot], self.count[slot]

    def count_of(self, key: int) -> int:
        q, r = key >> self.rbits, key & ((1 << self.rbits) - 1)
        if not self.occupied[q]:
            return 0
        end = int(np.flatnonzero(self.runend)[int(self.occupied[: q + 1].sum()) - 1])
        while end >= q and self.used[end]:
            if int(self.remainder[end]) == r:
                return int(self.count[end])
            end -= 1
            if end < 0 or self.runend[end]:
                break
        return 0

    def to_bytes(self) -> bytes:
        """Bit vectors, then remainders and counters of the used slots in as few bytes as hold them."""
        slot = np.flatnonzero(self.used)
        wide = next(w for w in (1, 2, 4, 8) if self.count.max(initial=0) < 1 << (8 * w - 1))
        head = np.array([self.qbits, self.rbits, len(self.used), len(slot), wide], np.int64)
        bits = [np.packbits(x).tobytes() for x in (self.occupied, self.runend, self.used)]
        return head.tobytes() + b"".join(bits) + self.remainder[slot].tobytes() + self.count[slot].astype(f"i{wide}").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CountingQuotientFilter:
        qbits, rbits, size, n, wide = (int(x) for x in np.frombuffer(blob, np.int64, 5))
        at, step = 40, -(-size // 8)
        bits = []
        for _ in range(3):
            bits.append(np.unpackbits(np.frombuffer(blob, np.uint8, step, at), count=size).astype(bool))
            at += step
        slot = np.flatnonzero(bits[2])
        remainder, count = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        remainder[slot] = np.frombuffer(blob, np.uint64, n, at)
        count[slot] = np.frombuffer(blob, f"i{wide}", n, at + 8 * n)
        return cls(qbits, rbits, *bits, remainder, count)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter], bits: int) -> CountingQuotientFilter:
        """Sorted remainders of all filters side by side; equal ones add their counters. Nothing is lost."""
        parts = [f.items() for f in filters]
        keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.uint64)
        counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
        return cls.build(keys[first], np.add.reduceat(counts, np.flatnonzero(first)) if len(keys) else counts, bits)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("text_sha256", pa.string())])
    for batch in batches:
        data, at = A.buffers(batch.column(1))
        view = memoryview(data.tobytes().translate(A.LOWER))
        cuts = at.tolist()
        texts = [view[a:b] for a, b in zip(cuts, cuts[1:])]
        fp = np.array([xxhash.xxh3_64_intdigest(x) for x in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), pa.array([hashlib.sha256(x).hexdigest() for x in texts])], schema=schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fp, text_sha256 of the text with A-Z lower-cased; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_digest, "doc_id long, fp long, text_sha256 string")


def repeated_fingerprints(fps: DataFrame, n: int) -> DataFrame:
    """(fp, n) of fingerprints that occur more than once, by merged counting quotient filters."""
    cut = max(0, int(np.ceil(np.log2(max(1, n / BLOCK)))))
    bits = 64 - cut

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [b.column(0).to_numpy().view(np.uint64) for b in batches]
        keys, counts = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), None)
        block = (keys >> np.uint64(bits)).astype(np.int64) if cut else np.zeros(len(keys), np.int64)
        rows = []
        for b in np.unique(block):
            own = block == b
            part = keys[own] & np.uint64((1 << bits) - 1) if cut else keys[own]
            rows.append((int(b), CountingQuotientFilter.build(part, counts[own], bits).to_bytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "blob"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        all_of = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x) for x in rows["blob"]], bits)
        keys, counts = all_of.items()
        keys = keys | np.uint64(int(rows["block"].iloc[0]) << bits) if cut else keys
        return pd.DataFrame({"fp": keys[counts > 1].view(np.int64), "n": counts[counts > 1]})

    return fps.select("fp").mapInArrow(build, "block long, blob binary").groupBy("block").applyInPandas(merge, "fp long, n long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the largest doc_id of equal texts stays. A null text is
    empty, empty texts equal each other; a null doc_id never stays unless all of its group are null. Rows that repeat
    the largest doc_id all count as the row that stays. An empty table gives no rows; other columns are ignored.
    """
    tune(docs.sparkSession)
    own = written(digests(docs), "digests")
    n = own.count()
    again = written(repeated_fingerprints(own, n), "repeated").select("fp")
    suspects = own.join(checked_broadcast(again, 16), "fp", "left_semi").select("doc_id")
    some = only_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), suspects.distinct(), "left_semi")
    same = some.groupBy(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("norm")).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = written(same.select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size").where("group_size > 1"), "groups")
    out = attach(own, groups, "text_sha256", "group_size", n, 120)
    return out.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")) | F.col("group_size").isNull(), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the rows that exact_duplicates drops.

    A null text is empty; of equal texts the rows with the largest doc_id stay, all of them if the id repeats. An empty
    table gives no rows; columns of any name stay.
    """
    gone = written(exact_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "dropped")
    return only_ids(docs, gone, "left_anti")
