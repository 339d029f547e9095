"""Packing along a space-filling curve: documents whose vectors are near share sequences.

A document's tokens are hashed to a vector, which is projected to few dimensions; its cell's Hilbert key says where it stands.
Documents are sorted by key over ranges, the tokens of the ranges are summed, and so each document has a place in one long
row of tokens. Sequences are cuts of that row: they cross ranges, only the last one can be short, and that one falls into
lengths that are powers of two. No task waits for another, and no bin is held open.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import checked_broadcast, tune, written
from prosemill.llm.hilbert import hilbert_index

VOCABULARY = "word_bpe_49k.json"
#: Buckets of hashed vectors, dimensions they are projected to, levels of each (2 ** BITS).
BUCKETS, DIMENSIONS, BITS = 256, 6, 10
#: Tokens of a range when documents are sorted, and ranges at most.
RANGE, RANGES = 4_000_000, 20_000
#: Words in one call of the tokenizer.
CALL = 4096
#: The seed of the hashes and of the projection.
SEED = 13


#: Words of letters that neither normalisation nor another letter changes, and marks of one piece after them.
_PLAIN = "^([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)$"
#: Stands for the end of a piece; in no plain word.
_LAST = b"\x01"


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    own = [b for r in (range(33, 127), range(161, 173), range(174, 256)) for b in r]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Words:
    """Ids of white-space separated words: no token of this vocabulary holds ASCII white space, so a text's ids are its words' ids.

    Plain words are one piece of letters and one of marks. Where the vocabulary's ids are in the order of its merges, such
    pieces are merged by rank, all in one call, with the end of a piece as a byte of its own; this gives the same ids in less
    time. Other words go to the tokenizer as they are.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        import public_tokenizers as P
        import tiktoken
        from tokenizers import Tokenizer

        path = name if os.path.sep in name else P.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs, vocab, end, byte = [m.split() if isinstance(m, str) else m for m in model["merges"]], model["vocab"], model.get("end_of_word_suffix"), _byte_of()
        order = [vocab.get(a + b, -1) for a, b in pairs]
        self.pieces = None
        if end and order and order == sorted(order) and order[0] > 511:
            ranks = {bytes(byte[c] for c in t.removesuffix(end)) + _LAST * t.endswith(end): i for t, i in vocab.items() if i <= order[-1] and t not in (chr(257), chr(257) + end)}
            ranks[_LAST] = order[-1] + 1
            self.pieces = tiktoken.Encoding("pieces", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})
            self.last = np.zeros(order[-1] + 2, bool)
            self.last[[i for t, i in vocab.items() if i <= order[-1] and t.endswith(end)]] = True

    def _merged(self, letters: pa.Array, marks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, and how many each has."""
        both = pc.if_else(pc.equal(marks, ""), letters, pc.binary_join_element_wise(letters, marks, pa.scalar(_LAST.decode() + " ", letters.type)))
        ids = self.pieces.encode_to_numpy((_LAST.decode() + " ").join([*both.to_pylist(), ""]), disallowed_special=())
        ends = np.flatnonzero(self.last[ids]) + 1
        return ids, np.diff(ends[np.cumsum(1 + np.asarray(pc.not_equal(marks, ""))) - 1], prepend=0)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in any order; where each word's ids start there, and how many they are."""
        words = words.cast(pa.large_binary()).cast(pa.large_string())
        parts = pc.extract_regex(words, _PLAIN.replace("(", "(?P<a>", 1).replace(")(", ")(?P<b>")) if self.pieces else pa.nulls(len(words))
        plain = np.asarray(parts.is_valid())
        length, start, flat = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), []
        if plain.any():
            a, b = parts.drop_null().flatten()
            found, length[plain] = self._merged(pc.utf8_lower(a), b)
            flat.append(found.astype(np.uint32))
        rest = words.filter(pa.array(~plain)).to_pylist()
        for k in range(0, len(rest), CALL):
            flat += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(rest[k : k + CALL], add_special_tokens=False)]
        length[~plain] = [len(x) for x in flat[int(plain.any()) :]]
        order = np.argsort(~plain, kind="stable")
        start[order] = np.cumsum(length[order]) - length[order]
        return np.concatenate([*flat, np.zeros(0, np.uint32)]), start, length


@lru_cache(maxsize=2)
def vocabulary(name: str = VOCABULARY) -> Words:
    return Words(name)


def token_ids(data: np.ndarray, offsets: np.ndarray, name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts, and where each text's ids start (len+1); each distinct word of the batch is looked up once."""
    starts, ends, first = A.word_spans(data, offsets)
    codes, distinct = A.word_codes(data, starts, ends)
    flat, at, lengths = vocabulary(name).ids(distinct)
    own = lengths[codes]
    return flat[A.ragged(at[codes], own)], np.concatenate([[0], np.cumsum(own)])[first]


@lru_cache(maxsize=2)
def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS))


def projected(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Documents as points: signed counts of hashed ids, damped by a root, of unit length, projected. No ids give the origin."""
    docs = len(at) - 1
    h = A.spark_hash(np.arange(int(ids.max()) + 1 if len(ids) else 0), SEED).view(np.uint64)
    bucket, sign = (h % np.uint64(BUCKETS)).astype(np.int64), np.where(h >> np.uint64(63) > 0, 1.0, -1.0)
    doc = np.repeat(np.arange(docs), np.diff(at))
    v = np.bincount(doc * BUCKETS + bucket[ids], weights=sign[ids], minlength=docs * BUCKETS).reshape(docs, BUCKETS)
    v = np.sign(v) * np.sqrt(np.abs(v))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9) @ _projection()


def tokenised(docs: DataFrame, end: int = 1, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n (tokens with the end), ids (their bytes, two or four a token), crc of all ids, and the point (x0, x1, ...)."""
    kind = "<u2" if max(vocabulary(name).size, end + 1) <= 1 << 16 else "<u4"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = token_ids(*A.buffers(batch.column(1)), name)
            points = projected(ids, at)
            raw, tail, size = ids.astype(kind).tobytes(), np.array([end], kind).tobytes(), np.dtype(kind).itemsize
            whole = [raw[a * size : b * size] + tail for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            crc = pa.array([zlib.crc32(x) for x in whole], pa.int64())
            columns = [batch.column(0), pa.array(np.diff(at) + 1), pa.array(whole, pa.binary()), crc, *[pa.array(points[:, d]) for d in range(DIMENSIONS)]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "crc", *[f"x{d}" for d in range(DIMENSIONS)]])
            A.trim()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(cut, "doc_id long, n long, ids binary, crc long" + "".join(f", x{d} double" for d in range(DIMENSIONS)))


def with_curve(points: DataFrame) -> DataFrame:
    """Adds hilbert: the key of the point's cell. Each dimension is cut by a logistic curve about its mean over all rows, so
    that cells near the middle, where most points are, are as fine as those outside."""
    names = [f"x{d}" for d in range(DIMENSIONS)]
    s = points.agg(*[f(c).alias(f"{k}_{c}") for c in names for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean, scale = [s[f"m_{c}"] or 0.0 for c in names], [s[f"s_{c}"] or 1.0 for c in names]

    def curve(*xs: pd.Series) -> pd.Series:
        z = np.stack([(x.to_numpy() - m) / d for x, m, d in zip(xs, mean, scale)], 1)
        cells = np.minimum((1 << BITS) - 1, np.floor((1 << BITS) / (1 + np.exp(-1.702 * np.clip(z, -20, 20))))).astype(np.int64)
        return pd.Series(hilbert_index(cells, BITS))

    curve.__annotations__ = {"xs": pd.Series, "return": pd.Series}
    return points.withColumn("hilbert", F.pandas_udf(curve, "long")(*names))


def tail_cuts(total: int, capacity: int) -> list[int]:
    """Where sequences begin after the last full one: what is left falls into powers of two, the largest first."""
    at, left, out = total - total % capacity, total % capacity, []
    while left:
        out.append(at)
        size = 1 << left.bit_length() - 1
        at, left = at + size, left - size
    return out


def curve_packed(docs: DataFrame, capacity: int = 2048, end: int = 1, name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (, ids), hilbert.

    Null and empty texts are the end token alone. Repeated rows are packed as often as they are there; equal texts
    follow each other, by doc_id (null first). A document is cut where a sequence ends, and nowhere else. All sequences are
    full but those after the last full one, whose lengths are powers of two. A rerun gives the same rows; other columns
    are ignored, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    tune(spark, 3)
    points = written(tokenised(docs, end, name), "curve-points")
    total = points.agg(F.sum("n")).first()[0] or 0
    kind = "<u2" if max(vocabulary(name).size, end + 1) <= 1 << 16 else "<u4"
    ranges = max(1, min(RANGES, total // RANGE))
    order = ["hilbert", "crc", "n", "doc_id"]
    keyed = with_curve(points).select(*order, "ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("n")).to_numpy()
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part), pa.int32()), pa.array(at, pa.int64())], names=[*batch.schema.names, "part", "at"])

    schema = "hilbert long, crc long, n long, doc_id long, ids binary, part int, at long"
    # Rows that tie in all of these have the same tokens; which of them comes first makes no difference.
    placed = written(keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(place, schema), "curve-placed")
    base, bases = 0, []
    for r in placed.groupBy("part").agg(F.sum("n")).orderBy("part").collect():
        bases.append((r[0], base))
        base += r[1]
    placed = placed.join(checked_broadcast(spark.createDataFrame(bases, "part int, base long"), 16), "part")
    cuts = np.array(tail_cuts(total, capacity), np.int64)
    full = total - total % capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, hilbert, n, at, ids = (batch.column(i) for i in range(5))
            n, at = n.to_numpy(), at.to_numpy()
            last = at + n - 1
            sequence = lambda p: np.where(p < full, p // capacity, full // capacity + np.searchsorted(cuts, p, side="right") - 1)
            begin = lambda s: np.where(s * capacity < full, s * capacity, np.append(cuts, total)[np.clip(s - full // capacity, 0, len(cuts))])
            lead = sequence(at)
            times = sequence(last) - lead + 1
            of = np.repeat(np.arange(len(n)), times)
            s = A.ragged(lead, times)
            low, high = np.maximum(begin(s), at[of]), np.minimum(begin(s + 1), last[of] + 1)
            raw = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in ids.to_pylist()]
            spans = list(zip(of.tolist(), (low - at[of]).tolist(), (high - at[of]).tolist()))
            crc = pa.array([zlib.crc32(memoryview(raw[i])[4 * a : 4 * b]) for i, a, b in spans], pa.int64())
            columns = [doc.take(pa.array(of)), pa.array(low - at[of]), pa.array(high - low), crc, pa.array(n[of]), pa.array(s), pa.array(low - begin(s))]
            if with_ids:
                columns.append(pa.array([np.frombuffer(raw[i], "<u4")[a:b].astype(np.int64) for i, a, b in spans], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*columns, hilbert.take(pa.array(of))], names=names)
            A.trim()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<long>" * with_ids + ", hilbert long"
    names = [c.split()[0] for c in schema.split(", ")]
    return placed.select("doc_id", "hilbert", "n", (F.col("base") + F.col("at")).alias("at"), "ids").mapInArrow(pieces, schema)
