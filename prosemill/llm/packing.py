"""Packing token sequences by bounded-space online best fit.

Texts are cut into chunks (white space and the word after it), each distinct chunk of a batch is tokenised once, and
ids are gathered by chunk: the pattern of the byte-level tokenizer never joins a character that isn't white space (in
Unicode's sense) to white space behind it, and cuts are made only there and around special tokens, so the ids are those
of the whole text. A fixed number of bins is open at a time; a bitset keyed by free space gives the bin
that an item fills best. When all bins are open and none fits, the fullest one closes first.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import tune, written

#: Open bins of a packing task, pieces that a task packs on average, and pieces of a wave, in which the longest come first.
OPEN, PACKED, WAVE = 4096, 200_000, 8192
#: Arrow batches; ids and their places take several numbers for each token.
BATCH_MB = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Strings of a text that the tokenizer of this vocabulary takes as one token.
SPECIALS = {b"<|endoftext|>": 50256}
#: Runs of white space (in Unicode's sense) from which on the pattern's search, which goes back over a run, is left out.
LONG = 1000
_RUN = re.compile(f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG},}}")


@lru_cache(maxsize=4)
def encoding(name: str = VOCABULARY):
    """The byte-level BPE of a public vocabulary file; name is a file of the public tokenizers or a path."""
    import os

    import public_tokenizers as P
    import tiktoken

    path = name if os.path.sep in name else P.path(name)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(text: str, name: str = VOCABULARY) -> list[int]:
    """Ids of a text without special tokens. The pattern takes a run of white space but for its last character, which the
    next word may need, as one piece (the whole run at the end): a long run is cut so beforehand, as the pattern's search
    needs a stack that grows with it."""
    enc = encoding(name)
    if len(text) < LONG:
        return enc.encode_ordinary(text)
    out, at = [], 0
    for m in _RUN.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += enc.encode_ordinary(text[at : m.start()])
        out += enc._encode_single_piece(text[m.start() : end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def _after_wide_space(data: np.ndarray) -> np.ndarray:
    """Places behind a white-space character that isn't ASCII (U+0085, A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000)."""
    found = []
    for lead, size in ((0xC2, 2), (0xE1, 3), (0xE2, 3), (0xE3, 3)):
        at = np.flatnonzero(data[: len(data) - size + 1] == lead)
        one, two = data[at + 1], data[at + size - 1]
        if lead == 0xC2:
            ok = (one == 0x85) | (one == 0xA0)
        elif lead == 0xE1:
            ok = (one == 0x9A) & (two == 0x80)
        elif lead == 0xE2:
            ok = (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)) | (one == 0x81) & (two == 0x9F)
        else:
            ok = (one == 0x80) & (two == 0x80)
        found.append(at[ok] + size)
    return np.concatenate(found)


def chunk_spans(data: np.ndarray, offsets: np.ndarray, specials: Iterable[bytes] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks: a run of white space with the word after it, or a special token. Starts, ends, and the first chunk of each
    document (len+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = A.SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    cut[_after_wide_space(data)] = False
    raw = data.tobytes() if specials else b""
    for special in specials:
        at = raw.find(special)
        while at >= 0:
            # One that lies across two documents isn't one.
            if offsets[np.searchsorted(offsets, at, side="right")] >= at + len(special):
                cut[[at, at + len(special)]] = True
                at += len(special) - 1
            at = raw.find(special, at + 1)
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def token_ids(data: np.ndarray, offsets: np.ndarray, name: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts, and where each text's ids start (len+1)."""
    starts, ends, first = chunk_spans(data, offsets, SPECIALS)
    codes, distinct = A.word_codes(data, starts, ends)
    ids = [[SPECIALS[x]] if x in SPECIALS else encoded(x.decode(), name) for x in distinct.to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
    at = np.cumsum(lengths) - lengths
    own = lengths[codes]
    return flat[A.ragged(at[codes], own)], np.concatenate([[0], np.cumsum(own)])[first]


class BestFit:
    """Bounded-space best fit into bins of one capacity; a bin is a number, given out in order of opening."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.n, self.opened = 0, 0, 0

    def _take(self, space: int) -> int:
        own = self.free[space]
        out = own.pop()
        if not own:
            self.bits ^= 1 << space
        return out

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for an item of so many tokens."""
        if length == self.capacity:  # a bin of its own, never open
            self.opened += 1
            return self.opened - 1, 0
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            at = self._take(space)
        else:
            if self.n == self.open_bins:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.n -= 1
            at, space = self.opened, self.capacity
            self.opened += 1
            self.n += 1
        left = space - length
        if left:
            self.free[left].append(at)
            self.bits |= 1 << left
        else:
            self.n -= 1
        return at, self.capacity - space


def pieces(docs: DataFrame, capacity: int = 1024, end: int = 2, name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (, ids) of every document's tokens and the end token.

    Documents longer than the capacity are cut into pieces of that length; the first piece takes what is over.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.buffers(batch.column(1))
            ids, at = token_ids(data, offsets, name)
            totals = np.diff(at) + 1
            n = -(-totals // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = A.ragged(np.zeros(len(n), np.int64), n)
            over = (totals - 1) % capacity + 1  # the first piece
            start = np.where(piece > 0, over[doc] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, over[doc])
            crc, all_ids = [], []
            raw, tail = ids.astype("<u4", copy=False).tobytes(), int(end).to_bytes(4, "little")
            for a, b, whole in zip((at[doc] + start).tolist(), (at[doc] + start + length).tolist(), at[doc + 1].tolist()):
                own = raw[4 * a : 4 * min(b, whole)] + (tail if b > whole else b"")
                crc.append(zlib.crc32(own))
                if with_ids:
                    all_ids.append(np.frombuffer(own, "<u4").astype(np.int64))
            cols = [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(all_ids, pa.list_(pa.int64()))] * with_ids, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
            A.trim()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def packed(docs: DataFrame, capacity: int = 1024, end: int = 2, open_bins: int = OPEN, name: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (, ids).

    A null or empty text is the end token alone. Repeated rows are packed as often as they are there. Pieces meet the
    packer in waves by a hash, in tasks of about PACKED pieces; a rerun gives the same sequences. An empty table
    gives no rows; other columns are ignored.
    """
    tune(docs.sparkSession, BATCH_MB)
    cut = written(pieces(docs, capacity, end, name, with_ids), "pieces")
    n = cut.count()
    tasks = max(1, round(n / PACKED))
    waves = max(1, round(n / tasks / WAVE))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, bins = TaskContext.get().partitionId() << 40, BestFit(capacity, open_bins)
        for batch in batches:
            found = [bins.put(x) for x in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            keep = [c for c in batch.schema.names if c != "order"]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([base + b for b, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())], names=[*keep, "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece", F.lit(5))
    wave = F.pmod(F.shiftright("order", 20), F.lit(waves))
    dealt = cut.withColumn("order", order).repartition(tasks, "order").sortWithinPartitions(wave, F.desc("length"), "order", "doc_id", "piece", "ids_crc32")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids + ", sequence_id long, offset long"
    return dealt.mapInArrow(pack, schema)
