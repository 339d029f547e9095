"""Repeated passages by collinear chaining of shared k-mer seeds.

1. Words become 64-bit hashes; of the hashes of all runs of K words, each window of W has its smallest kept as a seed
   (winnowing: whatever run of K + W - 1 words two texts share, they share a seed of it).
2. Keys are the seeds and the runs of three seeds that follow each other: a run tells a passage better than a seed, so
   documents meet by what is theirs also where each single seed stands in many others. Any passage of 50 words has runs.
3. Occurrences of a key meet in lists. Each one is matched to the list's first document and to the document before it, so
   a key that a third of all documents hold makes two matches for each, never all pairs. Keys of very many occurrences
   are dealt to several lists by the document, and the first documents of these meet in a list of their own. Who is
   matched depends on the documents alone, not on how they are partitioned.
   These links join passages to classes. Where a list holds more places than these links reach, all its places of different
   classes are compared in a second turn by the words around them, and those that may lie in a passage are matched as well.
4. Matches of a pair of documents are chained in order in both texts: the best predecessor under a linear gap cost is a
   prefix maximum, kept in a Fenwick tree. Chains are cut where they leave out many words.
5. The words around each chain are fetched and aligned: along each diagonal of the chain, changing from one to the next
   where most words match, and outwards as long as matches outweigh mismatches. Aligned passages that are long and
   alike enough are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import attach, checked_broadcast, tune, written
from prosemill.llm.graph import components

#: Words of a seed, seeds of a window, words that a chain may leave out at a time, cost of a word left out.
K, W, GAP, COST = 6, 8, 60, 0.05
#: Passages: words at least, and the share of them that must match; words that a chain spans at least.
#: Of chains below SURE words a pair of documents has one for each place in the earlier one: text that repeats itself
#: every few words makes many, which all align alike.
MIN_WORDS, MIN_IDENTITY, MIN_CHAIN, SURE = 50, 0.8, 8, 12
#: Seeds of a run. Keys with more than 1 of LISTS occurrences, but no fewer than LONG, are dealt to lists.
RUN, LISTS, LONG = 3, 4096, 64
#: Keys come in parts of about so many, in so many parts at least; a list is in one part.
PART, PARTS = 1 << 19, 24
#: One document of TRIED is looked at to find such keys; this decides on lists only.
TRIED = 32
#: Words that places of a list are compared by (BEFORE of them before the seed), and how many must be equal: MOST, as in any
#: passage, on the seed's diagonal or those up to SHIFT words beside it, LEAST of them on its own, as one of three diagonals
#: has so many. Lists are compared by blocks of so many places.
NEAR, BEFORE, MOST, LEAST, SHIFT, BLOCK = 128, 61, int(MIN_WORDS * MIN_IDENTITY), 14, 2, 2048
#: Words of a cell.
CELL = 24
#: Places in a filter of the lists to compare: a list that gets in by chance is compared for nothing.
SLOTS = 1 << 26
#: Words fetched beyond a chain's ends, and the grid that fetched ranges are rounded to.
MARGIN, GRID = 56, 32
#: Reach of a match: the words that an alignment may add before it, times 256, and after it; at most (and where it isn't known) all.
ALL = MARGIN + GRID - 1
ANY = (ALL << 8) + ALL


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a batch, and the first word of each document (len+1)."""
    starts, ends, first = A.word_spans(data, offsets)
    return A.xxh64(data, starts, ends), first


def seeds(words: np.ndarray, first: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, position) of the seeds of a batch of documents given by their word hashes."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(words) - k + 1
    if n < 1:
        return none
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    last = first[doc + 1] - k  # the last k-mer that lies in the document
    inside = np.arange(n) <= last
    h[~inside] = np.iinfo(np.uint64).max
    wide = h.copy()
    m = max(0, n - w + 1)
    low = h[:m].copy()
    for i in range(1, w):
        np.minimum(low, h[i : i + m], out=low)
    # Windows that lie in one document; a document with fewer k-mers than a window is one window itself.
    whole = np.arange(m) + w - 1 <= last[:m]
    low[~whole] = np.iinfo(np.uint64).max
    keep = np.zeros(n, bool)
    for i in range(w):
        keep[i : i + m] |= whole & (wide[i : i + m] == low)
    keep &= inside
    at = np.flatnonzero(keep)
    short = np.flatnonzero((np.diff(first) >= k) & (np.diff(first) < k + w - 1))
    if len(short):
        more = [a + int(np.argmin(h[a : b - k + 1])) for a, b in zip(first[short].tolist(), first[short + 1].tolist())]
        at = np.sort(np.concatenate([at, np.array(more, np.int64)]))
    return h[at], doc[at], at - first[doc[at]]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, doc, pos, more): seeds and runs of seeds; more: words from the first seed of a run to its last."""
    for batch in batches:
        data, at = A.buffers(batch.column(1))
        words, first = word_hashes(A.lowered(data), at)
        h, doc, pos = seeds(words, first)
        keep = np.diff(first)[doc] >= MIN_WORDS
        h, doc, pos = h[keep], doc[keep], pos[keep]
        n = max(0, len(h) - RUN + 1)
        run, last = h[:n].copy(), np.arange(n) + RUN - 1
        for i in range(1, RUN):
            run = (run ^ (run >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + h[i : n + i]
        one = np.flatnonzero(doc[:n] == doc[last])
        key = np.concatenate([h, run[one] ^ np.uint64(1)]).view(np.int64)
        more = np.concatenate([np.zeros(len(h), np.int64), pos[last[one]] - pos[one]])
        own = np.concatenate([np.arange(len(h)), one])
        yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(doc[own])), pa.array(pos[own].astype(np.int32)), pa.array(more.astype(np.int16))], names=["h", "doc", "pos", "more"])


def _planes(columns: list[np.ndarray]) -> bytes:
    """The bytes of columns, first those of all first bytes, so that what rows have in common compresses."""
    return b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)


def _from_planes(blob: bytes) -> list[np.ndarray]:
    """The columns h, doc, pos, more of _planes."""
    kinds = [np.dtype(k) for k in ("<i8", "<i8", "<i4", "<i2")]
    n, at, out = len(blob) // sum(k.itemsize for k in kinds), 0, []
    for k in kinds:
        own = np.frombuffer(blob, np.uint8, n * k.itemsize, at).reshape(k.itemsize, n)
        out.append(np.ascontiguousarray(own.T).reshape(-1).view(k))
        at += n * k.itemsize
    return out


def _listed(h: np.ndarray, doc: np.ndarray, hot: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The list of each key: its own, or one of several by the document. hot, lists: such keys, sorted, and how many lists."""
    out = h.copy()
    if len(hot):
        j = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        at = np.flatnonzero(hot[j] == h)
        out[at] = A.spark_hash(h[at], A.spark_hash(doc[at], 3) % lists[j[at]])
    return out


def _dealt(dealing, parts: int):
    """Reads (doc_id, text): keys as _keys gives them, those of one part of the lists in one row (part, keys)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, lists = dealing.value
        held: list[list[np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            h, doc, pos, more = (np.concatenate(c) for c in zip(*held))
            part = (_listed(h, doc, hot, lists).view(np.uint64) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
            cols = [c[order] for c in (h, doc, pos, more)]
            cuts = np.flatnonzero(np.append(True, np.diff(part[order]) != 0)) if len(order) else order
            blobs = [_planes([c[i:j] for c in cols]) for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)])]
            return pa.RecordBatch.from_arrays([pa.array(part[order][cuts]), pa.array(blobs, pa.binary())], names=["part", "keys"])

        for batch in _keys(batches):
            held.append([c.to_numpy() for c in batch.columns])
            if sum(len(c[0]) for c in held) >= 1 << 18:
                yield rows()
                held.clear()
        if held:
            yield rows()
        A.trim()

    return of


def _met(dealing):
    """Reads (part, keys) sorted by part: matches of the keys, see _matches. A list of one key, not dealt, is left out at once."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, lists = dealing.value

        def part(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
            h, doc, pos, more = (np.concatenate(c) for c in zip(*map(_from_planes, blobs)))
            list_ = _listed(h, doc, hot, lists)
            order = np.argsort(list_)
            same = list_[order][1:] == list_[order][:-1]
            keep = order[np.append(False, same) | np.append(same, False) | (list_ != h)[order]]
            keep = keep[np.lexsort((pos[keep], doc[keep], list_[keep]))]
            for i in range(0, len(keep), 1 << 17):
                own = keep[i : i + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(c[own]) for c in (list_, h, doc, pos, more)], names=["list", "h", "doc", "pos", "more"])

        def sorted_() -> Iterator[pa.RecordBatch]:
            at, blobs = None, []
            for batch in batches:
                for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if p != at and blobs:
                        yield from part(blobs)
                        blobs = []
                    at = p
                    blobs.append(blob)
            if blobs:
                yield from part(blobs)

        yield from _matches(sorted_())
        A.trim()

    return of


def _neighbours(h: np.ndarray, doc: np.ndarray, old: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows sorted by (h, doc): pairs (earlier, row) with the seed's first document and with the document before, for
    rows from old on; and where a seed and where a document in a seed begins."""
    at = np.arange(len(h))
    new_h = np.append(True, h[1:] != h[:-1])[: len(h)]
    new_d = new_h | np.append(True, doc[1:] != doc[:-1])[: len(h)]
    head = np.maximum.accumulate(np.where(new_h, at, 0))  # first row of the seed
    own = np.maximum.accumulate(np.where(new_d, at, 0))  # first row of the document in the seed
    before = np.where(own > head, own[np.maximum(own - 1, 0)], -1) if len(h) else own
    star = (at >= old) & (doc != doc[head])
    step = (at >= old) & (before >= 0) & (before != head)
    return np.concatenate([head[star], before[step]]), np.concatenate([at[star], at[step]]), new_h, new_d


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From keys sorted by (list, doc, pos): matches with the list's first document and with the document before; of the
    lists of a key that has several, the first document (b null, head: the key). Seeds whose places these don't all match
    with each other, as there are more than three or two in one document, are told, too (a null, head: the key).

    Only the state of the list at hand is held: the first place in its first document and in the last two.
    """
    state: np.ndarray | None = None  # the first rows of the list's first and last two documents
    seen, last = 0, -1  # rows of the list at hand, and the document of the last one
    names = ["a", "b", "pa", "pb", "da", "db", "head"]
    for batch in batches:
        cols = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])  # list, h, doc, pos, more
        if not cols.shape[1]:
            continue
        old, going = 0, state is not None and state[0, 0] == cols[0, 0]
        key, h, doc = cols[:3]
        begin = np.append(True, key[1:] != key[:-1])
        number = np.arange(len(key)) - np.maximum.accumulate(np.where(begin, np.arange(len(key)), 0))
        number += np.where(np.cumsum(begin) == 1, seen * going, 0)
        again = (number > 0) & (doc == np.append(last, doc[:-1]))
        more_than = h[((number == 3) | (number < 3) & again | (number == 0) & (key != h)) & (cols[4] == 0)]
        seen, last = int(number[-1]) + 1, doc[-1]
        if going:
            old = state.shape[1]
            cols = np.concatenate([state, cols], 1)
        key, h, doc, pos, more = cols
        a, b, new_h, new_d = _neighbours(key, doc, old)
        first = np.flatnonzero(new_h & (key != h))
        first = first[1:] if going and len(first) and first[0] == 0 else first
        n, m, o = len(a), len(first), len(more_than)
        out = [np.concatenate([doc[a], doc[first]]), doc[b], np.concatenate([pos[a], pos[first]]), pos[b], np.concatenate([more[a], more[first]]), more[b], np.concatenate([h[first], more_than])]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int16(), pa.int16(), pa.int64()]
        arrays = []
        for k, (x, kind) in enumerate(zip(out, kinds)):
            own = pa.array(x).cast(kind)
            own = pa.concat_arrays([pa.nulls(n, kind), own] if k == 6 else [own, pa.nulls(m + o if k in (1, 3, 5) else o, kind)])
            arrays.append(own)
        yield pa.RecordBatch.from_arrays(arrays, names=names)
        head, own = int(np.flatnonzero(new_h)[-1]), np.flatnonzero(new_d)[-2:]
        state = cols[:, np.union1d(head, own[own > head])]


class Fenwick:
    """Prefix maxima of (score, index)."""

    def __init__(self, n: int):
        self.best = [(-1e18, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """Over places 0 .. i - 1."""
        out = (-1e18, -1)
        while i:
            if self.best[i] > out:
                out = self.best[i]
            i &= i - 1
        return out


def chains(pa_: list[int], pb: list[int], k: int = K, gap: int = GAP, cost: float = COST) -> list[list[int]]:
    """Chains of matches (pa, pb), sorted by (pb, pa), each rising in both; a match is in one chain.

    f(i) = k + max(0, max over earlier j of f(j) - cost * (words between in both texts)).
    """
    n = len(pa_)
    if all(x < y for x, y in zip(pa_, pa_[1:])) and all(x < y for x, y in zip(pb, pb[1:])):
        # One rising sequence: every match's best predecessor is the one before it, if any is worth its gap.
        pred, score = [-1] * n, [float(k)] * n
        for i in range(1, n):
            more = score[i - 1] - cost * (pa_[i] - pa_[i - 1] + pb[i] - pb[i - 1])
            if more > 0:
                pred[i], score[i] = i - 1, k + more
    else:
        rank = {v: i for i, v in enumerate(sorted(set(pa_)))}
        tree, pred, score, i = Fenwick(len(rank)), [-1] * n, [float(k)] * n, 0
        while i < n:
            j = i
            while j < n and pb[j] == pb[i]:  # matches at one place can't follow each other
                best, at = tree.upto(rank[pa_[j]])
                more = best - cost * (pa_[j] + pb[j])
                if at >= 0 and more > 0:
                    pred[j], score[j] = at, k + more
                j += 1
            for t in range(i, j):
                tree.put(rank[pa_[t]], (score[t] + cost * (pa_[t] + pb[t]), t))
            i = j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = pred[i]
        own.reverse()
        cut = 0
        for t in range(1, len(own)):
            if max(pa_[own[t]] - pa_[own[t - 1]], pb[own[t]] - pb[own[t - 1]]) > gap + k:
                out.append(own[cut:t])
                cut = t
        if own:
            out.append(own[cut:])
    return out


def _flat(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Matches (a, b, pa, pb, da, db, and in the second turn reach), one a row also where rows hold all of a pair in an array."""
    if batch.schema.names[2:] != ["at"]:
        return [c.to_numpy() for c in batch.columns]
    n = batch.column(2).value_lengths().to_numpy() // 4
    x, y, more, reach = batch.column(2).flatten().to_numpy().reshape(-1, 4).T
    return [np.repeat(batch.column(0).to_numpy(), n), np.repeat(batch.column(1).to_numpy(), n), x, y, more, more, reach]


def _chained(batches: Iterator[pa.RecordBatch], least: int = MIN_CHAIN) -> Iterator[pa.RecordBatch]:
    """From matches sorted by (a, b): chains long enough to lie in a passage, with the places where the diagonal changes.

    Where the matches' reach is known, so is that of a chain, and those that aren't aligned to MIN_WORDS words are left out.
    """
    held: list[np.ndarray] | None = None

    def of(cols: list[np.ndarray]) -> pa.RecordBatch:
        # The last seeds of runs are matches, too; equal matches count once, with the most reach of them.
        a, b, x, y, dx, dy, *reach = cols
        ends = np.flatnonzero(dx)
        a, b, x, y = np.append(a, a[ends]), np.append(b, b[ends]), np.append(x, x[ends] + dx[ends]), np.append(y, y[ends] + dy[ends])
        left, right = (np.append(r, r[ends]) for r in divmod(reach[0] if reach else np.full(len(dx), ANY), 1 << 8))
        order = np.lexsort((x, y, b, a))
        a, b, x, y = a[order], b[order], x[order], y[order]
        new = np.flatnonzero(np.append(True, (np.diff(a) != 0) | (np.diff(b) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)))
        a, b, x, y = a[new], b[new], x[new], y[new]
        left, right = (np.maximum.reduceat(r[order], new) for r in (left, right))
        cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        bounds = np.concatenate([[0], cut, [len(a)]])
        # A pair's only match is a chain of one seed.
        many = np.flatnonzero(np.diff(bounds) > 1)
        one = bounds[:-1][np.diff(bounds) == 1] if least <= K else many[:0]
        one = one[left[one] + K + right[one] >= MIN_WORDS]
        rows: list[tuple] = []
        for i, j in zip(bounds[many].tolist(), bounds[many + 1].tolist()):
            xs, ys, before, after, places = x[i:j].tolist(), y[i:j].tolist(), left[i:j].tolist(), right[i:j].tolist(), set()
            for own in chains(xs, ys):
                p, q = own[0], own[-1]
                words = ys[q] + K - ys[p]
                if words < least or words < SURE and xs[p] in places:
                    continue
                places.add(xs[p])
                if before[p] + words + after[q] < MIN_WORDS:
                    continue
                turns, was = [], None
                for t in own:
                    if xs[t] - ys[t] != was:
                        was = xs[t] - ys[t]
                        turns += [ys[t], was]
                rows.append((int(a[i]), int(b[i]), xs[p], xs[q] + K, ys[p], ys[q] + K, turns))
        names = ["a", "b", "a0", "a1", "b0", "b1"]
        ones = [a[one], b[one], x[one].astype(np.int64), x[one] + np.int64(K), y[one].astype(np.int64), y[one] + np.int64(K)]
        cols = [pa.array(np.concatenate([np.array([r[k] for r in rows], np.int64), ones[k]])) for k in range(6)]
        turns = pa.ListArray.from_arrays(np.arange(len(one) + 1, dtype=np.int32) * 2, pa.array(np.stack([ones[4], ones[2] - ones[4]], 1).reshape(-1)))
        return pa.RecordBatch.from_arrays([*cols, pa.concat_arrays([pa.array([r[6] for r in rows], pa.list_(pa.int64())), turns])], names=[*names, "turns"])

    for batch in batches:
        cols = _flat(batch)
        cols = cols if held is None else [np.concatenate(z) for z in zip(held, cols)]
        if not len(cols[0]):
            continue
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        last = int(np.argmax(same))
        if last:
            yield of([c[:last] for c in cols])
        held = [c[last:] for c in cols]
    if held is not None and len(held[0]):
        yield of(held)


def align(wa: np.ndarray, wb: np.ndarray, b0: int, b1: int, turns: list[tuple[int, int]]) -> tuple[int, int, int, int, int]:
    """(a start, a end, b start, b end, matching words) of the passage around a chain over b0 .. b1 of wb.

    turns: (place in wb, diagonal a - b) where the chain's diagonal starts.
    """
    matched, start = 0, b0
    for i, (_, d) in enumerate(turns):
        if i + 1 == len(turns):
            end = b1
        else:
            # Between this diagonal and the next: where changing over leaves the most words matching.
            nxt, nd = turns[i + 1]
            at = np.arange(max(start, turns[i][0]), nxt)
            one = np.concatenate([[0], np.cumsum(_equal(wa, wb, at, d))])
            two = np.concatenate([[0], np.cumsum(_equal(wa, wb, at, nd))])
            end = (int(at[0]) if len(at) else nxt) + int(np.argmax(one + two[-1] - two))
        matched += int(_equal(wa, wb, np.arange(start, end), d).sum())
        start = end
    out = []
    for d, at in ((turns[0][1], np.arange(b0 - 1, -1, -1)), (turns[-1][1], np.arange(b1, len(wb)))):
        at = at[(at + d >= 0) & (at + d < len(wa))]
        hit = _equal(wa, wb, at, d)
        gain = np.cumsum(np.where(hit, 1, -2))
        n = int(np.argmax(gain)) + 1 if len(gain) and gain.max() > 0 else 0
        matched += int(hit[:n].sum())
        out.append(n)
    s, e = b0 - out[0], b1 + out[1]
    return s + turns[0][1], e + turns[-1][1], s, e, matched


def _equal(wa: np.ndarray, wb: np.ndarray, at: np.ndarray, d: int) -> np.ndarray:
    ok = (at + d >= 0) & (at + d < len(wa)) & (at < len(wb))
    out = np.zeros(len(at), bool)
    out[ok] = wa[at[ok] + d] == wb[at[ok]]
    return out


def straight(x: np.ndarray, x0: np.ndarray, x1: np.ndarray, y: np.ndarray, y0: np.ndarray, y1: np.ndarray, b0: np.ndarray, b1: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """align for many chains of one diagonal each: wa is x[x0:x1], wb is y[y0:y1] of each; (b start, b end, matching words)."""
    rows, shift = np.arange(len(d)), x0 + d - y0
    lo, hi = y0 + np.maximum(0, -d), np.minimum(y1, y0 + (x1 - x0) - d)  # where both have words
    start, end = y0 + b0, y0 + b1
    at, of = A.ragged(start, b1 - b0), np.repeat(rows, b1 - b0)
    inside = np.flatnonzero((at >= lo[of]) & (at < hi[of]))
    at, of = at[inside], of[inside]
    matched, out = np.bincount(of[x[at + shift[of]] == y[at]], minlength=len(d)), []
    for first, room, step in ((start - 1, start - lo, -1), (end, hi - end, 1)):
        at = first[:, None] + step * np.arange(max(1, int(room.max(initial=0))))
        hit = np.arange(at.shape[1]) < room[:, None]
        hit &= np.take(x, at + shift[:, None], mode="clip") == np.take(y, at, mode="clip")
        gain = np.cumsum(np.where(hit, np.int8(1), np.int8(-2)), 1, dtype=np.int32)
        best = np.argmax(gain, 1)
        top = gain[rows, best]
        n = np.where(top > 0, best + 1, 0)
        matched += (2 * n + np.maximum(top, 0)) // 3
        out.append(n)
    return b0 - out[0], b1 + out[1], matched


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers (4 bytes each) of a binary column and where each row's begin (len+1)."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(np.uint32), (at - at[0]) // 4


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start_word", "end_word", "other_id", "other_start", "other_end", "n_matched"]
    for whole in batches:
        for batch in (whole.slice(i, 4096) for i in range(0, len(whole), 4096)):
            c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            a, b, b0, b1, al, bl = (c[n].to_numpy() for n in ("a", "b", "b0", "b1", "alo", "blo"))
            (x, xo), (y, yo), flat = _spans(c["wa"]), _spans(c["wb"]), c["turns"].flatten().to_numpy()
            n = c["turns"].value_lengths().to_numpy()
            first, one = np.cumsum(n) - n, np.flatnonzero(n == 2)
            out = np.zeros((5, len(batch)), np.int64)
            d = flat[first[one] + 1]
            s, e, hits = straight(x, xo[one], xo[one + 1], y, yo[one], yo[one + 1], (b0 - bl)[one], (b1 - bl)[one], d + (bl - al)[one])
            out[:, one] = s + bl[one] + d, e + bl[one] + d, s + bl[one], e + bl[one], hits
            for i in np.flatnonzero(n != 2).tolist():
                turns = flat[first[i] : first[i] + n[i]].tolist()
                own = [(p - int(bl[i]), d + int(bl[i] - al[i])) for p, d in zip(turns[::2], turns[1::2])]
                s, e, t, u, hits = align(x[xo[i] : xo[i + 1]], y[yo[i] : yo[i + 1]], int(b0[i] - bl[i]), int(b1[i] - bl[i]), own)
                out[:, i] = s + al[i], e + al[i], t + bl[i], u + bl[i], hits
            s, e, t, u, hits = out
            ok = np.flatnonzero((u - t >= MIN_WORDS) & (hits >= MIN_IDENTITY * (u - t)))
            yield pa.RecordBatch.from_arrays([pa.array(v[ok]) for v in (b, t, u, a, s, e, hits)], names=names)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted ranges of each document, as 32-bit hashes."""
    for batch in batches:
        data, at = A.buffers(batch.column(1))
        words, first = word_hashes(A.lowered(data), at)
        short = (words & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        docs, lo, hi, out = [], [], [], []
        for i, wanted in enumerate(batch.column(2).to_pylist()):
            own = short[first[i] : first[i + 1]]
            for x in wanted or ():
                docs.append(i)
                lo.append(x["lo"])
                hi.append(x["hi"])
                out.append(own[x["lo"] : x["hi"]].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(out, pa.binary())], names=["doc", "lo", "hi", "words"])


def _lists(own: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys of very many occurrences, LISTS or so at most, sorted; to how many lists each is dealt; and about how many
    occurrences all keys have."""
    tried = own.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(TRIED)) == 0)
    counts = written(tried.mapInArrow(_keys, KEYS).groupBy("h").agg(F.count("*").alias("n")), "seed-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(LONG, TRIED * total // LISTS)
    # Powers of two, so that keys of one passage have the same lists, or some twice as many.
    lists = F.pow(F.lit(2.0), F.floor(F.log2(F.lit(float(TRIED)) * F.col("n") / F.lit(float(most))))).cast("long")
    found = counts.where("n > 1").where(F.col("n") * TRIED >= 2 * most).select("h", lists.alias("lists")).toArrow()
    hot, lists = (found.column(c).to_numpy() for c in ("h", "lists"))
    order = np.argsort(hot)
    return hot[order], lists[order], TRIED * total


KEYS = "h long, doc long, pos int, more short"
MATCHES = "a long, b long, pa int, pb int, da short, db short, head long"


def matches(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, pa, pb, da, db) of own (doc_id, text): matches of keys, a the earlier document; and (h): seeds with more places."""

    def met(keys: DataFrame) -> DataFrame:
        return keys.select("list", "h", "doc", "pos", "more").repartition("list").sortWithinPartitions("list", "doc", "pos").mapInArrow(_matches, MATCHES)

    *dealing, total = _lists(own)
    dealing = own.sparkSession.sparkContext.broadcast(dealing)
    # Rows of many keys each: what is shuffled is sorted by the part alone, the keys of a part by themselves.
    keys = own.mapInArrow(_dealt(dealing, max(PARTS, total // PART)), "part int, keys binary")
    found = written(keys.repartition("part").sortWithinPartitions("part").mapInArrow(_met(dealing), MATCHES), "matches")
    heads = found.where("a IS NOT NULL AND head IS NOT NULL").select(F.col("head").alias("list"), F.col("head").alias("h"), F.col("a").alias("doc"), F.col("pa").alias("pos"), F.col("da").alias("more"))
    pairs = found.where("b IS NOT NULL").union(met(heads).where("b IS NOT NULL"))
    return pairs.select("a", "b", "pa", "pb", "da", "db"), found.where("a IS NULL").select(F.col("head").alias("h"))


# The second turn -------------------------------------------------------------------------------------------------------


def classed(rows: DataFrame) -> DataFrame:
    """rows of links with node and other_node, the passages of both sides, and class_id, the class of both. A passage is a
    run of words that links cover without a gap; links join passages to classes, which are named by any number."""
    sides = rows.select(F.col("doc_id").alias("doc"), F.col("start_word").alias("lo"), F.col("end_word").alias("hi"))
    sides = sides.union(rows.select("other_id", "other_start", "other_end")).distinct()
    by = Window.partitionBy("doc").orderBy("lo", "hi")
    begins = F.coalesce(F.col("lo") >= F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    sides = sides.withColumn("at", F.when(begins, F.col("lo"))).withColumn("at", F.last("at", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    sides = written(sides.withColumn("node", F.xxhash64("doc", "at")), "passage-sides")
    known = checked_broadcast(sides, 48)
    out = rows
    for doc, lo, hi, node in (("doc_id", "start_word", "end_word", "node"), ("other_id", "other_start", "other_end", "other_node")):
        out = out.join(known.select(F.col("doc").alias(doc), F.col("lo").alias(lo), F.col("hi").alias(hi), F.col("node").alias(node)), [doc, lo, hi])
    out = written(out, "passage-links")
    label = components(out.select("node", "other_node"), "node", "other_node")
    return out.join(checked_broadcast(label.select("node", F.col("component").alias("class_id")), 24), "node")


def _passages(linked: DataFrame) -> DataFrame:
    """(doc, passages): of each document the runs of words that links cover, with their classes."""
    sides = linked.select(F.col("doc_id").alias("doc"), "node", F.col("start_word").alias("lo"), F.col("end_word").alias("hi"), "class_id")
    sides = sides.union(linked.select("other_id", "other_node", "other_start", "other_end", "class_id"))
    whole = sides.groupBy("doc", "node").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("class_id").alias("label"))
    return whole.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "label"))).alias("passages"))


PLACES = "h long, doc long, pos int, label long, near binary"


def _around(doc: np.ndarray, pos: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The bytes of the words around places of a batch, 0 outside the text."""
    where = (first[doc] + pos)[:, None] + np.arange(-BEFORE, NEAR - BEFORE)
    inside = (where >= first[doc][:, None]) & (where < first[doc + 1][:, None])
    return np.where(inside, codes[np.clip(where, 0, len(codes) - 1)], np.uint8(0))


def _thinned(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which places to compare: of text that repeats itself every few words, one of a cell, whose alignment covers the cell."""
    order = np.lexsort((pos, key, doc))
    a, b = order[:-1], order[1:]
    close = np.flatnonzero((key[a] == key[b]) & (doc[a] == doc[b]) & (pos[b] - pos[a] < CELL))
    drop = np.zeros(len(key), bool)
    for i in range(0, len(close), 1 << 12):
        x, y = a[close[i : i + (1 << 12)]], b[close[i : i + (1 << 12)]]
        same = _count(_around(doc[x], pos[x], codes, first) == _around(doc[y], pos[y], codes, first)) >= NEAR // 2
        drop[y[same & (pos[x] // CELL == pos[y] // CELL)]] = True
    return np.flatnonzero(~drop)


def _places(bits):
    """Reads (doc_id, text, passages); of seeds in the filter the places, the class of the passage there (-1: none), and a byte
    for each word around."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = bits.value
        for batch in batches:
            data, at = A.buffers(batch.column(1))
            words, first = word_hashes(A.lowered(data), at)
            h, doc, pos = seeds(words, first)
            key = h.view(np.int64)
            slot = key & (SLOTS - 1)
            keep = np.flatnonzero((np.diff(first)[doc] >= MIN_WORDS) & (slots[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0))
            key, doc, pos = key[keep], doc[keep], pos[keep]
            codes = (words % np.uint64(251) + np.uint64(1)).astype(np.uint8)
            kept = _thinned(key, doc, pos, codes, first)
            keep, key, doc, pos = keep[kept], key[kept], doc[kept], pos[kept]
            label = np.full(len(keep), -1)
            cuts = np.searchsorted(doc, np.arange(len(batch) + 1))
            for i, own in enumerate(batch.column(2).to_pylist()):
                if own and cuts[i] < cuts[i + 1]:
                    lo, hi, of_ = (np.array([x[c] for x in own], np.int64) for c in ("lo", "hi", "label"))
                    p = pos[cuts[i] : cuts[i + 1]]
                    j = np.searchsorted(lo, p, side="right") - 1
                    label[cuts[i] : cuts[i + 1]] = np.where((j >= 0) & (p + K <= hi[j]), of_[j], -1)
            for i in range(0, len(keep), 1 << 13):
                own = slice(i, i + (1 << 13))
                near = _around(doc[own], pos[own], codes, first)
                ends = pa.py_buffer((np.arange(len(near) + 1) * NEAR).astype(np.int32))
                near = pa.Array.from_buffers(pa.binary(), len(near), [None, ends, pa.py_buffer(np.ascontiguousarray(near))])
                yield pa.RecordBatch.from_arrays([pa.array(key[own]), batch.column(0).take(pa.array(doc[own])), pa.array(pos[own].astype(np.int32)), pa.array(label[own]), near], names=["h", "doc", "pos", "label", "near"])
            A.trim()

    return of


def _count(equal: np.ndarray) -> np.ndarray:
    """How many of each row's NEAR flags are set."""
    bits = np.bitwise_count(np.packbits(equal.reshape(-1)).view(np.uint64)).reshape(-1, NEAR // 64)
    return bits[:, 0] + bits[:, 1]


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of x and y may lie in a passage; their marks for what lies outside a text differ. x may be one row."""
    out = _count(x == y).astype(np.int64)
    some = np.flatnonzero((out >= LEAST) & (out < MOST))
    for i in range(0, len(some), 1 << 14):
        own = some[i : i + (1 << 14)]
        u, v = x[own] if len(x) == len(y) else x, y[own]
        equal = u == v
        for d in range(1, SHIFT + 1):
            equal[:, d:] |= u[:, d:] == v[:, :-d]
            equal[:, :-d] |= u[:, :-d] == v[:, d:]
        out[own] = _count(equal)
    return out >= MOST


def _passage(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of x and y surely lie in a passage: by the words around alone, along the seed's diagonal as in align."""
    equal = x == y
    length, matched = np.full(len(equal), K), np.full(len(equal), K)
    for side in (equal[:, BEFORE + K :], equal[:, :BEFORE][:, ::-1]):
        gain = np.cumsum(np.where(side, 1, -2), 1)
        best = np.argmax(gain, 1)
        n = np.where(gain[np.arange(len(gain)), best] > 0, best + 1, 0)
        length, matched = length + n, matched + (2 * n + gain[np.arange(len(gain)), best]) * (n > 0) // 3
    return (length >= MIN_WORDS + 2) & (matched >= MIN_IDENTITY * length + 2)


def _reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The reach of matches by the words around: as in align, or all where words beyond these could still add some.

    Words that differ may have one byte here, which only adds to the reach.
    """
    equal, out = x == y, np.zeros(len(y), np.int32)
    for side in (equal[:, :BEFORE][:, ::-1], equal[:, BEFORE + K :]):
        gain = np.cumsum(np.where(side, np.int8(1), np.int8(-2)), 1, dtype=np.int16)
        best = np.argmax(gain, 1)
        top = np.maximum(gain[np.arange(len(gain)), best], 0)
        n = np.where(top > 0, best + 1, 0)
        out = (out << 8) + np.where(gain[:, -1] + ALL - gain.shape[1] > top, ALL, n).astype(np.int32)
    return out


def alike(group: np.ndarray, block: np.ndarray, doc: np.ndarray, label: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group, in different documents, that may lie in a passage and aren't joined already: by passages of
    one class, or by pairs before that surely lie in one.

    block: rows of two blocks meet each other only, those with -1 all of their group. Of places of a document with the same
    words around, the first is compared, and the others are matched to one place that is alike.
    """
    n, other = len(doc), np.where(near == 0, np.uint8(255), near)
    _, same = np.unique(np.ascontiguousarray(near).view(f"V{NEAR}").reshape(-1), return_inverse=True)
    order = np.lexsort((np.arange(n), same, doc, block, group))
    new = np.append(True, np.logical_or.reduce([np.diff(c[order]) != 0 for c in (group, block, doc, same)]))
    rep = np.empty(n, np.int64)
    rep[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # Rows that stand for others, by group, block and class, so that rows of one class needn't be looked at.
    reps = np.flatnonzero(rep == np.arange(n))
    reps = reps[np.lexsort((label[reps], block[reps], group[reps]))]
    ends = np.append(np.flatnonzero(np.append(True, np.diff(group[reps]) != 0)), len(reps))
    sizes = np.diff(ends)
    # What is joined: rows of a class to start with.
    order = np.lexsort((label, group))
    new = np.append(True, (np.diff(group[order]) != 0) | (np.diff(label[order]) != 0)) | (label[order] == -1)
    joined = np.empty(n, np.int64)
    joined[order] = np.cumsum(new) - 1
    # Of small groups, pairs of all rows at once.
    times = np.maximum(np.repeat(np.where(sizes <= 64, ends[1:], 0), sizes) - np.arange(len(reps)) - 1, 0)
    total, i, up = np.concatenate([[0], np.cumsum(times)]), 0, list(range(n))
    while i < len(reps):
        j = max(i + 1, int(np.searchsorted(total, total[i] + (1 << 17), side="right")) - 1)
        x, y = reps[np.repeat(np.arange(i, j), times[i:j])], reps[A.ragged(np.arange(i, j) + 1, times[i:j])]
        keep = (doc[x] != doc[y]) & (joined[x] != joined[y]) & ((block[x] != block[y]) | (block[x] < 0))
        x, y = x[keep], y[keep]
        keep = _near(near[x], other[y])
        x, y = x[keep], y[keep]
        keep = []
        for u, v, sure in zip(joined[x].tolist(), joined[y].tolist(), _passage(near[x], other[y]).tolist()):
            while up[u] != u:
                up[u] = u = up[up[u]]
            while up[v] != v:
                up[v] = v = up[up[v]]
            keep.append(u != v)
            if sure:
                up[u] = v
        one.append(x[np.array(keep, bool)])
        two.append(y[np.array(keep, bool)])
        i = j
    for s, e in zip(ends[:-1][sizes > 64].tolist(), ends[1:][sizes > 64].tolist()):
        own = reps[s:e]
        u, v, d, b, c = near[own], other[own], doc[own], block[own], joined[own]
        half = int(np.searchsorted(b, b[0], side="right"))
        start = half if half < len(own) else 0  # of the rows that are met: those of the second block, or all
        if b[0] >= 0 and not start:
            continue
        for i in range(half):
            after = max(start, i + 1)
            at = np.flatnonzero(c[after:] != c[i]) + after
            if 2 * len(at) > len(own) - after:
                # Most rows: what isn't near at all goes before rows are picked.
                at = np.flatnonzero(_count(v[after:] == u[i : i + 1]) >= LEAST) + after
                at = at[c[at] != c[i]]
            at = at[d[at] != d[i]]
            at = at[_near(u[i : i + 1], v[at])] if len(at) else at
            if len(at):
                sure = _passage(u[i : i + 1], v[at])
                _, once = np.unique(c[at[sure]], return_index=True)
                to = at[sure][once]
                more = at[~sure]
                more = more[~np.isin(c[more], c[to])]
                one.append(np.full(len(to) + len(more), own[i]))
                two += [own[to], own[more]]
                c[np.isin(c, c[to])] = c[i]
    rest = np.flatnonzero((rep != np.arange(n)) & ((label == -1) | (label != label[rep])))
    rest = rest[np.argsort(rep[rest], kind="stable")]
    names = group[reps[ends[:-1]]]
    for own in np.split(rest, np.flatnonzero(np.diff(rep[rest])) + 1) if len(rest) else ():
        first = int(rep[own[0]])
        k = int(np.searchsorted(names, group[first]))
        met = reps[ends[k] : ends[k + 1]]
        met = met[(doc[met] != doc[first]) & ((block[met] != block[first]) | (block[met] < 0))]
        if len(met) and (hit := met[_near(near[first][None], other[met])][:1]).size:
            own = own[(label[own] == -1) | (label[own] != label[hit[0]])]
            one.append(own)
            two.append(np.repeat(hit, len(own)))
    return np.concatenate(one), np.concatenate(two)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (list, x, y, block, doc, pos, label, near) sorted by the first three: matches of places that are alike, those of
    a pair of documents in a row (a, b, at: pa, pb, 0 and reach of each)."""
    held: list[np.ndarray] | None = None

    def of(cols: list[np.ndarray]) -> pa.RecordBatch:
        key, x, y, block, doc, pos, label, near = cols
        new = np.append(True, (np.diff(key) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0))
        i, j = alike(np.cumsum(new), np.where(x == y, -1, block), doc, label, near)
        i, j = np.where(doc[i] < doc[j], i, j), np.where(doc[i] < doc[j], j, i)
        order = np.lexsort((doc[j], doc[i]))
        i, j = i[order], j[order]
        reach = [_reach(near[i[k : k + (1 << 12)]], np.where(near[j[k : k + (1 << 12)]] == 0, np.uint8(255), near[j[k : k + (1 << 12)]])) for k in range(0, len(i), 1 << 12)]
        at = np.stack([pos[i], pos[j], np.zeros(len(i), np.int32), np.concatenate([np.zeros(0, np.int32), *reach])], 1).astype(np.int32)
        cuts = np.flatnonzero(np.append(True, (np.diff(doc[i]) != 0) | (np.diff(doc[j]) != 0))) if len(i) else i
        ends = pa.array(4 * np.append(cuts, len(i)), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(doc[i[cuts]]), pa.array(doc[j[cuts]]), pa.ListArray.from_arrays(ends, pa.array(at.reshape(-1)))], names=["a", "b", "at"])

    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns[:-1]]
        near = batch.column(len(cols)).cast(pa.large_binary())
        cols.append(np.frombuffer(near.buffers()[2], np.uint8)[np.frombuffer(near.buffers()[1], np.int64)[near.offset] :][: len(near) * NEAR].reshape(-1, NEAR) if len(near) else np.zeros((0, NEAR), np.uint8))
        cols = cols if held is None else [np.concatenate(z) for z in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = int(np.argmax(np.logical_and.reduce([c == c[-1] for c in cols[:3]])))
        if last:
            yield of([c[:last] for c in cols])
        held = [c[last:] for c in cols]
    if held is not None and len(held[0]):
        yield of(held)
    held = None
    A.trim()


def more_matches(own: DataFrame, seeds_: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, at): of the seeds with more places than were matched, matches of all that are alike and that links (rows) don't
    join already; at: pa, pb, words to a second seed (in both) and reach of each match."""
    slots = seeds_.select((F.col("h").bitwiseAND(F.lit(SLOTS - 1))).cast("int").alias("slot")).distinct().toArrow().column("slot").to_numpy()  # SLOTS at most
    filter_ = np.zeros(SLOTS >> 3, np.uint8)
    np.bitwise_or.at(filter_, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))
    bits = own.sparkSession.sparkContext.broadcast(filter_)
    passages = checked_broadcast(_passages(classed(rows)), 64)
    texts = own.join(passages, own["doc_id"] == passages["doc"], "left").select("doc_id", "text", "passages")
    places = written(texts.mapInArrow(_places(bits), PLACES).withColumn("same", F.struct("h", F.xxhash64("near").alias("near"), "label")), "places")
    # Places of one seed and class with the same words around, in several documents: two of them stand for all.
    place = F.struct("doc", "pos")
    alike_ = written(places.groupBy("same").agg(F.count("*").alias("n"), F.min(place).alias("one"), F.max(place).alias("two")), "place-groups")
    several = F.col("one.doc") != F.col("two.doc")
    # Lists of one document or one class have nothing to compare.
    lists = alike_.groupBy("same.h").agg(
        F.sum(F.when(several, 2).otherwise(F.col("n"))).alias("n"), (F.min("one.doc") != F.max("two.doc")).alias("docs"), (F.min("same.label") != F.max("same.label")).alias("labels"), F.min("same.label").alias("label")
    )
    lists = written(lists.where("docs AND (labels OR label = -1)").select("h", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "place-lists")
    stood_for = written(alike_.where(several & (F.col("n") > 2)), "places-stood-for")
    found = attach(places.join(checked_broadcast(lists, 24), "h"), stood_for, "same", "n", places.count(), 96)
    stands = F.col("one").isNull() | (place == F.col("one")) | (place == F.col("two"))
    met = found.where(stands).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(F.col("h").alias("list"), F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "block", "doc", "pos", "label", "near")
    pairs = met.repartition("list", "x", "y").sortWithinPartitions("list", "x", "y", "doc", "pos").mapInArrow(_compared, "a long, b long, at array<int>")
    # The others are matched to one of the two, if no class has them: by K words after the seed, or before it where the text
    # ends, besides the seed, so that each place of a text that repeats itself has a chain of its own.
    rest = found.where(~stands & (F.col("label") == -1))
    back = F.when(F.substring("near", BEFORE + 2 * K, 1) == F.lit(b"\0"), K).otherwise(0)
    at = lambda c: F.struct(c["doc"].alias("doc"), (c["pos"] - back).cast("int").alias("pos"))
    rest = rest.select(at(F.when(F.col("one.doc") != F.col("doc"), F.col("one")).otherwise(F.col("two"))).alias("to"), at(place).alias("of"))
    rest = rest.select(F.least("to", "of").alias("x"), F.greatest("to", "of").alias("y"))
    rest = rest.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), F.array("x.pos", "y.pos", F.lit(K), F.lit(ANY)).alias("at"))
    return written(pairs.union(rest), "more-matches")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Rows for each passage of at least 50 words that a document shares with another one.

    doc_id, start_word, end_word (exclusive), other_id (the earlier document), other_start, other_end, n_matched: words that
    match, 4/5 at least. Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, counted from 0. Two places that share a seed and
    lie in a passage have a row, or rows join the passages that they lie in to one class (classed): a passage of many
    documents is told by links to the first document with it and to the one before (for passages of very many documents:
    those of its list, and the lists' first documents likewise), and whatever these leave apart is compared in full. So
    links grow with the documents, and every place with a passage is in a row. Passages inside one document only don't
    count. A null or short text has none. Rows with one doc_id count as one document; a null doc_id takes no part. Ties go
    to the earlier place. The rows don't depend on how docs is partitioned. An empty table gives no rows; other columns
    are ignored.
    """
    tune(docs.sparkSession, 3, rows=1 << 15)  # most stages have narrow rows
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    pairs, more = matches(own)
    rows = written(linked(own, pairs, MIN_CHAIN), "links")
    # What lies around these matches was compared, so a single seed is enough.
    return rows.union(written(linked(own, more_matches(own, more, rows), K), "more-links")).distinct()


def passage_classes(docs: DataFrame) -> DataFrame:
    """The rows of repeated_passages with class_id: rows of one class are links between passages that hang together."""
    rows = written(repeated_passages(docs), "passages")
    return classed(rows).select(*rows.columns, "class_id")


def linked(own: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """The links of own (doc_id, text) along chains of at least so many words of matches (a, b, pa, pb, da, db, or at)."""
    pairs = pairs.repartition("a", "b").sortWithinPartitions("a", "b")
    chained = pairs.mapInArrow(lambda batches: _chained(batches, least), "a long, b long, a0 long, a1 long, b0 long, b1 long, turns array<long>")
    grid = {}
    for side in "ab":
        lo, hi = F.greatest(F.col(f"{side}0") - MARGIN, F.lit(0)), F.col(f"{side}1") + MARGIN
        grid[side] = F.struct(F.col(side).alias("doc"), (lo - lo % GRID).alias("lo"), (hi + F.pmod(-hi, F.lit(GRID))).alias("hi"))
    rows = written(chained.select("a", "b", "b0", "b1", "turns", grid["a"].alias("ka"), grid["b"].alias("kb")), "chains")
    total = rows.count()
    wanted = rows.select("ka").union(rows.select("kb")).groupBy(F.col("ka").alias("key")).agg(F.count("*").alias("uses"))
    wanted = written(wanted, "ranges")
    lists = wanted.groupBy(F.col("key.doc").alias("doc")).agg(F.collect_list(F.struct("key.lo", "key.hi")).alias("wanted"))
    lists = F.broadcast(lists) if wanted.count() * 32 <= 32 << 20 else lists
    texts = own.join(lists, own["doc_id"] == lists["doc"]).select("doc_id", "text", "wanted")
    pieces = texts.mapInArrow(_ranges, "doc long, lo long, hi long, words binary").groupBy(F.struct("doc", "lo", "hi").alias("key")).agg(F.first("words").alias("words"))
    pieces = written(pieces.join(wanted, "key"), "passage-words")
    size = 64 + int(pieces.agg(F.avg(F.octet_length("words"))).first()[0] or 0)
    both = attach(rows, pieces.select(F.col("key").alias("ka"), F.col("words").alias("wa"), "uses"), "ka", "uses", total, size).drop("uses")
    both = attach(both, pieces.select(F.col("key").alias("kb"), F.col("words").alias("wb"), "uses"), "kb", "uses", total, size).drop("uses")
    both = both.select("a", "b", "b0", "b1", "turns", F.col("ka.lo").alias("alo"), F.col("kb.lo").alias("blo"), "wa", "wb")
    long = ("doc_id", "start_word", "end_word", "other_id", "other_start", "other_end", "n_matched")
    return both.mapInArrow(_aligned, ", ".join(f"{c} long" for c in long))
