"""Language-model scores by a causal self-attention model, trained in numpy on subword ids.

Words are lower-cased (A-Z). Frequent training words are symbols of their own; the others become subword ids of a public
byte-level vocabulary, and a symbol is an id with a mark if it ends its word. So a word's symbols are its spelling, and no
word is the beginning of another. One layer of causal
attention over windows of L symbols predicts the class of the next symbol; within its class a symbol has its share of
all training documents. Frequent symbols are classes of their own, the others are clustered by the frequent symbols
around them. A word's probability mixes two: that of its spelling under the attention model, and its discounted share of
the training words (none if it isn't among them); what the discounts leave goes to spellings, so the mix is a proper
distribution over words.

Word and symbol counts and training windows come from all training documents, whatever their size is. Weights are trained
in rounds: each group of windows runs its own optimiser steps from the common weights, and the results are averaged. Every
window reaches a gradient.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import tune, written
from prosemill.llm.packing import LONG, VOCABULARY, encoded, encoding

#: Window length, its positions that are context only, model width, width of queries and keys, hidden width.
L, CONTEXT, D, KEY, HIDDEN = 32, 8, 16, 8, 32
STEP = L - CONTEXT
#: Classes stand in GROUPS groups of MEMBERS; most are single symbols, the others clusters. Dimensions of surroundings.
GROUPS, MEMBERS, SKETCH = 32, 32, 16
CLASSES = GROUPS * MEMBERS
SINGLE = CLASSES - 192
#: Windows of a group; windows of a step; rounds; steps of a round at least.
GROUP, BATCH, ROUNDS, STEPS = 1 << 18, 512, 4, 100
#: Windows whose attention is worked out together.
PART = 64
#: Weight of the spelling under the attention model for any word, and the discount of a training word's count.
ALPHA, DISCOUNT = 0.7, 0.9
#: Ids of the vocabulary, and the symbol that ends a text (also the padding before it).
IDS, END = 50257, 2 * 50256 + 1
SYMBOLS = 2 * IDS
#: Words that are symbols of their own, after those: the most frequent ones, at most so many, each at least so often there.
WHOLE, OFTEN = 1 << 17, 8
NONE_WHOLE = np.zeros(0, np.int64)
#: Words whose counts every task holds, at most: the most frequent ones. The counts of the others are joined.
HELD_WORDS = 1 << 20
END_HASH = -1
SHAPES = {"E": (CLASSES, D), "F": (CLASSES, D), "H": (CLASSES, D), "Q": (D, KEY), "K": (D, KEY), "V": (D, D), "O": (D, D), "A": (D, HIDDEN), "a": (HIDDEN,), "B": (HIDDEN, D), "G": (GROUPS, D), "g": (GROUPS,), "M": (CLASSES, D), "m": (CLASSES,)}
SEEN = np.tril(np.ones((L, L), np.float32))


def held_out(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % 10 == 0 for i in ids], bool)


@lru_cache(maxsize=1)
def _begins_word() -> np.ndarray:
    enc = encoding(VOCABULARY)
    return np.array([enc.decode_single_token_bytes(i)[:1] == b" " for i in range(IDS - 1)], bool)


def spelled(words: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, each after a space, and how many each has. One text is encoded: a piece with a space begins a word."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.large_binary())
    data, at = _bytes_of(words)
    lengths = np.diff(at)
    # A long word may hold a run of wide spaces that one call can't take.
    ids = np.zeros(0, np.int64)
    if lengths.max() < LONG:
        text = np.full(len(data) + len(words), 32, np.uint8)
        text[np.arange(len(data)) + np.repeat(np.arange(1, len(words) + 1), lengths)] = data
        ids = encoding(VOCABULARY).encode_to_numpy(text.tobytes().decode(), disallowed_special=())
    starts = np.flatnonzero(_begins_word()[ids])
    if len(starts) != len(words):
        parts = [encoded(" " + w.decode()) for w in words.to_pylist()]
        return np.array(list(chain.from_iterable(parts)), np.int64), np.fromiter(map(len, parts), np.int64, len(parts))
    return ids.astype(np.int64), np.diff(np.append(starts, len(ids)))


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and len+1 offsets (from 0) of a large binary array."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


class Words:
    """The words of a batch: codes by word, first word of each document (len+1), and of each distinct word its hash and symbols.

    whole: hashes of the words that are symbols of their own, ascending.
    """

    def __init__(self, column: pa.Array, spell: bool = True, whole: np.ndarray = NONE_WHOLE):
        data, at = A.buffers(column)
        low = A.lowered(data)
        starts, ends, self.first = A.word_spans(low, at)
        self.codes, distinct = A.word_codes(low, starts, ends)
        words, ends = _bytes_of(distinct)
        self.hash = A.xxh64(words, ends[:-1], ends[1:]).view(np.int64)
        self.hash[self.hash == END_HASH] = 0
        if spell:
            j = np.searchsorted(whole, self.hash)
            own = np.append(whole, 0)[j] == self.hash
            own &= j < len(whole)
            rest = np.flatnonzero(~own)
            flat, n = spelled(distinct.take(pa.array(rest)))
            flat *= 2
            flat[np.cumsum(n) - 1] += 1
            self.length = np.ones(len(distinct), np.int64)
            self.length[rest] = n
            self.at = np.cumsum(self.length) - self.length
            self.symbols = np.empty(int(self.length.sum()), np.int64)
            self.symbols[A.ragged(self.at[rest], n)] = flat
            self.symbols[self.at[own]] = SYMBOLS + j[own]

    def part(self, i: int, j: int) -> Words:
        """The words of documents i .. j - 1 alone."""
        out = object.__new__(Words)
        out.__dict__.update(self.__dict__)
        out.codes = self.codes[self.first[i] : self.first[j]]
        out.first = self.first[i : j + 1] - self.first[i]
        return out

    def sequences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all documents, each ended by END; where each document's start (len+1); the word of each symbol,
        numbered over the batch with an end counted as a word."""
        n = len(self.first) - 1
        lengths = self.length[self.codes]
        # Words with the ends in between: document i's end comes after its words.
        total = len(self.codes) + n
        end_at = self.first[1:] + np.arange(n)
        is_end = np.zeros(total, bool)
        is_end[end_at] = True
        all_lengths = np.ones(total, np.int64)
        all_lengths[~is_end] = lengths
        starts = np.cumsum(all_lengths) - all_lengths
        out = np.full(int(all_lengths.sum()), END, np.int64)
        out[A.ragged(starts[~is_end], lengths)] = self.symbols[A.ragged(self.at[self.codes], lengths)]
        word = np.repeat(np.arange(total), all_lengths)
        return out, np.concatenate([[0], starts[end_at] + 1]), word


def windows(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (w, L) and targets (w, L) of overlapping windows, the place in symbols of each target (-1: none to score),
    the document of each window and its number there. Every symbol is scored in one window, with CONTEXT symbols or more
    before it."""
    lengths = np.diff(at)
    pad = CONTEXT + 1
    base = at[:-1] + pad * np.arange(len(lengths))
    flat = np.full(len(symbols) + pad * len(lengths) + L + 1, END, np.int64)
    own = np.repeat(base + pad - at[:-1], lengths) + np.arange(len(symbols))
    flat[own] = symbols
    n = -(-lengths // STEP)
    doc = np.repeat(np.arange(len(n)), n)
    k = A.ragged(np.zeros(len(n), np.int64), n)
    start = k * STEP
    place = (base[doc] + start)[:, None] + np.arange(L)
    where = (start - CONTEXT)[:, None] + np.arange(L)
    score = np.where((np.arange(L) >= CONTEXT) & (where < lengths[doc][:, None]), where + at[:-1][doc][:, None], -1)
    return flat[place], flat[place + 1], score, doc, k


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (rng.standard_normal(s) * 0.25).astype(np.float32) * (k not in "agm") for k, s in SHAPES.items()}


def _embedded(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Each place has a vector of its own class and of each of the two before it in the window."""
    h = np.take(w["E"], x, axis=0)
    h[:, 1:] += np.take(w["F"], x[:, :-1], axis=0)
    h[:, 2:] += np.take(w["H"], x[:, :-2], axis=0)
    return h


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: int = 0) -> tuple[np.ndarray, tuple]:
    """The last hidden states (b * (L - first), D) for input classes x (b, L), with batched masked attention; places before
    the first one are only attended to. Then what backward needs."""
    b, h, mix = len(x), _embedded(w, x), np.concatenate([w[n] for n in "QKV"], 1)
    flat = h.reshape(-1, D)
    qkv = (flat @ mix).reshape(b, L, -1)
    v = np.empty((b, L, D + 1), np.float32)  # with ones, whose product is the sum of the weights
    v[..., :D], v[..., D] = qkv[..., 2 * KEY :], 1
    s = qkv[:, first:, :KEY] @ qkv[..., KEY : 2 * KEY].transpose(0, 2, 1)
    np.clip(s, -60, 60, out=s)
    np.exp(s, out=s)
    s *= SEEN[first:]
    c = s @ v
    part = 1 / c[..., D:]
    c = (c[..., :D] * part).reshape(-1, D)
    y = c @ w["O"]
    y += h[:, first:].reshape(-1, D)
    r = y @ w["A"]
    r += w["a"]
    np.maximum(r, 0, out=r)
    z = r @ w["B"]
    z += y
    return z, (flat, mix, qkv, v, s, part, c, y, r)


def backward(w: dict[str, np.ndarray], g: dict[str, np.ndarray], dz: np.ndarray, first: int, flat: np.ndarray, mix: np.ndarray, qkv: np.ndarray, v: np.ndarray, s: np.ndarray, part: np.ndarray, c: np.ndarray, y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Gradients by the embedded places (b, L, D), from those by forward's states; the weights' are added to g. dz is used up."""
    b, n = len(v), L - first
    g["B"] += r.T @ dz
    dr = dz @ w["B"].T
    dr *= r > 0
    g["A"] += y.T @ dr
    g["a"] += np.ones(len(dr), np.float32) @ dr
    dz += dr @ w["A"].T
    g["O"] += c.T @ dz
    # s isn't divided by its rows' sums: dc is. A row of dc times its context is what the softmax takes from each weight.
    dc = np.empty((b, n, D + 1), np.float32)
    np.multiply((dz @ w["O"].T).reshape(b, n, D), part, out=dc[..., :D])
    dc[..., D] = -np.einsum("ij,ij->i", dc[..., :D].reshape(-1, D), c).reshape(b, n)
    ds = dc @ v.transpose(0, 2, 1)
    ds *= s
    d = np.zeros((b, L, mix.shape[1]), np.float32)
    d[:, first:, :KEY] = ds @ qkv[..., KEY : 2 * KEY]
    d[..., KEY : 2 * KEY] = ds.transpose(0, 2, 1) @ qkv[:, first:, :KEY]
    d[..., 2 * KEY :] = s.transpose(0, 2, 1) @ dc[..., :D]
    d = d.reshape(-1, d.shape[2])
    for k, own in zip("QKV", np.split(flat.T @ d, [KEY, 2 * KEY], axis=1)):
        g[k] += own
    dh = (d @ mix.T).reshape(b, L, D)
    dh[:, first:] += dz.reshape(b, n, D)
    return dh


def _softmax(logits: np.ndarray, goal: np.ndarray) -> float:
    """Cross-entropy; the logits become its gradient. Sums by a product, as reductions of short rows are slow."""
    np.clip(logits, -60, 60, out=logits)
    flat, at = logits.reshape(-1), np.arange(0, logits.size, logits.shape[1]) + goal
    own = flat[at]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    logits *= (1 / total)[:, None]
    flat[at] -= 1
    return float(np.log(total).sum() - own.sum())


def gradients(w: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of the target classes whose weight isn't 0, and its gradients. PART windows at a time go through the
    attention, so that what it holds of them stays in the processor's cache."""
    first = 0 if weight[:, :CONTEXT].any() else CONTEXT
    n, g = L - first, {k: np.zeros_like(v) for k, v in w.items()}
    parts = [forward(w, x[i : i + PART], first) for i in range(0, len(x), PART)]
    z = np.concatenate([own for own, _ in parts])
    rows = np.flatnonzero(weight[:, first:])
    goal = target[:, first:].reshape(-1)[rows].astype(np.int64)
    order = np.argsort((goal // MEMBERS).astype(np.int16), kind="stable")
    rows, goal = rows[order], goal[order]
    zs, ones, total = np.take(z, rows, axis=0), np.ones(len(rows), np.float32), np.float32(max(1, len(rows)))
    # The group, then the member of the group: two small softmaxes.
    group = goal // MEMBERS
    p = zs @ w["G"].T
    p += w["g"]
    loss = _softmax(p, group)
    g["G"], g["g"] = p.T @ zs, ones @ p
    dzs = p @ w["G"]
    cuts = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
    own = [(slice(i, j), slice(k * MEMBERS, (k + 1) * MEMBERS)) for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
    for at, k in own:
        np.matmul(zs[at], w["M"][k].T, out=p[at])
        p[at] += w["m"][k]
    loss += _softmax(p, goal % MEMBERS)
    for at, k in own:
        g["M"][k], g["m"][k] = p[at].T @ zs[at], ones[at] @ p[at]
        dzs[at] += p[at] @ w["M"][k]
    for k in "GgMm":
        g[k] /= total
    dzs /= total
    dz = np.zeros_like(z)
    dz[rows] = dzs
    dh = np.zeros((len(x), L + 2, D), np.float32)  # two empty places end each window
    for i, (_, held) in zip(range(0, len(x), PART), parts):
        dh[i : i + PART, :L] = backward(w, g, dz[i * n : (i + PART) * n], first, *held)
    # A place's class reaches its own state and the two after it. Rows are summed by class.
    leaf, dh = x.reshape(-1).astype(np.int16), dh.reshape(-1, D)  # these are sorted by their digits
    order = np.argsort(leaf, kind="stable")
    leaf = leaf[order]
    cut = np.flatnonzero(np.append(True, np.diff(leaf) > 0))
    order += order // L * 2
    for after, k in enumerate("EFH"):
        g[k][leaf[cut]] = np.add.reduceat(np.take(dh, order + after, axis=0), cut, axis=0)
    return loss / float(total), g


def trained(w: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray, rates: tuple[float, float], passes: int = 1, seed: int = 0) -> dict[str, np.ndarray]:
    """Steps of Adam over all windows, so many times in shuffled orders; the rate falls from the first to the second."""
    w = {k: v.copy() for k, v in w.items()}
    m, s = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    rng = np.random.default_rng(seed)
    order = np.concatenate([rng.permutation(len(inputs)) for _ in range(passes)])
    steps = -(-len(order) // BATCH)
    for step in range(1, steps + 1):
        own = order[(step - 1) * BATCH : step * BATCH]
        _, g = gradients(w, inputs[own], targets[own], weight[own])
        rate = rates[0] + (rates[1] - rates[0]) * (step - 1) / steps
        for k in w:
            m[k] += 0.1 * (g[k] - m[k])
            s[k] += 0.01 * (g[k] ** 2 - s[k])
            w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def hidden(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """As forward gives it at the places to score, (b * STEP, D): only what is scored goes on after the attention."""
    return forward(w, x, CONTEXT)[0]


def _log_share(logits: np.ndarray, goal: np.ndarray) -> np.ndarray:
    np.clip(logits, -60, 60, out=logits)
    own = logits[np.arange(len(goal)), goal]
    np.exp(logits, out=logits)
    return own - np.log(logits @ np.ones(logits.shape[1], np.float32))


def symbol_scores(w: dict[str, np.ndarray], class_of: np.ndarray, share: np.ndarray, symbols: np.ndarray, at: np.ndarray, batch: int = 1024) -> np.ndarray:
    """log of each symbol's probability: its class under the attention model times its share of the class."""
    out = share[symbols]
    leaf, lengths = class_of.astype(np.int16)[symbols], np.diff(at)
    # As windows() lays them out; the scored places of all windows, one after the other, are the symbols in order.
    pad = CONTEXT + 1
    base = at[:-1] + pad * np.arange(len(lengths))
    flat = np.full(len(symbols) + pad * len(lengths) + L + 1, class_of[END], np.int16)
    flat[np.repeat(base + pad - at[:-1], lengths) + np.arange(len(symbols))] = leaf
    n = -(-lengths // STEP)
    start = A.ragged(np.zeros(len(n), np.int64), n) * STEP
    scored = np.minimum(np.repeat(lengths, n) - start, STEP)
    view, start, upto = np.lib.stride_tricks.sliding_window_view(flat, L), start + np.repeat(base, n), np.concatenate([[0], np.cumsum(scored)])
    members = [np.ascontiguousarray(w["M"][k : k + MEMBERS].T) for k in range(0, CLASSES, MEMBERS)]
    for i in range(0, len(start), batch):
        z = np.concatenate([hidden(w, view[start[j : min(j + PART, i + batch)]]) for j in range(i, min(i + batch, len(start)), PART)])
        own = scored[i : i + batch]
        if (own < STEP).any():
            z = np.take(z, np.flatnonzero((np.arange(STEP) < own[:, None]).reshape(-1)), axis=0)
        # In the order of their groups, so that a group's rows are one slice.
        goal = leaf[upto[i] : upto[min(i + batch, len(start))]]
        order = np.argsort(goal // MEMBERS, kind="stable")
        z, goal = np.take(z, order, axis=0), goal[order]
        cuts = np.searchsorted(goal // MEMBERS, np.arange(GROUPS + 1))
        logits = np.empty((len(goal), MEMBERS), np.float32)
        for k, (x, y) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if x < y:
                np.matmul(z[x:y], members[k], out=logits[x:y])
                logits[x:y] += w["m"][k * MEMBERS : (k + 1) * MEMBERS]
        found = _log_share(z @ w["G"].T + w["g"], goal // MEMBERS)
        found += _log_share(logits, goal % MEMBERS)
        out[upto[i] + order] += found
    return out


# On DataFrames ---------------------------------------------------------------------------------------------------------

SYMBOL, WINDOW = 1, 2


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the words of training documents, and of their ends."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    ends = 0

    def rows(key, n):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    def words():
        key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return key, np.bincount(at, np.concatenate([n for _, n in held]), len(key)).astype(np.int64)

    for batch in batches:
        keep = np.flatnonzero(~held_out(batch.column(0).to_pylist()))
        own = Words(batch.column(1).take(pa.array(keep)), spell=False)
        held.append((own.hash, np.bincount(own.codes, minlength=len(own.hash))))
        ends += len(keep)
        if sum(len(k) for k, _ in held) > 2_000_000:
            held[:] = [words()]
            if len(held[0][0]) > 1_000_000:
                yield rows(*held.pop())
    if held:
        yield rows(*words())
    if ends:
        yield rows(np.array([END_HASH]), np.array([ends]))


def _gather(whole: np.ndarray):
    """Of training documents: partial counts of spelled symbols, and all windows. whole: as in Words."""
    names = ["kind", "key", "n", "window"]

    def rows(kind, key, n, window=None):
        blank = pa.nulls(len(key), pa.binary())
        if window is not None:
            ends = (np.arange(len(window) + 1) * window.itemsize * window.shape[1]).astype(np.int32)
            blank = pa.Array.from_buffers(pa.binary(), len(window), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(window))])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n), blank], names=names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_symbols = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            crc = np.array([zlib.crc32(str(i).encode()) for i in ids], np.int64)
            keep = np.flatnonzero(~held_out(ids))
            own, crc = Words(batch.column(1).take(pa.array(keep)), whole=whole), crc[keep]
            if not len(crc):
                continue
            n = np.bincount(own.codes, minlength=len(own.hash))
            of_symbols += np.bincount(own.symbols, np.repeat(n, own.length), SYMBOLS + len(whole))[:SYMBOLS].astype(np.int64)
            of_symbols[END] += len(crc)
            for i in range(0, len(crc), 256):
                part = crc[i : i + 256]
                symbols, at, _ = own.part(i, i + len(part)).sequences()
                inputs, targets, score, doc, k = windows(symbols, at)
                # Inputs with the last target, and how many targets count, are the window.
                packed = np.concatenate([inputs, targets[:, -1:], (score >= 0).sum(1, keepdims=True)], 1).astype("<i4")
                if len(packed):
                    yield rows(WINDOW, part[doc] * 1_000_003 + k, np.ones(len(packed), np.int64), packed)
        seen = np.flatnonzero(of_symbols)
        if len(seen):
            yield rows(SYMBOL, seen, of_symbols[seen])

    return of


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and weights of packed windows."""
    a = np.frombuffer(b"".join(blobs), "<i4").reshape(-1, L + 2)
    weight = (np.arange(L) >= CONTEXT) & (np.arange(L) < CONTEXT + a[:, -1:])
    return a[:, :L], a[:, 1 : L + 1], weight.astype(np.float32)


def _surroundings(single: np.ndarray):
    """For each symbol: sums of fixed random vectors of the single symbols in its windows."""
    vectors = (np.random.default_rng(5).integers(0, 2, (SINGLE + 1, SKETCH)) * 2 - 1).astype(np.int8)
    vectors[SINGLE] = 0

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_vector, sums = np.take(vectors, single, axis=0), np.zeros((len(single), SKETCH), np.int64)
        for batch in batches:
            inputs, _, _ = _unpacked(batch.column(0).to_pylist())
            around = np.zeros((len(inputs), SKETCH), np.int8)  # L at most
            for place in np.ascontiguousarray(inputs.T):
                around += np.take(own_vector, place, axis=0)
            own = inputs.reshape(-1)
            # By their low digits, then the high ones: sorts of 16 bits or fewer are quick.
            order = np.argsort(own.astype(np.uint16), kind="stable")
            order = order[np.argsort((own >> 16).astype(np.uint8)[order], kind="stable")]
            own = own[order]
            first = np.flatnonzero(np.append(True, np.diff(own) > 0))
            sums[own[first]] += np.add.reduceat(np.take(around, order // L, axis=0), first, axis=0, dtype=np.int64)
        key = np.flatnonzero(np.abs(sums).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(sums[key, i]) for i in range(SKETCH))], names=["key", *(f"v{i}" for i in range(SKETCH))])

    return of


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _halved(at: np.ndarray, x: np.ndarray, size: int) -> list[np.ndarray]:
    """Parts of so many rows: cut in halves along the direction of most variance, again and again."""
    if len(at) <= size:
        return [at]
    own = x[at] - x[at].mean(0)
    direction = np.linalg.svd(own.T @ own)[0][:, 0]
    order = at[np.argsort(own @ direction, kind="stable")]
    return _halved(order[: len(at) // 2], x, size) + _halved(order[len(at) // 2 :], x, size)


def _clusters(vectors: np.ndarray, weight: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Weighted k-means on the unit sphere, started from the heaviest rows spread by a fixed order."""
    x = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    start = np.argsort(-weight, kind="stable")[: 8 * k]
    centre = x[np.random.default_rng(9).permutation(start)[:k]]
    if len(centre) < k:
        return np.arange(len(x)) % k
    at = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        at = np.concatenate([np.argmax(x[i : i + (1 << 15)] @ centre.T, 1) for i in range(0, len(x), 1 << 15)])
        sums = np.zeros_like(centre)
        np.add.at(sums, at, x * weight[:, None])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 0, sums / np.maximum(norm, 1e-9), centre)
    return at


def grouped_classes(keys: np.ndarray, sums: np.ndarray, counts: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each symbol, and the log of its share of the class.

    keys, sums: surroundings of symbols; single: the number of a symbol that is a class, else SINGLE.
    """
    class_of = np.where(single < SINGLE, single, CLASSES - 1)
    around, symbol = np.zeros((len(counts), SKETCH)), np.arange(len(counts))
    around[keys] = sums
    other = keys[single[keys] == SINGLE]
    if len(other):
        class_of[other] = SINGLE + _clusters(around[other], counts[other].astype(float), CLASSES - SINGLE - 1)
    # Classes with like surroundings and the same part in a word share a group.
    mass = counts + 0.1
    x = np.zeros((CLASSES, SKETCH))
    np.add.at(x, class_of, around)
    last = np.bincount(class_of, mass * ((symbol & 1) | (symbol >= SYMBOLS)), CLASSES) / np.maximum(np.bincount(class_of, mass, CLASSES), 1e-9)
    parts = _halved(np.arange(CLASSES), np.concatenate([_unit(x), last[:, None]], 1), MEMBERS)
    place = np.empty(CLASSES, np.int64)
    place[np.concatenate(parts)] = np.arange(CLASSES)
    class_of = place[class_of]
    return class_of, np.log(mass / np.bincount(class_of, mass, CLASSES)[class_of])


def singles(counts: np.ndarray) -> np.ndarray:
    single = np.full(len(counts), SINGLE, np.int64)
    top = [END, *[s for s in np.argsort(-counts, kind="stable").tolist() if s != END][: SINGLE - 1]]
    single[top] = np.arange(SINGLE)
    return single


def classes(windows_: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes by the surroundings in all training windows; counts: of each symbol in the training documents."""
    single = singles(counts)
    cols = [f"v{i}" for i in range(SKETCH)]
    sums = windows_.mapInArrow(_surroundings(single), "key long, " + ", ".join(f"{c} long" for c in cols)).groupBy("key").agg(*[F.sum(c).alias(c) for c in cols]).toPandas().sort_values("key")
    return grouped_classes(sums["key"].to_numpy(np.int64), sums[cols].to_numpy(np.int64).reshape(-1, SKETCH), counts, single)


def _averaged(weights: DataFrame) -> np.ndarray:
    """The mean of all rows' vectors, weighted by n, by levels of at most 256 rows at a time."""

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].to_numpy(float)
        all_of = np.stack([np.frombuffer(x, np.float32) for x in rows["w"]])
        return pd.DataFrame({"g": [int(rows["g"].iloc[0]) // 256], "n": [int(n.sum())], "w": [(all_of * (n / n.sum())[:, None]).sum(0).astype(np.float32).tobytes()]})

    while True:
        rows = weights.orderBy("g").limit(257).collect()
        if len(rows) <= 256:
            n = np.array([r["n"] for r in rows], float)
            return (np.stack([np.frombuffer(r["w"], np.float32) for r in rows]) * (n / n.sum())[:, None]).sum(0).astype(np.float32)
        weights = written(weights.withColumn("part", F.expr("g div 256")).groupBy("part").applyInPandas(lambda p: mean(p.sort_values("g")), "g long, n long, w binary"), "lm-mean")


def _in_order(key: np.ndarray, blobs: list[bytes]) -> list[bytes]:
    """Windows sorted by key, those of one key by themselves."""
    order = np.argsort(key, kind="stable")
    out, cuts = [blobs[i] for i in order.tolist()], np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    ends = np.append(cuts[1:], len(out))
    for i, j in zip(cuts[ends - cuts > 1].tolist(), ends[ends - cuts > 1].tolist()):
        out[i:j] = sorted(out[i:j])
    return out


def fitted(windows_: DataFrame, class_of: np.ndarray) -> dict[str, np.ndarray]:
    """Rounds over the windows (part: which round, key, window), each followed by averaging the groups' weights.

    Every window is in one part of one group. The first round trains the first group's part alone, so that the groups
    start from weights that mean something; the other groups' first parts come with their second ones. So each window
    reaches a gradient once; a round with fewer than STEPS steps goes over its windows as often as makes so many.
    """
    n = windows_.count()
    w = initial()
    if not n:
        return w
    groups, leaf = max(1, round(n / GROUP)), class_of.astype(np.int16)
    grouped = windows_.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("g"), "part", "key", "window")
    join = lambda w: np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float32)

    def part(flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in SHAPES.items():
            out[k] = flat[at : at + int(np.prod(s))].reshape(s).copy()
            at += int(np.prod(s))
        return out

    for step in range(ROUNDS):
        start, rates = w, tuple(0.03 * max(0.03, 1 - r / ROUNDS) for r in (step, step + 1))

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            A.keep()
            inputs, targets, weight = _unpacked(_in_order(rows["key"].to_numpy(), rows["window"].tolist()))
            passes = -(-STEPS // -(-len(rows) // BATCH))
            out = trained(start, leaf[inputs], leaf[targets], weight, rates, passes, seed=step)
            A.trim()
            return pd.DataFrame({"g": rows["g"].iloc[:1].to_list(), "n": [len(rows)], "w": [join(out).tobytes()]})

        own = grouped.where((F.col("part") == step) | (F.lit(step == 1) & (F.col("part") == 0)))
        own = own.where("g = 0") if step == 0 else own.where("NOT (g = 0 AND part = 0)")
        if (found := written(own.groupBy("g").applyInPandas(run, "g long, n long, w binary"), "lm-weights")).head(1):
            w = part(_averaged(found))
    return w


def _held(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(words, their counts, least): all words with at least so many occurrences; HELD_WORDS or fewer of them."""
    sizes = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()}  # 64 rows at most
    least, n = 1 << 62, 0
    for p in sorted(sizes, reverse=True):
        n += sizes[p]
        if n > HELD_WORDS:
            break
        least = 1 << p
    rows = counts.where(F.col("n") >= least).toArrow()
    key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(key)
    return key[order], n[order], least


ROW = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def language_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document.

    A null or empty text is its end alone. Without training documents nothing is known: counts are 0 and the attention
    model keeps its first weights. Repeated rows are scored each; ties don't arise, as a document's score is its own.
    A null doc_id counts as the text 'None'. Very long texts are scored whole, window by window. An empty table gives
    no rows; other columns are ignored.
    """
    tune(docs.sparkSession, 8)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(own.mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = counts.where((F.col("n") >= OFTEN) & (F.col("key") != END_HASH)).orderBy(F.desc("n"), "key").limit(WHOLE).toPandas().sort_values("key")
    whole = often["key"].to_numpy(np.int64)
    gathered = written(own.mapInArrow(_gather(whole), "kind int, key long, n long, window binary").withColumn("part", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(ROUNDS)).cast("int")), "lm-gathered")
    of_symbols = np.append(np.zeros(SYMBOLS, np.int64), often["n"].to_numpy(np.int64))
    for key, n in gathered.where(F.col("kind") == SYMBOL).groupBy("key").agg(F.sum("n")).collect():  # the vocabulary at most
        of_symbols[key] = n
    chosen = gathered.where(F.col("kind") == WINDOW).select("key", "part", "window")
    class_of, share = classes(chosen.select("window"), of_symbols)
    w = fitted(chosen, class_of)
    return scored(own, counts, w, class_of, share, total, distinct, whole)


def scored(own: DataFrame, counts: DataFrame, w: dict[str, np.ndarray], class_of: np.ndarray, share: np.ndarray, total: int, distinct: int, whole: np.ndarray = NONE_WHOLE) -> DataFrame:
    """Scores of own (doc_id, text) from word counts (key, n) and a trained model.

    A document is scored where it is read; its words whose counts aren't held there are told by rows of their own: one
    for each document and word, with the spellings' log-probabilities. Counts are joined to these; no text is shuffled,
    and no key is hot, as frequent words are held.
    """
    bottom = total + 0.1 * (distinct + 1)
    # What the discounted counts leave goes to spellings.
    rest = ALPHA + (1 - ALPHA) * (DISCOUNT * distinct / total if total else 1)
    ends = counts.where(F.col("key") == END_HASH).agg(F.sum("n")).first()[0] or 0
    *held, least = _held(counts.where(F.col("key") != END_HASH))
    model = own.sparkSession.sparkContext.broadcast((*held, w, class_of, share, whole))
    seen_of = lambda n: (1 - ALPHA) * np.maximum(n - DISCOUNT, 0) / max(1, total)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        A.keep()
        keys, ns, w, class_of, share, whole = model.value
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            all_words = Words(batch.column(1), whole=whole)
            known = np.full(len(all_words.hash), -1, np.int64)  # -1: not held
            if len(keys):
                j = np.minimum(np.searchsorted(keys, all_words.hash), len(keys) - 1)
                known = np.where(keys[j] == all_words.hash, ns[j], -1)
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                words, n = all_words.part(i, i + len(some)), len(some)
                symbols, at, word = words.sequences()
                spelled = np.bincount(word, symbol_scores(w, class_of, share, symbols, at))
                count = np.full(len(spelled), ends, np.int64)
                is_end = np.zeros(len(spelled), bool)
                is_end[words.first[1:] + np.arange(n)] = True
                count[~is_end] = known[words.codes]
                open_ = count < 0
                with np.errstate(divide="ignore"):
                    mixed = np.where(open_, 0, np.logaddexp(spelled + np.log(rest), np.log(seen_of(count))))
                base = np.where(open_, 0, np.log10((np.maximum(count, 0) + 0.1) / bottom))
                first = words.first[:-1] + np.arange(n)
                sums = [np.add.reduceat(x, first) for x in ((count > 0).astype(np.int64), base, mixed / np.log(10))]
                ids = uid + np.arange(n)
                uid += n
                rows = {"uid": pa.array(ids), "doc_id": some.column(0), "held_out": pa.array(held_out(some.column(0).to_pylist())), "n_tokens": pa.array(np.diff(words.first) + 1)}
                rows |= {"n_known": pa.array(sums[0]), "base_score": pa.array(sums[1]), "score": pa.array(sums[2]), "key": pa.nulls(n, pa.int64()), "spelled": pa.nulls(n, pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(rows)
                if open_.any():
                    lacking = np.flatnonzero(open_[~is_end])
                    doc, h = np.searchsorted(words.first, lacking, side="right") - 1, words.hash[words.codes[lacking]]
                    order = np.lexsort((h, doc))
                    doc, h, logs = doc[order], h[order], spelled[~is_end][lacking[order]].astype(np.float64)
                    new = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(h) != 0)))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(h)), pa.int32()), pa.array(logs))
                    none = {c: pa.nulls(len(new), t) for c, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))}
                    yield pa.RecordBatch.from_pydict({"uid": pa.array(ids[doc[new]]), **none, "key": pa.array(h[new]), "spelled": lists})
            A.trim()

    found = written(own.mapInArrow(score, f"uid long, {ROW}, key long, spelled array<double>"), "lm-scores")
    open_ = found.where("key IS NOT NULL").select("uid", "key", "spelled")
    met = open_.join(counts.where((F.col("n") < least) & (F.col("key") != END_HASH)), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    times, seen = F.size("spelled"), F.lit((1 - ALPHA) / max(1, total)) * F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0))
    one = lambda x: F.when(F.col("n") > 0, F.log10(F.exp(x) * F.lit(rest) + seen)).otherwise((x + F.lit(float(np.log(rest)))) / F.lit(float(np.log(10))))
    more = F.aggregate("spelled", F.lit(0.0), lambda s, x: s + one(x))
    sums = met.groupBy("uid").agg(
        F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("k"), F.sum(times * F.log10((F.col("n") + 0.1) / F.lit(bottom))).alias("b"), F.sum(more).alias("s")
    )
    out = found.where("key IS NULL").join(sums, "uid", "left")
    plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "k"), F.lit(total).cast("long").alias("train_tokens"), plus("base_score", "b"), plus("score", "s"))
