"""Quality rules: gradient-boosted trees over statistics of a text.

Trees are grown in numpy on histograms of a bounded sample of labelled documents; splits that break a feature's
monotonic constraint, also against the bounds that its ancestors leave, are not taken. For scoring, all trees become
flat node arrays (feature, threshold, left, right, value), walked by all rows at once, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import tune

#: Labelled documents that the model is fitted on, at most (those with the smallest hash of their id).
SAMPLE = 20_000
#: Arrow batches; the counts hold several numbers for each byte of a batch.
BATCH_MB = 4
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
#: Model features with the sign of their constraint: -1: more of it never raises the quality.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "pipe_share": 0, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": 0, "digit_share": 0, "bang_share": 0, "words_per_line": 0, "stop_share": 0, "comma_share": 0,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Trees:
    """Flat arrays of the nodes of all trees; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability for each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.root:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 8, reg: float = 1.0) -> Trees:
    """Boosts logistic loss; signs: +1, -1 or 0 for each feature."""
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)] if n else [np.zeros(0)] * f
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(f)], 1) if n else np.zeros((0, f), int)
    prior = float(np.clip(y.mean() if n else 0.5, 0.01, 0.99))
    base = float(np.log(prior / (1 - prior)))
    nodes: list[list] = []
    raw, roots = np.full(n, base), []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + reg), low, high))

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        at = len(nodes)
        nodes.append([0, np.inf, at, at, leaf(g, h, low, high) * rate])
        best = None
        if level < depth and len(rows) >= 2 * least:
            for j in range(f):
                k = len(cuts[j]) + 1
                if k < 2:
                    continue
                own = code[rows, j]
                gl, hl, cl = (np.cumsum(np.bincount(own, w, k))[:-1] for w in (grad[rows], hess[rows], None))
                gr, hr = g - gl, h - hl
                vl, vr = np.clip(-gl / (hl + reg), low, high), np.clip(-gr / (hr + reg), low, high)
                gain = -(gl * vl + (hl + reg) * vl**2 / 2) - (gr * vr + (hr + reg) * vr**2 / 2)
                ok = (cl >= least) & (len(rows) - cl >= least) & ((vr - vl) * signs[j] >= 0)
                if ok.any() and (best is None or gain[ok].max() > best[0]):
                    t = int(np.flatnonzero(ok)[np.argmax(gain[ok])])
                    best = (gain[t], j, t, vl[t], vr[t])
            v = leaf(g, h, low, high)
            if best and best[0] - -(g * v + (h + reg) * v**2 / 2) > 1e-6:
                _, j, t, vl, vr = best
                mid = (vl + vr) / 2
                limits = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[signs[j]]
                goes = code[rows, j] <= t
                a = grow(rows[goes], grad, hess, level + 1, *limits[0])
                b = grow(rows[~goes], grad, hess, level + 1, *limits[1])
                nodes[at][:4] = [j, float(cuts[j][t]), a, b]
        return at

    for _ in range(rounds if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
        t = _arrays(nodes, [roots[-1]], depth, 0.0)
        at = np.full(n, roots[-1])
        for _ in range(depth):
            at = np.where(x[np.arange(n), t.feature[at]] <= t.threshold[at], t.left[at], t.right[at])
        raw = raw + t.value[at]
    return _arrays(nodes, roots, depth, base)


def _arrays(nodes: list[list], roots: list[int], depth: int, base: float) -> Trees:
    cols = list(zip(*nodes)) if nodes else [()] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Trees(*(np.array(c, k) for c, k in zip(cols, kinds)), np.array(roots, np.int64), depth, base)


def _repeated_words(codes: np.ndarray, window: int = 5) -> int:
    """Words inside windows of so many words that occur at least twice. Windows are compared exactly, by dense codes."""
    if len(codes) <= window:
        return 0
    _, w = np.unique(codes, return_inverse=True)
    v = int(w.max()) + 1
    if v**window < 1 << 62:
        key = np.zeros(len(w) - window + 1, np.int64)
        for k in range(window):
            key = key * v + w[k : len(w) - window + 1 + k]
    else:
        key = w
        for k in range(1, window):
            _, key = np.unique(key[: len(w) - k] * v + w[k:], return_inverse=True)
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(n[at] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and its row of model features."""
    data, at = A.buffers(column)
    starts, ends, first = A.word_spans(data, at)
    codes, _ = A.word_codes(data, starts, ends)
    kind = np.int32 if len(data) < 1 << 31 else np.int64

    def upto(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(len(mask) + 1, kind)
        np.cumsum(mask, dtype=kind, out=out[1:])
        return out

    total = lambda mask: np.diff(upto(mask)[at]).astype(np.int64)
    place = upto((data & 0xC0) != 0x80)
    chars = np.concatenate([[0], np.cumsum(place[ends] - place[starts], dtype=np.int64)])[first]
    raw, cuts = data.tobytes(), at.tolist()
    dup, lines = [], []
    for a, b in zip(cuts, cuts[1:]):
        own = [x for x in raw[a:b].split(b"\n") if x.strip(A.SPACE_BYTES)]
        dup.append(len(own) - len(set(own)))
        lines.append(len(own))
    counts = {
        "n_words": np.diff(first), "word_chars": np.diff(chars), "n_symbols": total(SYMBOLS[data]), "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": np.array([_repeated_words(codes[a:b]) for a, b in zip(first.tolist(), first[1:].tolist())], np.int64),
    }
    words, letters, lines = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1), np.maximum(lines, 1)
    short = np.concatenate([[0], np.cumsum(ends - starts <= 3)])[first]
    x = np.stack(
        [
            np.log1p(counts["n_words"]), counts["word_chars"] / words, counts["n_symbols"] / letters, total(data == 124) / words, counts["n_dup_lines"] / lines,
            counts["n_repeat_words"] / words, total((data >= 65) & (data <= 90)) / letters, total((data >= 48) & (data <= 57)) / letters, total(data == 33) / words,
            np.minimum(words / lines, 1000), np.diff(short) / words, total(data == 44) / words,
        ],
        1,
    )
    return counts, x


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 3) -> Trees:
    """Fits the model on at most so many labelled documents; labels: doc_id, quality (1: good). Without labels all pass."""
    tune(docs.sparkSession, BATCH_MB)
    own = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("double").alias("quality"))
    # At most `sample` rows of two numbers, so the side that is broadcast doesn't follow the input.
    chosen = own.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2)], names=["doc_id", "x", "quality"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    found = some.mapInArrow(rows, "doc_id long, x array<double>, quality double").groupBy("doc_id").agg(F.min_by("x", F.xxhash64("x")).alias("x"), F.first("quality").alias("quality")).toPandas().sort_values("doc_id", kind="stable")
    x = np.stack(found["x"].to_list()) if len(found) else np.zeros((0, len(FEATURES)))
    return fit(x, found["quality"].to_numpy(float), list(FEATURES.values()))


def scored(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the model's quality for each document.

    A null or empty text has no words and fails the base rule. Ties at the threshold are kept. Repeated rows are scored
    each. An empty table gives no rows; other columns are ignored.
    """
    tune(docs.sparkSession, BATCH_MB)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, x = statistics(batch.column(1))
            failed, quality = base_failed(counts), model.score(x)
            cols = [batch.column(0), *(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(~failed & (quality >= threshold)), pa.array(quality)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *COUNTS, "base_failed", "kept", "quality"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, quality double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, schema)


def kept_documents(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns; no text is shuffled.

    A null or empty text fails the base rule, so its row goes; ties at the threshold stay; repeated rows are judged
    each. An empty table gives no rows; columns of any name stay.
    """
    tune(docs.sparkSession, BATCH_MB)
    names = docs.columns
    text = F.col(names[names.index("text")]).cast("string").alias("__text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, x = statistics(batch.column(0))
            keep = ~base_failed(counts) & (model.score(x) >= threshold)
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names=names).filter(pa.array(keep))
            A.trim()

    return docs.select(text, *[F.col(c) for c in names]).mapInArrow(rows, docs.schema)
