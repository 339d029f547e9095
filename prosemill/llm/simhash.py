"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints with at most 3 differing bits share at least 5 of their 8 bytes, so among any 7 positions they
share at least 4. Postings are kept under four positional bytes at a time, for all choices of four of the first seven
positions; a pair is looked at where the first four positions that it shares among those seven meet, hence once. There
its shared positional bytes are tallied over all eight positions; pairs below the guaranteed five are out, the rest is
verified by counting bits. Equal fingerprints are one entry, and a list hands on a spanning forest, never all pairs.

For near-copies by word shingles (five words, similarity 0.8) 64 sign bits differ in about ten places, in which case no
byte is sure to be shared. There the positional bytes are those of a min-wise signature, of which two texts share the
fraction that is their similarity; the index and the tally are the same, with a looser threshold, and the verification
counts the shingles that two texts share. First the entries of a list are verified with the first one like them; then
all pairs of a list that this hasn't linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import arrowtext as A
from prosemill.llm.common import attach, checked_broadcast, only_ids, tune, written
from prosemill.llm.graph import components, roots

SEED = 42
#: Positions among which a pair within 3 bits shares SHARED bytes or more, and the index's choices of so many: a posting's
#: key has 32 bits of the fingerprint, so that lists of unlike fingerprints stay short up to billions of them.
POSITIONS, SHARED = 7, 4
CHOICES = np.array(list(combinations(range(POSITIONS), SHARED)))
MIN_SHARED, RADIUS = 5, 3


def shingle_hashes(norm: bytes, words: int) -> np.ndarray:
    """XXH64 of all runs of so many words of a text whose words are joined by single spaces; of all of it if shorter."""
    if not norm:
        return np.zeros(0, np.uint64)
    gap = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    n = len(gap) + 2 - words
    x = xxhash.xxh64_intdigest
    if n <= 1:
        return np.array([x(norm, SEED)], np.uint64)
    a, b = [0, *(gap[: n - 1] + 1).tolist()], [*gap[words - 1 :].tolist(), len(norm)]
    return np.fromiter((x(norm[i:j], SEED) for i, j in zip(a, b)), np.uint64, n)


def simhash(h: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes; 0 without hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def _normalised(column: pa.Array) -> Iterator[bytes]:
    data, at = A.buffers(column)
    low, cuts = data.tobytes().translate(A.LOWER), at.tolist()
    for a, b in zip(cuts, cuts[1:]):
        yield b" ".join(low[a:b].split())


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of each text; a text without words, or null, has 0."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(shingle_hashes(x, words)) for x in _normalised(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, fp long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under every choice of SHARED of its first POSITIONS positional bytes."""
    for batch in batches:
        fp, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        b = fp.astype("<i8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        for c, choice in enumerate(CHOICES):
            key = np.full(len(fp), c, np.int64)
            for i in choice:
                key = (key << 8) | b[:, i]
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", "fp", "rep"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of runs of whole keys from a stream sorted by its first column; keys with one row are left out."""
    held: list[np.ndarray] | None = None

    def multiple(cols):
        same = cols[0][1:] == cols[0][:-1]
        keep = np.append(same, False) | np.append(False, same)
        return [c[keep] for c in cols]

    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        if last:
            yield multiple([c[:last] for c in cols])
        held = [c[last:] for c in cols]
    if held is not None:
        yield multiple(held)


def close_pairs(key: np.ndarray, fp: np.ndarray, block: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one key that pass the tally and the verification, in blocks of rows at one distance."""
    n, d = len(key), 1
    while True:
        i = np.flatnonzero(key[d:] == key[:-d]) if d < n else np.zeros(0, np.int64)
        if not len(i):
            return
        x = fp[i] ^ fp[i + d]
        same = x.astype("<u8").view(np.uint8).reshape(-1, 8) == 0
        ok = (same.sum(1) >= MIN_SHARED) & (np.bitwise_count(x) <= RADIUS)
        i, same = i[ok], same[ok]
        # the pair's own place: the first positions that it shares
        if len(i):
            rank = np.cumsum(same[:, :POSITIONS], 1)
            of = CHOICES[key[i] >> 8 * SHARED]
            own = (np.take_along_axis(same[:, :POSITIONS], of, 1).all(1)) & (rank[np.arange(len(i)), of[:, -1]] == SHARED)
            yield i[own], i[own] + d
        d += 1


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, fp, rep in _groups(batches):
        found = list(close_pairs(key, fp.view(np.uint64)))
        if not found:
            continue
        a, b = (rep[np.concatenate([x[k] for x in found])] for k in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        low = nodes[roots(at[: len(a)], at[len(a) :], len(nodes))]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low != nodes]), pa.array(low[low != nodes])], names=["a", "b"])


def simhash_components(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most 3 bits.

    A-Z is lower-cased; words are [^\\x20\\x09-\\x0D]+; texts without words and null texts have fingerprint zero and are
    linked like any other. Equal fingerprints always link, so repeated rows and ties share a component. A null doc_id
    belongs to a component but never names it, unless it is alone (null then). An empty table gives no rows.
    """
    tune(docs.sparkSession)
    fps = written(fingerprints(docs, words), "fingerprints")
    entries = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "entries")
    posted = entries.where("rep IS NOT NULL").select("fp", "rep").mapInArrow(_postings, "key long, fp long, rep long")
    links = posted.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")
    low = components(links, "a", "b").withColumnRenamed("node", "rep")
    named = written(entries.join(low, "rep", "left").select("fp", "copies", F.coalesce("component", "rep").alias("component_id")), "named")
    return attach(fps, named, "fp", "copies", fps.count(), 32).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near-copies by five-word shingles -----------------------------------------------------------------------------------

#: Positional bytes of a signature; postings of four bytes at a time; a pair of similarity 0.8 shares 102 +- 4.5 bytes.
BYTES, BAND = 128, 4
BANDS = 16
_RNG = np.random.default_rng(20240229)
_MULTIPLY, _ADD = (_RNG.integers(0, 1 << 63, BYTES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)), _RNG.integers(0, 1 << 63, BYTES, dtype=np.uint64)


def minwise_bytes(h: np.ndarray) -> np.ndarray:
    """A byte for each position: of the smallest hash of the shingles under that position's own mixing."""
    h = np.unique(h)
    low = np.full(BYTES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 256):
        low = np.minimum(low, (h[i : i + 256, None] * _MULTIPLY + _ADD).min(0))
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def shingle_set(norm: bytes, words: int) -> tuple[np.ndarray, bytes]:
    """The distinct shingle hashes of a text in order, and eight bytes that tell the set."""
    h = np.unique(shingle_hashes(norm, words))
    return h, xxhash.xxh3_64_digest(h.astype("<u8").tobytes())


def signatures(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, sig): the positional bytes, then those that tell the set; texts with one sig have the same shingles."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingle_set(x, words) for x in _normalised(batch.column(1)))
            rows = [minwise_bytes(h).tobytes() + own for h, own in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "sig"])
            A.trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, sig binary")


def _unpacked(sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of signatures: the positional bytes, the bands, the number that tells the set."""
    all_ = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, BYTES + 8)
    bands = np.ascontiguousarray(all_[:, : BANDS * BAND]).view("<u4")
    return np.ascontiguousarray(all_[:, :BYTES]), bands, np.ascontiguousarray(all_[:, BYTES:]).view("<i8")[:, 0]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        head = _unpacked(batch.column(0).to_pylist())[1].astype(np.int64)
        for k in range(BANDS):
            yield pa.RecordBatch.from_arrays([pa.array((np.int64(k) << 32) | head[:, k]), *batch.columns], names=["key", *batch.schema.names])


PAIR = ["a", "b", "da", "db"]  # the documents, and the numbers that tell their sets


def _pairs(rep: np.ndarray, own: np.ndarray, a: list[np.ndarray], b: list[np.ndarray], keys: list[int] | None = None) -> pa.RecordBatch:
    """Rows of PAIR with the smaller document first; with keys, these follow in rows of their own."""
    x, y = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (a, b))
    x, y = np.where(rep[x] < rep[y], x, y), np.where(rep[x] < rep[y], y, x)
    x, y = x[rep[x] != rep[y]], y[rep[x] != rep[y]]
    cols, names = [pa.array(v) for v in (rep[x], rep[y], own[x], own[y])], PAIR
    if keys is not None:
        more = pa.nulls(len(keys), pa.int64())
        cols = [*(pa.concat_arrays([c, more]) for c in cols), pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(keys, pa.int64())])]
        names = [*PAIR, "key"]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _bounds(key: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = (np.flatnonzero(np.diff(key)) + 1).tolist()
    return zip([0, *cuts], [*cuts, len(key)])


def first_pairs(least: int):
    """Reads postings sorted by key and document; pairs each entry of a list with the first entry that it shares at least
    so many positional bytes with and that isn't paired itself. Lists that have other pairs are told by their keys."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sig, rep in _groups(batches):
            if not len(key):
                continue
            sigs, _, own = _unpacked(sig.tolist())
            a, b, more = [], [], []
            for i, j in _bounds(key):
                met = False
                rest = np.arange(i, j)
                while len(rest) > 1:
                    hit = (sigs[rest[1:]] == sigs[rest[0]]).sum(1) >= least
                    if hit.any():
                        met = True
                        a.append(np.full(int(hit.sum()), rest[0]))
                        b.append(rest[1:][hit])
                    rest = rest[1:][~hit]
                if met and j - i > 2:
                    more.append(int(key[i]))
            yield _pairs(rep, own, a, b, more)
        A.trim()

    return of


def _apart(component: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, int]]]:
    """Entries in the order of their components, the largest last, and (place, first place of the components after it) of
    all entries but the last component's."""
    label, size = np.unique(component, return_inverse=True, return_counts=True)[1:]
    order = np.lexsort((label, size[label]))
    cuts = (np.flatnonzero(np.diff(label[order])) + 1).tolist()
    return order, ((x, hi) for lo, hi in zip([0, *cuts], cuts) for x in range(lo, hi))


def unlinked(least: int):
    """Reads postings with components, sorted by key; of each list the entries that share at least so many positional bytes
    with one of another component. A pair counts in the first list that has it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sig, rep, component in _groups(batches):
            if not len(key):
                continue
            sigs, bands, own = _unpacked(sig.tolist())
            keep = np.zeros(len(key), bool)
            for i, j in _bounds(key):
                order, places = _apart(component[i:j])
                at = order + i
                for x, end in places:
                    hit = at[end:][(sigs[at[end:]] == sigs[at[x]]).sum(1) >= least]
                    hit = hit[(bands[hit] == bands[at[x]]).argmax(1) == key[i] >> 32]
                    keep[hit] = True
                    keep[at[x]] |= len(hit) > 0
            yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (key, rep, own, component)], names=["list", "doc", "own", "component"])
        A.trim()

    return of


def set_links(similarity: float):
    """Reads entries with their shingles, sorted by list; links those of a list that are in different components and have at
    least that similarity. One entry is held against all others at once."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, doc, component, shingles in _groups(batches):
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in _bounds(key) if len(key) else ():
                order, places = _apart(component[i:j])
                at = order + i
                sets = [np.frombuffer(x, np.uint64) for x in shingles[at].tolist()]
                first = np.cumsum([0, *map(len, sets)])
                codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
                has = np.zeros(int(first[-1]), bool)
                for x, end in places:
                    own = codes[first[x] : first[x + 1]]
                    has[own] = True
                    upto = np.append(0, np.cumsum(has[codes[first[end] :]]))
                    has[own] = False
                    shared = np.diff(upto[first[end:] - first[end]])
                    hit = np.flatnonzero(shared >= similarity * (len(own) + np.diff(first[end:]) - shared) - 1e-9)
                    a.append(np.full(len(hit), at[x]))
                    b.append(at[end:][hit])
            x, y = np.concatenate(a), np.concatenate(b)
            low = roots(x, y, len(key))
            linked = np.flatnonzero(low != np.arange(len(key)))
            yield pa.RecordBatch.from_arrays([pa.array(doc[linked]), pa.array(doc[low[linked]])], names=["a", "b"])
            A.trim()

    return of


def shingle_sets(docs: DataFrame, keys: DataFrame, words: int) -> tuple[DataFrame, int]:
    """(key, shingles, uses) of the documents that keys names, in rows of (doc, own), and bytes of such a row."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(x, words) for x in _normalised(batch.column(1))]
            told = np.frombuffer(b"".join(d for _, d in own), "<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told), pa.array([h.tobytes() for h, _ in own], pa.binary())], names=["doc", "own", "shingles"])
            A.trim()

    wanted = written(keys.groupBy(F.struct("doc", "own").alias("key")).agg(F.count("*").alias("uses")), "near-wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = only_ids(texts, wanted.select(F.col("key.doc").alias("doc_id")).distinct(), "left_semi")
    found = texts.mapInArrow(sets, "doc long, own long, shingles binary").groupBy(F.struct("doc", "own").alias("key")).agg(F.first("shingles").alias("shingles"))
    found = written(found.join(wanted, "key"), "near-shingles")
    return found, 64 + int(found.agg(F.avg(F.octet_length("shingles"))).first()[0] or 0)


def verified(docs: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b) of the pairs whose sets of shingles have at least that similarity (shared by all of both)."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(n >= similarity * (len(x) + len(y) - n) - 1e-9)
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])
        A.trim()

    keyed = pairs.select("a", "b", *[F.struct(F.col(c).alias("doc"), F.col(f"d{c}").alias("own")).alias(f"k{c}") for c in "ab"])
    found, size = shingle_sets(docs, keyed.select("ka.*").union(keyed.select("kb.*")), words)
    both, total = keyed, pairs.count()
    for side in "ab":
        both = attach(both, found.select(F.col("key").alias(f"k{side}"), F.col("shingles").alias(f"s{side}"), "uses"), f"k{side}", "uses", total, size).drop("uses")
    return both.select("a", "b", "sa", "sb").mapInArrow(similar, "a long, b long")


def near_components(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id: groups of texts linked by sets of word shingles of that similarity or more.

    Candidates are told by 128 positional bytes (standard error 0.035): pairs that share the expected number less four
    standard errors, and four bytes in a row. Each one is verified by its shingles or in one group by other links; of
    pairs at that very similarity 1 in 3,300 is no candidate (by the binomial law). A text without words is linked to nothing but other such
    texts.
    """
    tune(docs.sparkSession)
    sigs = written(signatures(docs, words), "signatures")
    entries = written(sigs.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "entries")
    p = similarity + (1 - similarity) / 256
    least = int(np.ceil(BYTES * p - 4 * np.sqrt(BYTES * p * (1 - p))))
    schema, known = ", ".join(f"{c} long" for c in PAIR), entries.where("rep IS NOT NULL")
    posted = known.select("sig", "rep").mapInArrow(_bands, "key long, sig binary, rep long")
    found = written(posted.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(first_pairs(least), f"{schema}, key long"), "near-lists")
    first = written(found.where("a IS NOT NULL").select(*PAIR).distinct(), "near-pairs")
    links = written(verified(docs, first, words, similarity), "near-links")
    # What is left: pairs of a list that no chain of links joins.
    low = components(links, "a", "b").withColumnRenamed("node", "rep")
    of = known.join(low, "rep", "left").select("sig", "rep", F.coalesce("component", "rep").alias("component"))
    posted = of.mapInArrow(_bands, "key long, sig binary, rep long, component long")
    posted = posted.join(checked_broadcast(found.where("key IS NOT NULL").select("key"), 24), "key", "left_semi")
    rest = written(posted.repartition("key").sortWithinPartitions("key").mapInArrow(unlinked(least), "list long, doc long, own long, component long"), "near-unlinked")
    if rest.head(1):
        found, size = shingle_sets(docs, rest.select("doc", "own"), words)
        rest = attach(rest.withColumn("key", F.struct("doc", "own")), found, "key", "uses", rest.count(), size).select("list", "doc", "component", "shingles")
        links = links.union(written(rest.repartition("list").sortWithinPartitions("list").mapInArrow(set_links(similarity), "a long, b long"), "near-links"))
        low = components(links, "a", "b").withColumnRenamed("node", "rep")
    named = written(entries.join(low, "rep", "left").select("sig", "copies", F.coalesce("component", "rep").alias("component_id")), "named")
    return attach(sigs, named, "sig", "copies", sigs.count(), 168).select("doc_id", "component_id")


def near_deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the one of each group of near-copies whose doc_id is the smallest; rows without a doc_id stay.

    A null or empty text has no shingles: such documents are one group. Rows that repeat the smallest doc_id all stay.
    An empty table gives no rows; columns of any name stay.
    """
    gone = written(near_components(docs).where("doc_id <> component_id").select("doc_id").distinct(), "near-dropped")
    return only_ids(docs, gone, "left_anti")
