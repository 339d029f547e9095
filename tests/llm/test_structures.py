"""The data structures by themselves, against plain versions."""

import math
import random
import resource
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from prosemill.llm import arrowtext as A
from prosemill.llm import attention as M
from prosemill.llm import graph, hilbert, htmlmain, mixing, packing, quality, simhash, substring
from prosemill.llm.exactdedup import CountingQuotientFilter
from prosemill.llm.linededup import CuckooFilter

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = ["", None, "  ", "a", "Über  ALLES\tzwei\nDrei ", "x\x0by\x0cz\r\n", "é" * 40, " lead", "trail ", "a b a b", " nbsp word "]


def test_words():
    data, at = A.buffers(pa.array(TEXTS))
    low = A.lowered(data)
    starts, ends, first = A.word_spans(low, at)
    codes, distinct = A.word_codes(low, starts, ends)
    words = [distinct[c].as_py() for c in codes.tolist()]
    wanted = [(t or "").encode().translate(A.LOWER).split() for t in TEXTS]
    assert [words[a:b] for a, b in zip(first, first[1:])] == wanted


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=200), st.integers(10, 20))
def test_quotient_filter(values, bits):
    rng = random.Random(1)
    place = {v: rng.randrange(1 << bits) for v in set(values)}
    keys = [place[v] for v in values]
    half = len(keys) // 2
    parts = []
    for own in (keys[:half], keys[half:]):
        k, n = np.unique(np.array(own, np.uint64), return_counts=True)
        parts.append(CountingQuotientFilter.from_bytes(CountingQuotientFilter.build(k, n, bits).to_bytes()))
    k, n = CountingQuotientFilter.merge(parts, bits).items()
    assert dict(zip(k.tolist(), n.tolist())) == Counter(keys)
    for part, own in zip(parts, (keys[:half], keys[half:])):
        assert all(part.count_of(x) == Counter(own)[x] for x in {*keys, 0, (1 << bits) - 1})


def test_cuckoo_filter():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    own = CuckooFilter(5000)
    own.insert(keys)
    own = CuckooFilter.from_bytes(own.to_bytes())
    assert own.contains(keys).all()
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert own.contains(others).mean() < 0.005
    own.delete(keys[:2500])
    assert own.contains(keys[2500:]).all() and own.contains(keys[:2500]).mean() < 0.01
    own.delete(keys[2500:])
    assert not own.table.any() and not own.stash


def test_full_cuckoo_filter_keeps_all():
    keys = np.arange(1, 41, dtype=np.uint64) << np.uint64(50)
    own = CuckooFilter(1)
    own.insert(keys)
    assert own.contains(keys).all() and own.stash


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 3), (4, 2)])
def test_hilbert(n, bits):
    side = 1 << bits
    grid = np.stack(np.meshgrid(*[np.arange(side)] * n, indexing="ij"), -1).reshape(-1, n)
    h = hilbert.hilbert_index(grid, bits)
    assert sorted(h.tolist()) == list(range(side**n))
    path = grid[np.argsort(h)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_roots():
    rng = random.Random(3)
    n = 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(250)]
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = graph.roots(np.array([a for a, _ in edges]), np.array([b for _, b in edges]), n)
    assert got.tolist() == label


# Packing


def test_tokens_are_those_of_the_library():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    more = ["don't  we'll\n\n  x", "<|endoftext|> a", "1234 56,7!! \t\t tab", "日本語 текст ¿qué?", "a  b  c", "\n", "x" * 3000]
    texts = [t or "" for t in TEXTS] + more
    ids, at = packing.token_ids(*A.buffers(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=300), st.integers(1, 8))
def test_best_fit(lengths, open_bins):
    """Against a plain list of open bins: the fullest that fits; the fullest closes when all are open."""
    own, free, opened = packing.BestFit(32, open_bins), {}, 0
    for n in lengths:
        at, offset = own.put(n)
        fits = [f for f in free.values() if f >= n]
        if n == 32 or not fits:
            if n < 32 and len(free) == open_bins:
                fullest = min(free.values())
                gone = next(b for b in reversed(list(free)) if free[b] == fullest and b in own_closed(own, free))
                del free[gone]
            assert (at, offset) == (opened, 0)
            opened += 1
            left = 32 - n
        else:
            assert free[at] == min(fits) and offset == 32 - min(fits)
            left = free.pop(at) - n
        if left:
            free[at] = left
        assert len(free) == own.n <= open_bins


def own_closed(own, free):
    still = {b for bins in own.free for b in bins}
    return {b for b in free if b not in still}


# Mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert mixing.targets([10, 1000, 10], [1, 2, 3]) == pytest.approx([30, 960, 30])
    assert mixing.targets([0, 0], [1, 2]) == [0, 0]
    got = mixing.targets([5, 50, 500, 5000], [1, 2, 3, 1])
    assert sum(got) == pytest.approx(5555) and all(g <= 3 * s + 1e-9 for g, s in zip(got, (5, 50, 500, 5000)))


def brute_flow(patterns, quotas, tiers):
    """The most flow, and its least cost, by trying all amounts."""
    edges = [(p, s) for p, (sources, _) in enumerate(patterns) for s in sources]
    best = (0, 0)

    def go(i, used, got):
        nonlocal best
        if i == len(edges):
            cost = sum(sum(max(0, u - t * size) for t in range(1, tiers)) for u, (_, size) in zip(used, patterns))
            best = max(best, (sum(got), -cost))
            return
        p, s = edges[i]
        for x in range(min(tiers * patterns[p][1] - used[p], quotas[s] - got[s]) + 1):
            go(i + 1, [u + x * (k == p) for k, u in enumerate(used)], [g + x * (k == s) for k, g in enumerate(got)])

    go(0, [0] * len(patterns), [0] * len(quotas))
    return best


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 2), min_size=1, max_size=2), st.integers(0, 2)), min_size=1, max_size=2), st.lists(st.integers(0, 4), min_size=3, max_size=3))
def test_min_cost_flow(patterns, quotas):
    patterns = [(tuple(sorted(s)), n) for s, n in patterns]
    given_ = mixing.min_cost_flow(patterns, quotas, 3)
    used = [sum(v for (p, _), v in given_.items() if p == k) for k in range(len(patterns))]
    got = [sum(v for (_, s), v in given_.items() if s == k) for k in range(3)]
    assert all(u <= 3 * n for u, (_, n) in zip(used, patterns)) and all(g <= q for g, q in zip(got, quotas))
    cost = sum(sum(max(0, u - t * n) for t in (1, 2)) for u, (_, n) in zip(used, patterns))
    assert (sum(got), -cost) == brute_flow(patterns, quotas, 3)


# SimHash


def test_simhash():
    text = b"one two three four five"
    h = simhash.shingle_hashes(text, 3)
    assert h.tolist() == [xxhash.xxh64_intdigest(x, 42) for x in (b"one two three", b"two three four", b"three four five")]
    want = sum((2 * sum(int(x) >> b & 1 for x in h) > 3) << b for b in range(64))
    assert simhash.simhash(h) == want
    assert simhash.shingle_hashes(b"a b", 3).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)]
    assert simhash.simhash(simhash.shingle_hashes(b"", 3)) == 0


def test_full_filter_keeps_every_key():
    """Insertions beyond the capacity go to the stash; nothing is lost, and deletions undo them."""
    keys = np.random.default_rng(6).integers(0, 1 << 63, 600, dtype=np.uint64)
    own = CuckooFilter(64)
    own.insert(keys)
    assert own.stash and own.contains(keys).all() and CuckooFilter.from_bytes(own.to_bytes()).contains(keys).all()
    own.delete(keys[100:])
    assert own.contains(keys[:100]).all() and (own.table > 0).sum() + len(own.stash) == 100


def test_every_close_pair_is_met_once():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ sum((np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64) for _ in range(k)), np.zeros(40, np.uint64)) for k in (0, 1, 2, 3, 3, 4, 5)]))
    batch = pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.array(np.arange(len(fps)))], names=["fp", "rep"])
    posted = pa.Table.from_batches(simhash._postings(iter([batch]))).combine_chunks()
    key, fp, rep = (posted.column(i).to_numpy() for i in range(3))
    order = np.argsort(key, kind="stable")
    met = Counter()
    for i, j in simhash.close_pairs(key[order], fp[order].view(np.uint64)):
        met.update(tuple(sorted(p)) for p in zip(rep[order][i].tolist(), rep[order][j].tolist()))
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    assert set(met) == want and set(met.values()) == {1}


def test_minwise_bytes_share_the_similarity():
    rng = np.random.default_rng(5)
    both = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    a, b = np.concatenate([both, rng.integers(0, 1 << 63, 100, dtype=np.uint64)]), np.concatenate([both, rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    shared = (simhash.minwise_bytes(a) == simhash.minwise_bytes(b)).mean()
    assert abs(shared - 0.8) < 0.12


# Substring


def test_long_lists_are_compared_in_full():
    """A list of over 2,048 near-copies alike in 15 bands, one of which has a band 15 of its own."""
    n = 2100
    sigs = np.zeros((n, simhash.BYTES + 8), np.uint8)
    sigs[:, 64:68] = np.arange(n, dtype="<u4").view(np.uint8).reshape(-1, 4)
    sigs[:, simhash.BYTES :] = np.arange(n, dtype="<i8").view(np.uint8).reshape(-1, 8)
    sigs[7, 60:64] = 9
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64)), pa.array([x.tobytes() for x in sigs]), pa.array(np.arange(n))], names=["key", "sig", "rep"])
    (out,) = simhash.first_pairs(85)(iter([batch]))
    a, b = (out.column(i).drop_null().to_numpy() for i in (0, 1))
    assert not graph.roots(a, b, n).any() and out.column(4).drop_null().to_pylist() == [0]
    # What these links leave apart is held against all others that are like it.
    apart = pa.array(np.where(np.arange(n) == 7, 7, 0))
    (rest,) = simhash.unlinked(85)(iter([pa.RecordBatch.from_arrays([*batch.columns, apart], names=["key", "sig", "rep", "component"])]))
    assert rest.column(1).to_pylist() == list(range(n))


def test_links_of_sets_are_those_of_brute_force():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.choice(24, int(rng.integers(14, 24)), replace=False)).astype(np.uint64) for _ in range(60)]
    part = rng.integers(0, 12, 60)
    cols = [pa.array(np.zeros(60, np.int64)), pa.array(np.arange(60)), pa.array(part), pa.array([s.tobytes() for s in sets], pa.binary())]
    (out,) = simhash.set_links(0.8)(iter([pa.RecordBatch.from_arrays(cols, names=["list", "doc", "component", "shingles"])]))
    pairs = [(i, j) for i in range(60) for j in range(i) if part[i] != part[j] and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    a, b = np.array(pairs).T
    got = graph.roots(out.column(0).to_numpy(), out.column(1).to_numpy(), 60)
    assert len(pairs) > 20 and (graph.roots(a, b, 60) == got).all() and len(set(got.tolist())) > 3


def brute_chain(x, y, k, cost):
    """Best score of a chain that ends at each match."""
    f = []
    for i in range(len(x)):
        more = [f[j] - cost * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        f.append(k + max([0, *more]))
    return f


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=30))
def test_chains(matches):
    m = sorted(matches)
    y, x = [p[0] for p in m], [p[1] for p in m]
    got = substring.chains(x, y, gap=1000)
    assert sorted(i for c in got for i in c) == list(range(len(m)))
    assert all(x[a] < x[b] and y[a] < y[b] for c in got for a, b in zip(c, c[1:]))
    score = lambda c: sum(substring.K for _ in c) - substring.COST * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(c, c[1:]))
    assert max(map(score, got)) == pytest.approx(max(brute_chain(x, y, substring.K, substring.COST)))


def test_winnowing_guarantee():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 1 << 63, 200, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    run = substring.K + substring.W - 1
    for at in range(0, 200 - run, 7):
        c = b.copy()
        c[50 : 50 + run] = a[at : at + run]
        h, doc, _ = substring.seeds(np.concatenate([a, c]), np.array([0, 200, 400]))
        assert set(h[doc == 0].tolist()) & set(h[doc == 1].tolist())


def test_align():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 31, 90, dtype=np.uint32)
    a = np.concatenate([rng.integers(0, 1 << 31, 20, dtype=np.uint32), words, rng.integers(0, 1 << 31, 20, dtype=np.uint32)])
    b = np.concatenate([rng.integers(0, 1 << 31, 5, dtype=np.uint32), words[:40], words[43:], rng.integers(0, 1 << 31, 9, dtype=np.uint32)])
    b[20] += 1
    got = substring.align(a, b, 15, 80, [(15, 15), (60, 18)])
    assert got == (20, 110, 5, 92, 86)


# Quality, language model, HTML


def test_matches_are_the_same_whatever_the_batches_are():
    """A document whose places in a list are parted by a batch's end meets the document before it, too."""
    rng = np.random.default_rng(6)
    rows = sorted((int(k), int(k), int(d), int(p), 0) for k, d, p in {tuple(rng.integers(0, (4, 12, 30)).tolist()) for _ in range(300)})
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16()]

    def found(size):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = (pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], names=["list", "h", "doc", "pos", "more"]) for part in parts)
        return sorted((tuple(r.values()) for b in substring._matches(batches) for r in b.to_pylist()), key=str)

    assert all(found(size) == found(len(rows)) for size in (1, 2, 3, 7, 50))


def test_surroundings_are_those_of_loops():
    rng = np.random.default_rng(9)
    single = np.full(M.SYMBOLS, M.SINGLE, np.int64)
    single[[5, 70_000, M.END]] = [0, 1, 2]
    windows = rng.choice([5, 4464, 5 + 65_536, 70_000, M.END], (300, M.L + 2)).astype("<i4")
    batches = [pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in part])], names=["window"]) for part in np.array_split(windows, 3)]
    vectors, want = np.random.default_rng(5).integers(0, 2, (M.SINGLE + 1, M.SKETCH)) * 2 - 1, {}
    for w in windows[:, : M.L].tolist():
        around = sum(vectors[single[x]] for x in w if single[x] < M.SINGLE)
        for x in w:
            want[x] = want.get(x, 0) + around
    (out,) = M._surroundings(single)(iter(batches))
    assert {r["key"]: [r[f"v{i}"] for i in range(M.SKETCH)] for r in out.to_pylist()} == {k: v.tolist() for k, v in want.items()}


def test_hashes_of_slices_are_xxh64():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    ends = np.cumsum([*range(70), 0, 1, 33])
    starts = np.append(0, ends[:-1])
    assert A.xxh64(data, starts, ends).tolist() == [xxhash.xxh64_intdigest(data[i:j].tobytes()) for i, j in zip(starts, ends)]
    assert not len(A.xxh64(data[:0], starts[:0], ends[:0]))


def test_packed_keys_meet_as_sorted_rows_do():
    """Keys in rows of many, in any order and any number of parts, give the matches of keys sorted one by one."""
    rng = np.random.default_rng(8)
    h, doc = rng.integers(-(1 << 62), 1 << 62, 400)[rng.integers(0, 400, 900)], rng.integers(0, 300, 900)
    h[:200] = h[0]  # dealt to lists
    cols = [h, doc, rng.permutation(900).astype(np.int32), rng.integers(0, 2, 900).astype(np.int16)]
    dealing = SimpleNamespace(value=(h[:1], np.array([4])))
    list_ = substring._listed(h, doc, *dealing.value)
    order = np.lexsort((cols[2], doc, list_))
    rows = pa.RecordBatch.from_arrays([pa.array(c[order]) for c in (list_, *cols)], names=["list", "h", "doc", "pos", "more"])
    found = lambda out: sorted((tuple(r.values()) for b in out for r in b.to_pylist()), key=str)
    for parts in (1, 3, 50):
        part = (list_.view(np.uint64) % np.uint64(parts)).astype(int)
        blobs = [(p, substring._planes([c[own] for c in cols])) for p in range(parts) for own in np.array_split(np.flatnonzero(part == p), 2)]
        batches = [pa.RecordBatch.from_arrays([pa.array([p for p, _ in blobs[i : i + 3]]), pa.array([b for _, b in blobs[i : i + 3]])], names=["part", "keys"]) for i in range(0, len(blobs), 3)]
        assert found(substring._met(dealing)(iter(batches))) == found(substring._matches(iter([rows])))


def test_alignment_of_many_chains_is_that_of_each():
    rng = np.random.default_rng(7)
    x = [rng.integers(0, 3 if i % 2 else 90, rng.integers(30, 190)).astype(np.uint32) for i in range(400)]
    y, b0, b1, d = [], [], [], []
    for own in x:
        cut, shift = int(rng.integers(0, 9)), int(rng.integers(-2, 3))
        y.append(np.where(rng.random(len(own) - cut) < 0.1, 99, own[cut:]).astype(np.uint32))
        d.append(cut + shift)
        b0.append(int(rng.integers(max(0, -d[-1]), 10)))
        b1.append(b0[-1] + int(rng.integers(6, 9)))
    at = [np.cumsum([0, *map(len, z)]) for z in (x, y)]
    b0, b1, d = map(np.array, (b0, b1, d))
    got = substring.straight(np.concatenate(x), at[0][:-1], at[0][1:], np.concatenate(y), at[1][:-1], at[1][1:], b0, b1, d)
    for i, (s, e, hits) in enumerate(zip(*got)):
        assert (s + d[i], e + d[i], s, e, hits) == substring.align(x[i], y[i], int(b0[i]), int(b1[i]), [(int(b0[i]), int(d[i]))])
    assert substring.straight(x[0], d[:0], d[:0], x[0], d[:0], d[:0], d[:0], d[:0], d[:0])[2].size == 0


def test_chains_that_are_not_aligned_to_a_passage_are_left_out():
    rng = np.random.default_rng(23)
    for n in range(substring.MOST, 62):
        for gap, rate in ((0, 0), (1, 0), (1, 0.3)):
            # Two texts share n words (one apart in a word); besides, some words near them may be equal by chance.
            wa, wb = (rng.integers(1, 10**6, 260) for _ in "ab")
            wb[90 : 90 + n] = wa[100 : 100 + n]
            wb[90 + n // 2] += gap
            chance = np.flatnonzero(rng.random(80) < rate)
            wb[90 + n + chance] = wa[100 + n + chance]
            words, first = np.concatenate([wa, wb]), np.array([0, 260, 520])
            at = np.array([103, 93])
            near = substring._around(np.arange(2), at, (words % 251 + 1).astype(np.uint8), first)
            cols = [np.array([7, 7]), np.zeros(2, np.int32), np.zeros(2, np.int32), np.zeros(2, np.int32), np.arange(2), at.astype(np.int32), np.array([-1, -1])]
            batch = pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array([x.tobytes() for x in near])], names=["list", "x", "y", "block", "doc", "pos", "label", "near"])
            found = [r for b in substring._chained(substring._compared(iter([batch])), substring.K) for r in b.to_pylist()]
            s, e, t, u, _ = substring.align(wa, wb, 93, 93 + substring.K, [(93, 10)])
            assert len(found) == 1 if u - t >= substring.MIN_WORDS else rate or not found, (n, gap, rate)
            assert [(r["a"], r["b"], r["a0"], r["b0"]) for r in found] == [(0, 1, 103, 93)] * len(found)
    # What isn't seen counts as if it matched, and so does a match of which nothing is known.
    x = np.ones((1, substring.NEAR), np.uint8)
    assert substring._reach(x, x).tolist() == [substring.ANY]


def test_monotone_trees():
    rng = np.random.default_rng(8)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 0.2 + 0.6 * (x[:, 0] < 0.5) * (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x, y, [-1, 0, 0])
    grid = np.repeat(rng.random((200, 3))[:, None], 30, 1)
    grid[:, :, 0] = np.linspace(0, 1, 30)
    p = model.score(grid.reshape(-1, 3)).reshape(200, 30)
    assert (np.diff(p, axis=1) <= 1e-12).all() and p.std() > 0.1
    assert quality.fit(np.zeros((0, 3)), np.zeros(0), [0, 0, 0]).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_repeated_words(words):
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    assert quality._repeated_words(np.array(words, np.int64)) == len(inside)


def test_gradients():
    rng = np.random.default_rng(9)
    w = {k: v + (rng.standard_normal(v.shape) * 0.1).astype(np.float32) for k, v in M.initial().items()}
    x, t = rng.integers(0, M.CLASSES, (2, 2, M.L))
    weight = (rng.random((2, M.L)) < 0.7).astype(float)
    _, g = M.gradients(w, x, t, weight)
    for k in w:
        at = np.unravel_index(int(np.argmax(np.abs(g[k]))), g[k].shape)
        up, down = {**w, k: w[k].copy()}, {**w, k: w[k].copy()}
        up[k][at] += 0.01
        down[k][at] -= 0.01
        assert (M.gradients(up, x, t, weight)[0] - M.gradients(down, x, t, weight)[0]) / 0.02 == pytest.approx(g[k][at], rel=0.02)


def test_steps_of_training_map_no_memory_anew():
    rng = np.random.default_rng(5)
    x, weight = rng.integers(0, M.CLASSES, (M.BATCH, M.L + 1)).astype(np.int16), np.ones((M.BATCH, M.L), np.float32)
    w, faults = M.initial(), lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    A.keep()
    for _ in range(3):
        M.gradients(w, x[:, :-1], x[:, 1:], weight)
    before = faults()
    for _ in range(5):
        M.gradients(w, x[:, :-1], x[:, 1:], weight)
    assert faults() - before < 2000  # over 3,000 a step if large arrays are given back


def test_windows_are_ordered_by_key_and_content():
    rng = np.random.default_rng(9)
    key, blobs = rng.integers(0, 40, 200), [rng.bytes(2) for _ in range(200)]
    assert M._in_order(key, blobs) == [b for _, b in sorted(zip(key.tolist(), blobs))]
    assert M._in_order(key[:0], []) == []


PIECES = ["a", "word", "'s", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u3000", "\u0085", "\u1680", "\u2028", "\u202f", "\u200b", "\x1f", "\x0b", "é", "漢字", "12", "!?", "<|endoftext|>", "<|endof", "text|>", "€"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join) | st.text(max_size=20), max_size=6))
def test_ids_are_those_of_the_tokenizer(texts):
    """For special tokens, mixed white space and texts side by side in a batch."""
    data, at = A.buffers(pa.array(texts, pa.string()))
    ids, first = packing.token_ids(data, at)
    assert [ids[i:j].tolist() for i, j in zip(first, first[1:])] == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_windows_score_each_symbol_once():
    lengths = [1, 5, 24, 25, 100]
    at = np.concatenate([[0], np.cumsum(lengths)])
    symbols = np.arange(at[-1]) * 2
    inputs, targets, score, doc, _ = M.windows(symbols, at)
    where = score[score >= 0]
    assert sorted(where.tolist()) == list(range(at[-1]))
    assert (targets[score >= 0] == symbols[where]).all()
    b, t = np.nonzero(score >= 0)
    before = np.where(np.isin(where, at), M.END, symbols[where - 1])
    assert (inputs[b, t] == before).all() and (t >= M.CONTEXT).all()


def test_probabilities_sum_to_one_and_ignore_the_future():
    class_of = np.arange(M.SYMBOLS) % M.CLASSES
    share = -np.log(np.bincount(class_of, minlength=M.CLASSES))[class_of]
    seq = np.array([10, 20, 30, M.END])
    total = 0.0
    every = np.arange(M.SYMBOLS)
    # All symbols as the last of many short texts with one beginning.
    texts = np.stack([np.full(M.SYMBOLS, 10), np.full(M.SYMBOLS, 20), every], 1)
    p = M.symbol_scores(M.initial(), class_of, share, texts.reshape(-1), np.arange(M.SYMBOLS + 1) * 3).reshape(-1, 3)
    total = np.exp(p[:, 2]).sum()
    assert total == pytest.approx(1, abs=1e-4)
    one = M.symbol_scores(M.initial(), class_of, share, seq, np.array([0, 4]))
    assert one[:2] == pytest.approx(p[0, :2], abs=1e-5)


def test_fast_path_is_the_model():
    x = np.random.default_rng(10).integers(0, M.CLASSES, (7, M.L))
    w = M.initial()
    assert np.abs(M.hidden(w, x) - M.forward(w, x)[0].reshape(7, M.L, M.D)[:, M.CONTEXT :].reshape(-1, M.D)).max() < 1e-4


def test_spelling_of_words_in_one_text():
    words = ["the", "can't", "'s", "\u00a0x", "x\u00a0", "\u00a0", "漢字", "a,b.c!!", "12345", "\u2003y", "thntblere"]
    ids, n = M.spelled([w.encode() for w in words * 3])
    want = [packing.encoding().encode_ordinary(" " + w) for w in words * 3]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_held_out():
    assert M.held_out([0, 1, None]).tolist() == [zlib.crc32(s) % 10 == 0 for s in (b"0", b"1", b"None")]


def test_classes_nest():
    """A class that crosses one of more pages is left out; what lies in a gap is nested there."""
    rows = [("a", 0, 9), ("b", 10, 9), ("c", 20, 9), ("n1", 2, 8), ("n2", 6, 8), ("m", 4, 7), ("x1", 8, 6), ("x2", 15, 6), ("after", 30, 5)]
    kind = {"a": 1, "b": 1, "c": 1, "n1": 2, "n2": 2, "m": 3, "x1": 4, "x2": 4, "after": 5}
    root = htmlmain.nested([{"at": at, "token": t, "class": kind[t], "pages": n, "text": 0} for t, at, n in sorted(rows, key=lambda r: r[1])])
    top = root.inside[0][0]
    assert top.tokens == ["a", "b", "c"] and [c.tokens for c in root.inside[0]] == [["a", "b", "c"], ["after"]]
    assert [c.tokens for c in top.inside[1]] == [["n1", "n2"]] and [c.tokens for c in top.inside[1][0].inside[1]] == [["m"]]
    assert ["x1", "x2"] not in [c.tokens for c in htmlmain._classes(root)]


def test_blocks():
    page = '<body><nav>menu</nav><div class="ad">buy</div><main><article><h1>A &amp; B</h1><p>one<b>two</b><br> three<p>four<ul><li>x<li>y</ul><aside>no</aside><div class="comments">no</div></article></main><footer>&copy;</footer>'
    assert htmlmain.Template(None).text(page) == "A & B\n\nonetwo three\n\nfour\n\nx\n\ny"
    assert htmlmain.Template(None).text("<script>var t='</p>';</script><p>t<!-- no --></p>") == "t"
    assert htmlmain.Template(None).text("") == ""


def test_ids_of_long_runs_of_white_space():
    """Runs that the pattern can't search in one call: the ids are those of the public tokenizer for the whole text."""
    draw, spaces = random.Random(9), [" ", "\n", " ", "　", "\r\n", "  "]
    texts = [s * 1_000_000 + t for s in spaces for t in ("", "x", "　x")] + [" " * 10_000_000 + "end", "　" * 2_000_000]
    texts += ["".join(draw.choice(["a", "b's", "<|endoftext|>", *(s * draw.choice([1, 2, 999, 1000, 1001, 1500]) for s in spaces)]) for _ in range(draw.randrange(12))) for _ in range(300)]
    ids, at = packing.token_ids(*A.buffers(pa.array(texts)))
    for t, a, b in zip(texts, at.tolist(), at[1:].tolist()):
        assert ids[a:b].tolist() == TOKENIZER.encode(t, add_special_tokens=False).ids


def test_words_of_wide_spaces_are_spelled():
    ids, lengths = M.spelled([b"one", ("　" * 1_000_000).encode(), ("x" + " " * 5000 + "y").encode(), b"two"])
    assert len(lengths) == 4 and lengths.min() > 0 and lengths.sum() == len(ids)
    alone, n = M.spelled([b"two"])
    assert ids[-n[0] :].tolist() == alone.tolist()
