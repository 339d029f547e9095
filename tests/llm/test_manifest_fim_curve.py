"""Merkle proofs by coordinates, fill-in-middle and packing along a curve: against brute force, round trips and awkward tables."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))
from conftest import SF  # noqa: E402
from test_llm_queries import AWKWARD, awkward  # noqa: E402

from prosemill.llm import arrowtext as A  # noqa: E402
from prosemill.llm import curvepack, fim, merkle  # noqa: E402
from prosemill.llm.queries import QUERIES  # noqa: E402

LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)
WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("run", [lambda d: merkle.manifest_proofs(d, merkle.lower_cased(d)), lambda d: fim.digests(fim.fill_in_middle(d)), curvepack.curve_packed])
def test_empty_tables(spark, run):
    assert run(awkward(spark, [])).collect() == []


# Merkle manifest -------------------------------------------------------------------------------------------------------


def leaf_of(row, text=None):
    values = [*row[:4], row[4] if text is None else text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climbed(tree, i, digest):
    """The siblings on the way up, and the root with this digest at place i."""
    said = ""
    for level in tree[:-1]:
        run, at = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
        said += "".join(run[:at] + run[at + 1 :])
        run = run[:at] + [digest] + run[at + 1 :]
        digest, i = H("".join(run)), i // 16
    return said, digest


def proofs_by_loops(rows):
    """rows: (doc_id, source, lang, n_chars, text). Expected rows of the contract."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {s: levels([leaf_of(r) for r in by[s]]) for s in order}
    top, out = levels([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            first, digest = climbed(trees[s], i, leaf_of(r, r[4].translate(LOWER)) if hit else leaf_of(r))
            second, digest = climbed(top, k, digest)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], H(first + second), digest, digest == top[-1][0]))
    return sorted(map(repr, out))


def proofs_found(df):
    return sorted(repr(tuple(r)[:7]) for r in merkle.manifest_proofs(df, merkle.lower_cased(df)).collect())


def test_proofs_on_awkward_rows(spark):
    assert proofs_found(awkward(spark)) == proofs_by_loops([(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in AWKWARD])


@pytest.mark.parametrize("broadcast", [merkle.BROADCAST_BYTES, 20 * merkle.NODE_BYTES, 0])
def test_proofs_of_uneven_sources(spark, monkeypatch, broadcast):
    """One source holds most rows (three levels, the last run of one), 300 hold a row or two; nodes are broadcast, some or none."""
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(merkle, "RANGE", 300)
    rows = [(i, "big", "en", 3, f"Text {i}") for i in range(16 * 16 * 2 + 1)] + [(1000 + i, f"s{i % 200}", None, i, None if i % 7 == 0 else f"T{i}") for i in range(300)] + [(5000, None, "de", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("g", F.lit(1))
    assert proofs_found(df) == proofs_by_loops(rows)


def test_one_leaf_is_its_own_root(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    (row,) = merkle.manifest_proofs(df).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == H("") and row["verified"]


def test_proofs_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(repr(tuple(r)[:7]) for r in QUERIES["op11_merkle_manifest"](spark, SF).collect()) == proofs_by_loops([tuple(r) for r in docs.select(*merkle.FIELDS).collect()])


# Fill in the middle ----------------------------------------------------------------------------------------------------


def units(t):
    return re.findall("[A-Za-z]+|[^A-Za-z]", t, re.S)


def test_scan_against_patterns():
    draw = random.Random(5)
    texts = ["".join(draw.choice("abP SM<>é漢😀\n") for _ in range(draw.choice([0, 1, 2, 5, 30, 600, 2000]))) for _ in range(400)]
    texts += ["a" * 100_000, "<P>", "<P", "<<P>", "<PP>", "<P>" * 3, "", " <S>x", "é" * 1000, "<" * 511 + "M>", "x" * 510 + "<M>"]
    scan = fim.Scan(*A.buffers(pa.array(texts)))
    first = scan.units_before(scan.begins)
    n = scan.units_before(scan.ends) - first
    assert n.tolist() == [len(units(t)) for t in texts]
    assert set(scan.marked().tolist()) == {i for i, t in enumerate(texts) if re.search("<[PSM]>", t)}
    for i, t in enumerate(texts):
        at = np.cumsum([0] + [len(u.encode()) for u in units(t)])[:-1]
        assert (scan.starts(first[i] + np.arange(n[i])) - scan.begins[i]).tolist() == at.tolist()


def test_automaton_forgets_where_it_began():
    """Two bytes decide on the state: what lanes rely on."""
    step = lambda s, b: int(fim._TABLE[256 * s + b]) & 3
    letters = [ord(c) for c in "aPSM<> "] + [0x80, 0xC3, fim.APART]
    assert all(len({step(step(s, a), b) for s in range(4)}) == 1 for a in letters for b in letters)


def formed_by_loops(i, t):
    t = t or ""
    u, h = units(t), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or re.search("<[PSM]>", t) or h[2] % 100 >= 90:
        return i, len(u), "plain", None, None, t
    if h[3] % 100 < 20:
        return i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_forms_on_awkward_rows(spark):
    odd = [(100 + k, t, "en", "a") for k, t in enumerate(["<P> a", "a<S", "<", "<M>", "x<P y>", "é漢😀" * 50, "a" * 200_000, "<S" * 99, *(f"w{k} <P x>y<" for k in range(60))])]
    every = [*AWKWARD, *odd]
    rows = fim.fill_in_middle(awkward(spark, every))
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(repr(formed_by_loops(i, t)) for i, t, *_ in every)
    back = rows.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(repr((r[0], r[1])) for r in back) == sorted(repr((i, t or "")) for i, t, *_ in every)


# Packing along the curve -------------------------------------------------------------------------------------------------


def test_ids_are_those_of_whole_texts():
    draw = random.Random(3)
    parts = [*"abcSTΣσς'sŚ 　\xa0 \n\t\x85\x1c éÉ漢字12٣!?.<|>😀", "'re", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " Don't ", "İ", "ﬁ", "ẞ", "한", " ́", "é"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.choice([0, 1, 3, 10, 60]))) for _ in range(4000)]
    texts += [" " * 1_000_000, "　" * 1_000_000, "a" * 300_000, "!" * 300_000]
    ids, at = curvepack.token_ids(*A.buffers(pa.array(texts)))
    wanted = [e.ids for e in WORDS.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == wanted


def check_curve(rows, texts, capacity):
    """Pieces are the tokenizer's ids, each once; sequences have no holes, and only the last ones are short, by powers of two."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    wanted = defaultdict(list)
    for i, t in texts:
        wanted[i].append(np.array([*WORDS.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    assert set(pieces) == set(wanted)
    for i, copies in wanted.items():
        ids, found = copies[0], sorted(pieces[i])
        assert sum(x[1] for x in found) == len(ids) * len(copies)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == crc and whole == len(ids) for a, n, crc, whole in found)
        covered = np.zeros(len(ids), int)
        for a, n, *_ in found:
            covered[a : a + n] += 1
        assert (covered == len(copies)).all()
    lengths = []
    for s in sorted(sequences):
        end = 0
        for offset, length in sorted(sequences[s]):
            assert offset == end and length > 0
            end += length
        lengths.append(end)
    short = [n for n in lengths if n < capacity]
    assert max(lengths) <= capacity and lengths[len(lengths) - len(short) :] == short == sorted(short, reverse=True)
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)


def test_curve_on_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(curvepack, "RANGE", 5_000)
    rows = curvepack.curve_packed(awkward(spark), 256, 1, with_ids=True).collect()
    check_curve(rows, [(i, t) for i, t, *_ in AWKWARD], 256)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)


def test_curve_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op13_curve_packing"](spark, SF).collect()
    check_curve(rows, [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], 2048)
    # Along the sequences the keys ascend.
    order = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert all(a["hilbert"] <= b["hilbert"] for a, b in zip(order, order[1:]))


def test_rows_do_not_depend_on_ranges(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(tuple, curvepack.curve_packed(docs).collect()))
    monkeypatch.setattr(curvepack, "RANGE", 20_000)
    assert sorted(map(tuple, curvepack.curve_packed(docs.repartition(7)).collect())) == one


def test_neighbours_on_the_curve_are_alike(spark):
    """Documents of one language stand together far more often than by chance."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    lang = {r[0]: r[1] for r in docs.select("doc_id", "lang").collect()}
    rows = sorted((r for r in curvepack.curve_packed(docs).collect() if r["start"] == 0), key=lambda r: (r["sequence_id"], r["offset"]))
    same = np.mean([lang[a["doc_id"]] == lang[b["doc_id"]] for a, b in zip(rows, rows[1:])])
    chance = sum((list(lang.values()).count(v) / len(lang)) ** 2 for v in set(lang.values()))
    assert same > 0.8 and same > chance + 0.3


@pytest.mark.parametrize("total", [0, 1, 7, 8, 9, 16, 23])
def test_tails(total):
    cuts = [*curvepack.tail_cuts(total, 8), total]
    sizes = [b - a for a, b in zip(cuts, cuts[1:])]
    assert sum(sizes) == total % 8 and all(n & (n - 1) == 0 for n in sizes)


def test_merged_pieces_are_the_tokenizer_s():
    """Words of letters and marks, made of the vocabulary's own tokens and at random."""
    draw = random.Random(1)
    tokens = [t for t in (k.removesuffix("</w>") for k in WORDS.get_vocab()) if t.isascii() and t.isalpha()]
    words = ["".join(draw.choice(tokens) for _ in range(draw.randrange(1, 5))) + draw.choice(["", "", ".", "!!", "?!..", ",;:"]) for _ in range(40_000)]
    words += ["".join(draw.choice("abcdefghijklmnopqrstuvwxyzéüßÿÄ×") for _ in range(draw.randrange(1, 14))) for _ in range(20_000)]
    flat, start, length = curvepack.vocabulary().ids(pa.array([w.encode() for w in words], pa.large_binary()))
    assert curvepack.vocabulary().pieces is not None
    assert [flat[a : a + n].tolist() for a, n in zip(start, length)] == [e.ids for e in WORDS.encode_batch(words, add_special_tokens=False)]
