"""Fuzzy pairs within a band of places, and the rows that stay, against plain loops."""

import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from prosemill.operators import dedup
from prosemill.plans.queries import QUERIES, shared


def near_texts(n, seed=4):
    """Texts of which many are edited copies of one up to 80 places before; short, empty, null, accented and very even ones."""
    draw, out = random.Random(seed), []
    letters = "abcdefgh ijkl é漢😀"
    for k in range(n):
        if k and draw.random() < 0.5 and (old := out[max(0, k - draw.randrange(1, 80))]):
            t = list(old)
            for _ in range(draw.randrange(0, 1 + len(t) // 6)):
                at = draw.randrange(len(t))
                t[at] = draw.choice(["", draw.choice(letters), t[at] + draw.choice(letters)])
            out.append("".join(t))
        else:
            out.append(draw.choice([None, "", "a" * draw.randrange(280, 420), "".join(draw.choice(letters) for _ in range(draw.choice([1, 2, 5, 30, 200])))]))
    return out


def pairs_by_loops(texts, ahead, threshold=90.0):
    out = []
    for i, a in enumerate(texts):
        for j in range(i + 1, min(len(texts), i + ahead + 1)):
            b = texts[j]
            if a and b and 200 * min(len(a), len(b)) >= threshold * (len(a) + len(b)) and (r := dedup.indel_ratio(a, b)) >= threshold:
                out.append((i, j, round(r, 9)))
    return out


def kept_by_loops(n, pairs):
    gone = set()
    for i, j in sorted(pairs):
        if i not in gone:
            gone.add(j)
    return [i for i in range(n) if i not in gone]


@pytest.mark.parametrize("ahead", [7, 60])
def test_pairs_over_many_bands(spark, monkeypatch, ahead):
    monkeypatch.setattr(dedup, "BLOCKS", 2)
    texts = near_texts(700)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").withColumns({"band": F.lit(1), "ratio": F.lit(2)})
    found = sorted((r[0], r[1], round(r[2], 9)) for r in dedup.similar_pairs(df, "t", "i", ahead=ahead).collect())
    assert found == pairs_by_loops(texts, ahead) and len(found) > 100


@pytest.mark.parametrize("threshold", [60.0, 90.0, 100.0])
def test_bounds_lose_no_pair(threshold):
    texts = [t or "" for t in near_texts(260, 8)]
    band = dedup._Band(dedup.np.arange(len(texts)), texts, threshold)
    found = sorted((i, j, round(r, 9)) for a, b, c in band.pairs(len(texts), 999) for i, j, r in zip(a.tolist(), b.tolist(), c.tolist()))
    assert found == pairs_by_loops(texts, 999, threshold)


def test_texts_of_one_language_need_no_subsequence(monkeypatch):
    """Texts of the same syllables have bags and grams alike, but nothing else: hardly any pair gets its full LCS."""
    draw, asked = random.Random(5), []
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "or", " "]
    texts = ["".join(draw.choice(syllables) for _ in range(400))[:480] for _ in range(120)]
    texts += [t[:100] + "x" * draw.randrange(30) + t[115:] for t in texts[:20]]
    exact = dedup.indel_ratio
    want = pairs_by_loops(texts, 999)
    monkeypatch.setattr(dedup, "indel_ratio", lambda a, b: asked.append(1) or exact(a, b))
    band = dedup._Band(dedup.np.arange(len(texts)), texts, 90.0)
    found = [(i, j, round(r, 9)) for a, b, c in band.pairs(len(texts), 999) for i, j, r in zip(a.tolist(), b.tolist(), c.tolist())]
    assert sorted(found) == want and len(want) == 20 and len(asked) <= 40


@pytest.mark.parametrize("ranges", [1_000_000, 300])
def test_a_chain_of_many_rows(spark, monkeypatch, ranges):
    """Each row is like the next: every other one stays, in as many jobs as for any table."""
    n = 100_000
    monkeypatch.setattr(dedup, "RANGE", ranges * n // 1_000_000 or 1)
    rows = spark.range(n).withColumnRenamed("id", "i")
    jobs = []
    keep = shared(spark)
    pairs = spark.range(n - 1).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    out = dedup.greedy_kept(rows, pairs, "i", lambda d: jobs.append(1) or keep(d))
    assert out.where("i % 2 = 1").count() == 0 and out.count() == n // 2 and len(jobs) == 4


def test_kept_rows_of_random_pairs(spark, monkeypatch):
    draw = random.Random(2)
    pairs = sorted({(i, i + draw.randrange(1, 30)) for i in (draw.randrange(3000) for _ in range(2500))})
    monkeypatch.setattr(dedup, "RANGE", 200)
    out = dedup.greedy_kept(spark.range(3030).withColumnRenamed("id", "i"), spark.createDataFrame(pairs, "i long, j long"), "i", shared(spark))
    assert sorted(r[0] for r in out.collect()) == kept_by_loops(3030, pairs)


def test_without_pairs(spark):
    rows = spark.range(3).withColumnRenamed("id", "i")
    assert dedup.greedy_kept(rows, spark.createDataFrame([], "i long, j long"), "i", shared(spark)).count() == 3
    assert dedup.similar_pairs(spark.createDataFrame([], "i long, t string"), "t", "i").count() == 0


def test_fuzzy_documents(spark):
    """Snippets of all documents."""
    rows = sorted((r["doc_id"], r["place"], r["snippet"], r["kept"]) for r in QUERIES["fuzzy_documents"](spark, SF).collect())
    assert [r[1] for r in rows] == list(range(len(rows)))
    kept = set(kept_by_loops(len(rows), [p[:2] for p in pairs_by_loops([r[2] for r in rows], 999)]))
    assert [r[3] for r in rows] == [r[1] in kept for r in rows] and 0 < len(kept) < len(rows)
