"""The vector index against brute force."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from prosemill.operators import retrieve, vectors
from prosemill.plans.queries import QUERIES


def clustered(spark, n=3000, dim=16, hot=0, seed=3):
    """Unit vectors about 40 centres; hot of them are one vector."""
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((40, dim))[draw.integers(0, 40, n)] + 0.4 * draw.standard_normal((n, dim))
    x[:hot] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")


def asked(rows, step):
    return rows.where(f"vec_id % {step} = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))


def test_recall_and_exact_scores(spark, tmp_path):
    x, rows = clustered(spark)
    vectors.write_index(rows.withColumn("cell", F.lit(9)), str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i/vectors")).select("vec_id").distinct().count() == len(x)
    found = vectors.search(spark, str(tmp_path / "i"), asked(rows, 20), 10, -1.0)
    wanted = retrieve.top_k_each(rows, asked(rows, 20), 10, -1.0)
    report = vectors.recall(found, wanted).first()
    assert (report["n_queries"], report["n_wanted"]) == (150, 1500) and report["recall"] >= 0.9
    x32 = x.astype(np.float32).astype(np.float64)
    assert all(abs(r["similarity"] - x32[r["query_id"]] @ x32[r["vec_id"]]) < 1e-9 for r in found.collect())


def test_all_cells_give_brute_force(spark, tmp_path, monkeypatch):
    """With many blocks and parts, in a table where a third of the vectors are one; ties go to the smaller id."""
    for name, value in (("BLOCK", 100), ("QUERIES", 8), ("RESCORED", 8)):
        monkeypatch.setattr(vectors, name, value)
    _, rows = clustered(spark, 1200, 16, 400)
    vectors.write_index(rows, str(tmp_path / "i"), cells=10)
    assert spark.read.parquet(str(tmp_path / "i/cells")).agg(F.max("blocks")).first()[0] >= 4
    found = vectors.search(spark, str(tmp_path / "i"), asked(rows, 30), 5, 0.3, probes=10)
    wanted = retrieve.top_k_each(rows, asked(rows, 30), 5, 0.3, block=7)
    key = lambda d: sorted((r["query_id"], r["rank"], round(r["similarity"], 6)) for r in d.collect())
    assert key(found) == key(wanted)


def test_awkward_tables(spark, tmp_path):
    schema = "vec_id long, embedding array<float>"
    for name, data in (("none", []), ("null", [(1, None)]), ("one", [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None)])):
        rows = spark.createDataFrame(data, schema)
        vectors.write_index(rows, str(tmp_path / name))
        got = vectors.search(spark, str(tmp_path / name), asked(rows, 1), 3, 0.5).collect()
        assert len(got) == (3 if name == "one" else 0)


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_queries_in_blocks(spark, block):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    key = lambda d: sorted((r["query_id"], r["rank"], r["vec_id"], round(r["similarity"], 9)) for r in d.collect())
    assert key(retrieve.top_k_each(rows, asked(rows, 100), 4, 0.1, block=block)) == key(retrieve.top_k_each(rows, asked(rows, 100), 4, 0.1))


def test_index_query(spark):
    got = QUERIES["vector_index_search"](spark, SF.replace("0.001", "0.1")).collect()
    rows = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/embeddings.parquet")
    wanted = {(r["query_id"], r["vec_id"]) for r in retrieve.top_k_each(rows, asked(rows, 100), 10, 0.0).collect()}
    assert len(wanted & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * len(wanted)
