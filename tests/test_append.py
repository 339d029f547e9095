"""Appends with state: repeats within and between batches, ties, rows without a key, a batch that fails and runs again."""

import pytest
from pyspark.sql import functions as F

from prosemill.operators.incremental import read_appended
from prosemill.streaming import append

SCHEMA = "url string, at long, text string, batch_note string"


def deliver(spark, tmp_path, rows, transform=lambda s: s):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
    run(spark, tmp_path, transform)


def run(spark, tmp_path, transform=lambda s: s):
    append.append_first(spark, str(tmp_path / "in"), SCHEMA, transform, str(tmp_path / "out"), str(tmp_path / "state"), "url", ("at",)).awaitTermination()


def test_the_first_row_of_a_key_stays(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    deliver(spark, tmp_path, [("a", 2, "late", None), ("a", 1, "z", None), ("a", 1, "b", None), ("b", None, "null is last", None), ("b", 7, "b7", None), (None, 0, "x", None), ("", 0, "x", None)] + [("hot", (1 << 60) + k, str(k), None) for k in range(300)])
    deliver(spark, tmp_path, [("a", 0, "earlier, but of a later batch", None), ("c", 5, None, "n"), ("c", 5, None, "m")])

    def fails(stream):
        return stream.withColumn("text", F.when(F.col("url") == "e", F.raise_error(F.lit("stopped")).cast("string")).otherwise(F.col("text")))

    with pytest.raises(Exception, match="stopped"):
        deliver(spark, tmp_path, [("d", 1, "d", None), ("e", 1, "e", None), ("c", 0, "known", None)], fails)
    run(spark, tmp_path)
    deliver(spark, tmp_path, [("d", 0, "again", None), ("e", 0, "again", None)])
    got = sorted((r["url"], r["at"], r["text"], r["batch_note"]) for r in read_appended(spark, str(tmp_path / "out")).collect())
    assert got == [("a", 1, "b", None), ("b", 7, "b7", None), ("c", 5, None, "m"), ("d", 1, "d", None), ("e", 1, "e", None), ("hot", 1 << 60, "0", None)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_keys_are_met_by_sparks_own_state(spark, tmp_path):
    """No call to Python for each key: state is that of Spark's deduplication, and groups of keys are settled before it."""
    spark.createDataFrame([("a", 1, "b", None)], SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = append.first_of_keys(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), "url", ["at"])
    seen = stream._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in seen and "TransformWithState" not in seen


def test_first_rows_sort_what_is_there_twice():
    frame = append.pd.DataFrame({"met_key": ["b", "a", "b", "c", "a"], "order_0": [2.0, None, 1.0, None, 5.0], "row_json": list("vwxyz")})
    assert sorted(append.first_rows(frame)["row_json"]) == ["x", "y", "z"] and append.first_rows(frame[:2]) is not None
