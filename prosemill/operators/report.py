"""Reports: counts, distributions, coverage, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import has, whole
from prosemill.operators import signals as S


def domain(url: Column) -> Column:
    """Host without scheme and www."""
    return F.substring_index(F.regexp_replace(F.coalesce(url, F.lit("")), r"^https?://(www\.)?", ""), "/", 1)


def raw_domain(url: Column) -> Column:
    """The third part between slashes, www kept."""
    return F.try_element_at(F.split(url, "/"), F.lit(3))


def keyword_hits(scored: DataFrame) -> DataFrame:
    return scored.select(F.explode("matched_keywords").alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n_rows"))


def distribution(df: DataFrame, column: str, most: int | None = 20) -> DataFrame:
    """Counts of values, the most frequent first, ties by value."""
    out = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("n_rows"))
    return out.orderBy(F.desc("n_rows"), "value").limit(most) if most else out


def stats(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    c = F.col(column).cast("double")
    part = lambda p: F.percentile(c, p)
    values = {"mean": F.avg(c), "median": part(0.5), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c), "p25": part(0.25), "p75": part(0.75)}
    return df.agg(*[F.round(v, digits).alias(k) for k, v in values.items()])


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """The value at place n div 2 of the sorted values: the discrete median from above."""
    return df.agg(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}` DESC)").alias("upper_median"))


def signal_coverage(df: DataFrame, text: str) -> DataFrame:
    """Percentages of rows with a verb, a marker, both."""
    verb, marker = has(F.col(text), whole(X.GATE_VERBS, escape=True)), has(F.col(text), whole(X.GATE_MARKERS, escape=True))
    share = lambda c: F.bround(F.lit(100.0) * F.count_if(c) / F.greatest(F.count("*"), F.lit(1)), 1)
    return df.agg(F.count("*").alias("row_count"), share(verb).alias("pct_verb"), share(marker).alias("pct_marker"), share(verb & marker).alias("pct_both"))


def change_report(before: DataFrame, after: DataFrame, text: str, value: str) -> DataFrame:
    """A row for the rows before and one for those after (stage): counts, percentages as in signal_coverage, upper median of value.

    A stage without rows has a row of zeros.
    """
    verb, marker = S.gate_verb(F.col(text)), S.gate_marker(F.col(text))
    parts = [d.select(F.lit(s).alias("stage"), verb.alias("v"), marker.alias("m"), F.col(value).alias("x")) for s, d in (("before", before), ("after", after))]
    share = lambda c: F.bround(F.lit(100.0) * F.count_if(c) / F.count("*"), 1)
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x DESC)")
    found = parts[0].union(parts[1]).groupBy("stage").agg(
        F.count("*").alias("row_count"), share(F.col("v")).alias("pct_verb"), share(F.col("m")).alias("pct_marker"), share(F.col("v") & F.col("m")).alias("pct_both"), F.round(median, 3).alias("median"),
    )
    stages = before.sparkSession.sql("SELECT explode(array('before', 'after')) AS stage")
    return stages.join(found, "stage", "left").na.fill(0)


def rates(n_in: Column, n_out: Column, n_duplicates: Column) -> dict[str, Column]:
    base = F.greatest(n_in, F.lit(1))
    return {"duplicate_rate": F.bround(n_duplicates / base, 4), "noise_rate": F.bround((n_in - n_out) / base, 4)}


def bands(df: DataFrame, column: str, low: float = 0.4, high: float = 0.7) -> DataFrame:
    c = F.col(column)
    return df.agg(F.count_if(c < low).alias("n_low"), F.count_if((c >= low) & (c < high)).alias("n_middle"), F.count_if(c >= high).alias("n_high"))


def stratified_sample(df: DataFrame, stratum: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows of each stratum, those with the smallest md5 of the key and the seed: the same on every run."""
    order = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    # Buckets of each stratum keep their own k first, so no stratum is sorted by one task.
    out = df.withColumns({"__o": order, "__b": F.pmod(F.xxhash64(key), F.lit(64))})
    for part in (["__b", stratum], [stratum]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("__o", key))
        out = out.withColumn("__r", rank).where(F.col("__r") <= k)
    return out.drop("__o", "__b", "__r")


def stride_sample(df: DataFrame, order: str, n: int) -> DataFrame:
    """n rows at even steps in the order: each step-th, step = max(1, count div n). order numbers the rows from 0."""
    total = df.count()
    step = max(1, total // n)
    return df.where((F.col(order) % step == 0) & (F.expr(f"`{order}` div {step}") < n))


def by_drop_reason(df: DataFrame, text: str) -> DataFrame:
    return df.groupBy(S.gate_reason(F.col(text)).alias("gate_reason")).agg(F.count("*").alias("n_rows"))


def before_after(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of before that aren't in after, told by their key (a row that was only cleaned isn't dropped)."""
    return before.join(after.select(key), key, "left_anti")


def throughput(stages: DataFrame) -> DataFrame:
    """Rates of stages (stage, n_in, n_out, seconds)."""
    per_second = F.round(F.col("n_in") / F.greatest(F.col("seconds"), F.lit(1e-9)), 2)
    return stages.withColumns({"rows_per_second": per_second, "kept_share": F.bround(F.col("n_out") / F.greatest(F.col("n_in"), F.lit(1)), 4)})


def observed(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """df, with counters that Spark fills while it runs: rows, and nulls of the columns."""
    return df.observe(name, F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
