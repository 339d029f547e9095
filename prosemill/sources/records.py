"""Record readers and normalisers: files, landed API answers, unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.functions.patterns import strip
from prosemill.operators.report import raw_domain

RECORD = "url string, text string, crawl_date string, segment_id string, cc_index string, fetch_timestamp string"
MAX_TEXT = 8000


def epoch_date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def iso_date(value: Column) -> Column:
    return F.substring(value, 1, 10)


def stamp_date(value: Column) -> Column:
    """yyyyMMdd... as yyyy-MM-dd."""
    return F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))


def community_record(df: DataFrame, url: Column, text: Column, date: Column, segment: str) -> DataFrame:
    """url, text (the first 8000 characters), crawl_date, segment_id, domain, source_type."""
    return df.select(
        F.coalesce(url, F.lit("")).alias("url"), F.substring(F.coalesce(text, F.lit("")), 1, MAX_TEXT).alias("text"), F.coalesce(date, F.lit("")).alias("crawl_date"),
        F.lit(segment).alias("segment_id"), F.coalesce(raw_domain(url), F.lit("")).alias("domain"), F.lit("community").alias("source_type"),
    )


def read_licensed(spark: SparkSession, folder: str) -> DataFrame:
    """CSV, JSON and JSON-lines files of a folder, as raw records; rows without a text are left out."""
    name = F.col("_metadata.file_name")
    parts = []
    for pattern, read in (("*.csv", lambda r: r.option("header", True).option("multiLine", True).option("escape", '"').csv), ("*.json", lambda r: r.option("multiLine", True).json), ("*.jsonl", lambda r: r.json)):
        df = read(spark.read.schema("text string, url string, date string").option("pathGlobFilter", pattern))(folder)
        stem = F.regexp_replace(name, r"\.[^.]*$", "")
        parts.append(df.select(F.coalesce("url", F.concat(F.lit("licensed:"), name)).alias("url"), "text", F.coalesce("date", F.lit("")).alias("crawl_date"), F.concat(F.lit("licensed_"), stem).alias("segment_id")))
    return reduce(DataFrame.unionByName, parts).where(strip(F.coalesce(F.col("text"), F.lit(""))) != "")


def multi_source_union(sources: list[DataFrame]) -> DataFrame:
    """All sources, missing columns null; the first source that has a URL keeps it, in the given order."""
    ranked = [s.withColumn("__source", F.lit(i)) for i, s in enumerate(sources)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    keyed = both.where("coalesce(url, '') <> ''").groupBy("url").agg(F.min_by(F.struct(*both.columns), F.struct("__source", F.xxhash64("text"))).alias("__r")).select("__r.*")
    return keyed.unionByName(both.where("coalesce(url, '') = ''")).drop("__source")


def answered(questions: DataFrame, answers: DataFrame, k: int = 3, min_score: int = 2) -> DataFrame:
    """Questions (question_id, text) with the texts of their k best answers (question_id, answer_id, score, text) of enough score."""
    from prosemill.operators.extract import top_per_key

    best = top_per_key(answers.where(F.col("score") >= min_score), "question_id", k, F.desc("score"), F.col("answer_id"))
    # The list is bounded by k.
    lists = best.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "answer_id", "text"))).alias("a"))
    out = questions.join(lists, "question_id", "left")
    return out.withColumn("text", F.concat_ws("\n\n", "text", F.transform("a", lambda x: x["text"]))).drop("a")


def comment_tree(items: DataFrame, depth: int = 3, most: int = 50) -> DataFrame:
    """Items (item_id, parent_id) below the roots (no parent), to a depth, at most so many children of each: id, root_id, depth."""
    from prosemill.operators.extract import top_per_key

    level = items.where("parent_id IS NULL").select("item_id", F.col("item_id").alias("root_id"), F.lit(0).alias("depth"))
    out, kids = level, top_per_key(items.where("parent_id IS NOT NULL"), "parent_id", most, F.col("item_id"))
    for d in range(1, depth + 1):
        level = kids.join(level.select(F.col("item_id").alias("parent_id"), "root_id"), "parent_id").select("item_id", "root_id", F.lit(d).alias("depth"))
        out = out.union(level)
    return out


#: Bodies that say that an item is gone; shortest text of a post; how much of an expansion record is its text.
GONE = ("", "[deleted]", "[removed]")
MIN_POST, SHORT_TEXT = 50, 2000
FORUM = "https://www.reddit.com"


def _post(title: Column, body: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), body))


def forum_posts(posts: DataFrame, segment: str = "reddit_api") -> DataFrame:
    """Records of landed posts (id, title, selftext, body, permalink, subreddit, created_utc); short ones are left out."""
    first = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("selftext", "body")], F.lit(""))
    text = _post(F.col("title"), F.when(first.isin(*GONE), F.lit("")).otherwise(first))
    link = F.concat(F.lit(FORUM), F.when(F.coalesce("permalink", F.lit("")) != "", F.col("permalink")).otherwise(F.concat(F.lit("/r/"), F.coalesce("subreddit", F.lit("")), F.lit("/comments/"), F.coalesce("id", F.lit("")), F.lit("/"))))
    out = posts.select(
        link.alias("url"), F.substring(text, 1, MAX_TEXT).alias("text"), epoch_date(F.coalesce("created_utc", F.lit(0))).alias("crawl_date"), F.lit(segment).alias("segment_id"),
        F.lit("www.reddit.com").alias("domain"), F.lit("community_discussion").alias("source_type"), F.coalesce("subreddit", F.lit("reddit")).alias("subreddit"), F.length(text).alias("__n"),
    )
    return out.where(F.col("__n") >= MIN_POST).drop("__n")


def untagged(body: Column) -> Column:
    """Markup as spaces, if there is any."""
    body = F.coalesce(body, F.lit(""))
    return F.when(body.contains("<") & body.contains(">"), strip(F.regexp_replace(F.regexp_replace(body, r"<[^>]+>", " "), r"(?U)\s+", " "))).otherwise(body)


def expansion_records(items: DataFrame, segment: str, domain: str) -> DataFrame:
    """Records of the second shape from items (url, title, body, created): full_text of 8000 characters and a text of 2000."""
    full = F.substring(F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), untagged(F.col("body"))), 1, MAX_TEXT)
    return items.select(
        "url", F.col("url").alias("source_url"), "title", full.alias("full_text"), F.substring(full, 1, SHORT_TEXT).alias("text"),
        epoch_date(F.coalesce("created", F.lit(0))).alias("crawl_date"), F.lit(segment).alias("segment_id"), F.lit(domain).alias("domain"),
    )


def best_text(df: DataFrame) -> Column:
    """full_text where a record has one, else its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.when(F.coalesce("full_text", F.lit("")) != "", F.col("full_text")).otherwise(text) if "full_text" in df.columns else text


def alive(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose body isn't a mark of deletion."""
    return df.where(~strip(F.coalesce(F.col(text), F.lit(""))).isin(*GONE))


def engaged(df: DataFrame, floors: dict[str, int], every: bool = True) -> DataFrame:
    """Rows that reach all (or any) of the floors, a column's least value each; null counts as 0."""
    tests = [F.coalesce(F.col(c), F.lit(0)) >= n for c, n in floors.items()]
    return df.where(reduce(lambda a, b: a & b if every else a | b, tests))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each, compressed or not."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_shards(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """All records of a folder of shards (one JSON array each, compressed or not); files that can't be read are skipped."""
    spread = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True)
    return spread.json(path)


def engagement_top(df: DataFrame, k: int, points: str = "points", comments: str = "num_comments", tie: str = "item_id") -> DataFrame:
    """The k rows with the largest points * (comments + 1)."""
    return df.withColumn("engagement", F.col(points) * (F.col(comments) + 1)).orderBy(F.desc("engagement"), tie).limit(k)
