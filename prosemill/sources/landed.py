"""Records of landed answers of community sites and of captured pages; what is landed stands in DataFrames, one row an object.

All of them leave out rows without a URL or key and take null as empty; of rows with one URL the first by its text stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import held, strip
from prosemill.operators import html, signals
from prosemill.operators.extract import top_per_key
from prosemill.operators.incremental import content_key
from prosemill.operators.report import raw_domain
from prosemill.sources.records import MAX_TEXT, MIN_POST, SHORT_TEXT, comment_tree, epoch_date, iso_date, stamp_date, untagged

#: Reactions from which on an article's comments are read; shortest comments; the tag whose articles need no telling title.
MANY_REACTIONS, MIN_COMMENT, MIN_THREAD_COMMENT, OPEN_TAG = 50, 51, 100, "migration"
ITEM_URL, ARTICLE_URL = "https://news.ycombinator.com/item?id=", "https://dev.to/article/"
#: Score from which on a question's answers are read, and how many.
MIN_SCORE, ANSWERS = 2, 3


def _empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _or(first: Column, second: Column) -> Column:
    return F.when(first != "", first).otherwise(second)


def _record(df: DataFrame, url: Column, text: Column, date: Column, segment: str, domain: Column | str, kind: str) -> DataFrame:
    host = F.lit(domain) if isinstance(domain, str) else domain
    return df.select(url.alias("url"), F.substring(text, 1, MAX_TEXT).alias("text"), date.alias("crawl_date"), F.lit(segment).alias("segment_id"), host.alias("domain"), F.lit(kind).alias("source_type"))


def _once(df: DataFrame) -> DataFrame:
    """One row a URL, that of the smallest text."""
    row = F.struct(*df.columns)
    return df.where(_empty("url") != "").groupBy("url").agg(F.min_by(row, "text").alias("__r")).select("__r.*")


def _wide(df: DataFrame, full: Column, segment: str, site: str, *more: Column | str) -> DataFrame:
    """The record shape with a full_text; full may be a column of df."""
    full = F.substring(full, 1, MAX_TEXT)
    return df.select(
        "url", F.col("url").alias("source_url"), *more, full.alias("full_text"), F.substring(full, 1, SHORT_TEXT).alias("text"), epoch_date(F.coalesce("creation_date", F.lit(0))).alias("crawl_date"),
        F.lit(segment).alias("segment_id"), F.coalesce("score", F.lit(0)).alias("score"), F.lit(f"{site}.stackexchange.com").alias("domain"),
    )


def article_records(articles: DataFrame, comments: DataFrame) -> DataFrame:
    """Records of articles and of the comments on those with many reactions.

    articles: id, url, title, description, body_markdown, body_html, published_at, created_at, tag, positive_reactions_count;
    comments: article_id, body_html. An article needs a telling title (or the open tag), and passes with its body or else
    with its description. Markup becomes spaces; character references stay.
    """
    test = lambda c: signals.source_prefilter(c, "articles")
    told = signals.title_signal(F.col("title"), X.TITLE_SIGNALS) | F.coalesce(F.col("tag") == OPEN_TAG, F.lit(False))
    body = untagged(_or(_empty("body_markdown"), _empty("body_html")))
    whole, short = (strip(F.concat(_empty("title"), F.lit("\n\n"), b)) for b in (_or(body, _empty("description")), _empty("description")))
    text = F.when(test(whole), whole).when(test(short), short)
    rows = articles.where(F.col("id").isNotNull() & told).withColumn("__text", text).where("__text IS NOT NULL")
    rows = rows.withColumns({"__url": _or(_empty("url"), F.concat(F.lit(ARTICLE_URL), F.col("id").cast("string"))), "__date": iso_date(_or(_empty("published_at"), _empty("created_at")))})
    hot = rows.where(F.col("positive_reactions_count") >= MANY_REACTIONS).groupBy(F.col("id").alias("article_id")).agg(F.min(F.struct("__url", "__date")).alias("__a"))
    said = comments.select("article_id", untagged(F.col("body_html")).alias("__text")).where((F.length("__text") >= MIN_COMMENT) & test(F.col("__text"))).join(hot, "article_id").select("__text", "__a.*")
    parts = [(rows, F.col("__url"), "devto_api"), (said, content_key(F.col("__url"), F.col("__text"), "comment_"), "devto_comments")]
    return _once(reduce(DataFrame.unionByName, [_record(d, url, F.col("__text"), F.col("__date"), segment, "dev.to", "tech_blog") for d, url, segment in parts]))


def item_records(items: DataFrame) -> DataFrame:
    """Records of the stories among items (item_id, parent_id, title, text, time, deleted, dead) and of the comments below them.

    A comment's record has its story's date and a URL made of the story's and its own text; gone items give none.
    """
    gone = F.coalesce("deleted", F.lit(False)) | F.coalesce("dead", F.lit(False))
    clean = items.withColumn("__text", untagged(F.col("text")))
    url = F.concat(F.lit(ITEM_URL), F.col("root_id").cast("string"))
    roots = clean.where("parent_id IS NULL AND item_id IS NOT NULL").select(F.col("item_id").alias("root_id"), strip(F.concat(_empty("title"), F.lit("\n\n"), F.col("__text"))).alias("__text"), epoch_date(F.coalesce("time", F.lit(0))).alias("__date"), gone.alias("__gone"))
    tree = comment_tree(items.select("item_id", "parent_id")).where("depth > 0").select("item_id", "root_id")
    said = clean.where(~gone & (F.length("__text") >= MIN_THREAD_COMMENT) & signals.source_prefilter(F.col("__text"), "items")).select("item_id", "__text").join(tree, "item_id").join(roots.where("NOT __gone").select("root_id", "__date"), "root_id")
    stories = roots.where(~F.col("__gone") & (F.length("__text") > MIN_POST))
    parts = [(stories, url, "hn_firebase_stories"), (said, content_key(url, F.col("__text")), "hn_firebase_comments")]
    return _once(reduce(DataFrame.unionByName, [_record(d, u, F.col("__text"), F.col("__date"), segment, "news.ycombinator.com", "community_discussion") for d, u, segment in parts]))


def question_records(questions: DataFrame, answers: DataFrame, site: str) -> DataFrame:
    """Records of questions (question_id, link, title, body, score, creation_date) with the best answers of those well rated.

    answers: question_id, answer_id, score, body. The test reads the question alone.
    """
    flat = lambda c: strip(F.regexp_replace(F.regexp_replace(_empty(c), r"<[^>]+>", " "), r"(?U)\s+", " "))
    # The text is made once, below the tests that read it.
    rows = held(questions.where(_empty("link") != ""), __text=F.concat(_empty("title"), F.lit("\n\n"), flat("body"))).where(signals.source_prefilter(F.col("__text"), "questions"))
    rated = rows.where(F.col("score") >= MIN_SCORE).select("question_id").distinct()
    best = top_per_key(answers.join(rated, "question_id", "left_semi"), "question_id", ANSWERS, F.desc("score"), F.col("answer_id"))
    # The list is bounded by ANSWERS.
    lists = best.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "answer_id", flat("body").alias("t")))).alias("__a"))
    whole = F.concat(F.col("__text"), F.lit(" "), F.coalesce(F.concat_ws("", F.transform("__a", lambda x: F.concat(F.lit(" "), x["t"]))), F.lit("")))
    out = _wide(rows.join(lists, "question_id", "left").withColumnRenamed("link", "url"), whole, f"stackexchange_{site}", site, "title")
    return _once(out)


def answer_records(answers: DataFrame, site: str) -> DataFrame:
    """Records of answers (url, body, score, creation_date) that are long enough and pass by whole words."""
    flat = strip(F.regexp_replace(F.regexp_replace(_empty("body"), r"<[^>]+>", " "), r"(?U)\s+", " "))
    rows = held(answers, __text=flat).where(signals.source_prefilter(F.col("__text"), "answers"))
    return _once(_wide(rows, F.col("__text"), f"se_answers_{site}", site))


def index_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Captures named by the lines of a crawl index (JSON, alone or behind key and stamp): successful HTML pages with their place."""
    found = F.from_json(F.regexp_extract(F.col(value), r"(\{.*\})\s*$", 1), "url string, timestamp string, status string, mime string, filename string, offset string, length string")
    rows = lines.select(found.alias("__c")).select("__c.*").where("url <> '' AND filename <> '' AND coalesce(status, '200') = '200' AND coalesce(mime, 'text/html') LIKE '%html%'")
    return rows.withColumns({c: F.col(c).try_cast("long") for c in ("offset", "length")}).where("offset IS NOT NULL AND length IS NOT NULL")


#: The parser of each source of captures; other sources are read as blogs.
CAPTURE_PARSERS = {"trustradius": "review", "clutch": "case_study", "generic_blog": "blog"}


def capture_records(pages: DataFrame) -> DataFrame:
    """Records of captured pages (url, timestamp, source, html): their sections by the source's parser, each tested on its own.

    A page with several sections gives URLs with a mark of the section's text.
    """
    source = F.when(_empty("source").isin(list(CAPTURE_PARSERS)), F.col("source")).otherwise("generic_blog")
    pages, parts = pages.withColumn("source", source), []
    for key, parser in CAPTURE_PARSERS.items():
        rows = html.with_section_list(pages.where(F.col("source") == key).select("url", "timestamp", "html"), parser)
        rows = rows.select("url", "timestamp", F.size("sections").alias("__n"), F.explode("sections").alias("__text")).where(signals.source_prefilter(F.col("__text"), "reviews"))
        url = F.when(F.col("__n") > 1, content_key(F.col("url"), F.col("__text"), "snippet_", 100)).otherwise(_empty("url"))
        date = F.substring(_empty("timestamp"), 1, 8)
        date = F.when(F.length(date) == 8, stamp_date(date)).otherwise(date)
        parts.append(_record(rows, url, F.col("__text"), date, f"cc_{key}", F.coalesce(raw_domain(F.col("url")), F.lit("unknown")), "tech_blog" if parser == "blog" else "case_study"))
    return _once(reduce(DataFrame.unionByName, parts))
