"""Landed objects: nulls, empty tables, gone items, repeated URLs; shards, provenance and incremental vectors."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from prosemill.operators import report, retrieve, signals
from prosemill.sources import landed, records, sinks

SAID = "We chose the smaller tool, and our team replaced the old one because support was slow. " * 3
ARTICLE = "id long, url string, title string, description string, body_markdown string, body_html string, published_at string, created_at string, tag string, positive_reactions_count long"
ITEM = "item_id long, parent_id long, title string, text string, time long, deleted boolean, dead boolean"
QUESTION, ANSWER = "question_id long, link string, title string, body string, score long, creation_date long", "question_id long, answer_id long, score long, body string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_articles(spark):
    articles = [
        (1, None, "Why we moved", "d", None, f"<p>{SAID}</p>", None, "2024-01-02T03", None, 50),
        (2, "https://x/2", "Nothing", "d", SAID, None, "2024-02-03", None, "other", 99),
        (3, "https://x/3", None, SAID, None, None, None, None, "migration", None),
        (4, "https://x/4", "Why we moved", "short", "no sign", None, None, None, None, 5),
        (None, "https://x/5", "Why we moved", SAID, None, None, None, None, None, 60),
    ]
    comments = [(1, f"<b>{SAID}</b>"), (1, f"<b>{SAID}</b>"), (1, None), (1, "we chose"), (3, SAID), (None, SAID)]
    got = landed.article_records(spark.createDataFrame(articles, ARTICLE), spark.createDataFrame(comments, "article_id long, body_html string"))
    found = {r["url"].split("#")[0] + "#" * ("#" in r["url"]): r for r in got.collect()}
    assert sorted(found) == ["https://dev.to/article/1", "https://dev.to/article/1#", "https://x/3"] and got.count() == 3
    assert found["https://dev.to/article/1"]["text"] == f"Why we moved\n\n{SAID.strip()}" and found["https://dev.to/article/1"]["crawl_date"] == "2024-01-02"
    assert found["https://dev.to/article/1#"]["segment_id"] == "devto_comments" and found["https://x/3"]["crawl_date"] == ""


def test_items(spark):
    items = [
        (1, None, "Ask", SAID, 0, None, None), (2, 1, None, SAID + "two", 86400, None, None), (3, 2, None, SAID + "two", 1, None, None), (4, 1, None, SAID, 1, True, None), (5, 1, None, None, 1, None, None),
        (6, None, "Ask", SAID, 0, None, True), (7, 6, None, SAID, 0, None, None), (None, None, "Ask", SAID, 0, None, None),
    ]
    got = landed.item_records(spark.createDataFrame(items, ITEM)).collect()
    assert len(got) == 2 and {r["crawl_date"] for r in got} == {"1970-01-01"}
    assert {r["segment_id"] for r in got} == {"hn_firebase_stories", "hn_firebase_comments"}


def test_questions_and_answers(spark):
    questions = [(1, "https://q/1", "why not", "<p>a</p>", 2, 0), (2, "https://q/2", None, "we chose it", 1, None), (3, None, "why not", "", 5, 0), (4, "https://q/4", "off", None, 5, 0), (1, "https://q/1", "why not", "<p>a</p>", 2, 0)]
    answers = [(1, 9, 1, "third"), (1, 8, 7, "<b>first</b>"), (1, 7, 1, "second"), (1, 10, 0, "fourth"), (2, 1, 9, "unread"), (None, None, None, None)]
    got = landed.question_records(spark.createDataFrame(questions, QUESTION), spark.createDataFrame(answers, ANSWER), "x")
    assert [(r["url"], r["full_text"]) for r in got.orderBy("url").collect()] == [("https://q/1", "why not\n\na  first second third"), ("https://q/2", "\n\nwe chose it ")]
    said = [("https://a/1", f"<p>{SAID}</p>", None, None), ("https://a/2", "We chose it", 1, 1), (None, SAID, 1, 1), ("https://a/4", None, 1, 1)]
    got = landed.answer_records(spark.createDataFrame(said, "url string, body string, score long, creation_date long"), "x").collect()
    assert [(r["url"], r["text"], r["score"], r["crawl_date"]) for r in got] == [("https://a/1", SAID.strip(), 0, "1970-01-01")]


@pytest.mark.parametrize(("text", "found"), [("We chose it", True), ("we  chose", False), ("we. They chose it", False), ("awe chose", False), (None, False), ("", False)])
def test_terms_that_end_in_a_space(spark, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(signals.two_signal_regex(F.col("t"), ["chose"], ["we "], 0)).first()[0] is found


def test_captures(spark):
    page = f'<div class="review">{SAID}</div><div class="review">{SAID}again</div><div class="review">nothing of the kind, ' + "but long " * 20 + "</div>"
    pages = [("https://a/b", "20240102030405", "trustradius", page), ("https://c/d", None, None, f"<article>{SAID}</article>"), ("https://e", "2024", "clutch", None), (None, None, "clutch", page)]
    got = landed.capture_records(spark.createDataFrame(pages, "url string, timestamp string, source string, html string"))
    assert rows(got.select(F.regexp_replace("url", "_[0-9a-f]{8}$", "_"), "crawl_date", "segment_id", "domain", "source_type")) == [
        ("https://a/b#snippet_", "2024-01-02", "cc_trustradius", "a", "case_study"),
        ("https://c/d", "", "cc_generic_blog", "c", "tech_blog"),
    ]
    lines = spark.createDataFrame([('{"url": "u", "filename": "f", "offset": "1", "length": "2"}',), ("org,x)/ 2024 {bad",), ('a b {"url": "v", "filename": "f", "offset": "x", "length": "2"}',), (None,)], "value string")
    assert rows(landed.index_lines(lines).select("url", "offset", "length")) == [("u", 1, 2)]


def test_empty_tables(spark):
    none = lambda s: spark.createDataFrame([], s)
    assert landed.article_records(none(ARTICLE), none("article_id long, body_html string")).count() == 0
    assert landed.item_records(none(ITEM)).count() == 0
    assert landed.question_records(none(QUESTION), none(ANSWER), "x").count() == 0
    assert landed.capture_records(none("url string, timestamp string, source string, html string")).count() == 0
    got = report.change_report(none("t string, x double"), none("t string, x double"), "t", "x")
    assert rows(got.select("stage", "row_count")) == [("after", 0), ("before", 0)]


def test_shards_and_provenance(spark, tmp_path):
    for i in range(2):
        with gzip.open(tmp_path / f"{i}.json.gz", "wt") as f:
            json.dump([{"url": f"u{i}", "text": "t"}, {"url": f"v{i}", "text": None}], f)
    (tmp_path / "2.json.gz").write_bytes(b"no archive")
    assert rows(records.read_shards(spark, str(tmp_path)).select("url")) == [("u0",), ("u1",), ("v0",), ("v1",)]
    (tmp_path / "r.json").write_text('{"stage": "filter",\n "n": 1}')
    assert json.loads(sinks.provenance_json(spark, [str(tmp_path / "r.json"), str(tmp_path / "absent.json")], module="m")) == {"module": "m", "pipeline_stages": [{"stage": "filter", "n": 1}]}


def test_incremental_vectors(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "yyy"), (3, "b", "yyy"), (4, None, "zzzz"), (5, "c", None)], "i long, k string, t string")
    known = spark.createDataFrame([("a", [9.0]), ("a", [9.0]), (None, [7.0]), ("gone", [8.0])], "k string, embedding array<float>")
    got = retrieve.embedded_incremental(df, known, "k", "t", lambda ts: [[float(len(t))] for t in ts])
    assert rows(got.select("i", F.col("embedding")[0])) == [(1, 9.0), (2, 3.0), (3, 3.0), (4, 4.0), (5, 0.0)]


def test_flagged_rows_are_written_if_there_are_any(spark, tmp_path):
    some, none = spark.range(3), spark.range(0)
    assert sinks.write_validated(some, none, str(tmp_path / "a")) == ["validated"] and not (tmp_path / "a" / "flagged").exists()
    assert sinks.write_validated(none, some, str(tmp_path / "b")) == ["validated", "flagged"] and spark.read.parquet(str(tmp_path / "b" / "flagged")).count() == 3
