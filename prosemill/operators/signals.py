"""Row predicates and scores: prefilters, URL classes, keyword scores, the narrative gate, the passage filter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import alternation, any_of, bit, has, held, java, let, may_hold, whole
from prosemill.operators import text as T


def keyword_prefilter(text: Column, keywords: list[str] = X.PREFILTER, at_least: int = 0) -> Column:
    return any_of(text, keywords) & (F.length(F.coalesce(text, F.lit(""))) >= at_least)


def two_signal_prefilter(text: Column, decision: list[str] = X.TWO_SIGNAL_DECISION, actor: list[str] = X.TWO_SIGNAL_ACTOR, at_least: int = 80) -> Column:
    return (F.length(F.coalesce(text, F.lit(""))) >= at_least) & any_of(text, decision) & any_of(text, actor)


def two_signal_regex(text: Column, decision: list[str], actor: list[str], at_least: int = 80) -> Column:
    return (F.length(F.coalesce(text, F.lit(""))) >= at_least) & has(text, whole(decision)) & has(text, whole(actor))


def source_prefilter(text: Column, source: str) -> Column:
    """The two-signal test of a source: substrings or whole words, as its table says; without terms of acting, one signal."""
    if source in X.REGEX_PREFILTERS:
        at_least, decision, actor = X.REGEX_PREFILTERS[source]
        return two_signal_regex(text, decision, actor, at_least)
    at_least, decision, actor = X.PREFILTERS[source]
    return two_signal_prefilter(text, decision, actor, at_least) if actor else keyword_prefilter(text, decision, at_least)


def title_signal(title: Column, patterns: list[str]) -> Column:
    return has(title, alternation(patterns))


def blocked_url(url: Column) -> Column:
    """Empty and null URLs are never blocked."""
    return has(F.lower(url), whole(X.BLOCKED_URL))


def spam_content(text: Column) -> Column:
    return has(text, whole(X.SPAM_CONTENT))


def docs_url(url: Column) -> Column:
    return has(url, alternation(X.DOCS_URL))


def source_modifier(url: Column) -> Column:
    """+4 for telling pages and domains, else -4 for product and job pages, else 0."""
    high = has(url, alternation(X.HIGH_URL)) | has(url, alternation(X.HIGH_DOMAIN))
    return F.when(high, X.SOURCE_BONUS).when(has(url, alternation(X.LOW_URL)), -X.SOURCE_BONUS).otherwise(0)


def cooccurrence(text: Column) -> Column:
    return has(text, whole(X.DECISION_STEMS)) & has(text, whole(X.PRODUCT_NOUNS))


def _present(low: Column, keyword: str) -> Column:
    k = keyword.lower()
    # A substring is looked for first: it settles nearly all texts without a pattern.
    return low.contains(k) if " " in k else low.contains(k) & low.rlike(java(whole([k], escape=True), ignore_case=False))


def with_keyword_score(df: DataFrame, weights: dict[str, int] = X.WEIGHTED, text: str = "text", maybe: Column | None = None) -> DataFrame:
    """Adds score (sum of weights of present keywords) and matched_keywords (in the table's order).

    A keyword with a space is a substring, any other a whole word. Each is looked for once: the score is summed from
    the array of those present. Where maybe is false, none is there.
    """
    found = lambda low: F.array_compact(F.array(*[F.when(_present(low, k), F.struct(F.lit(k).alias("k"), F.lit(w).alias("w"))) for k, w in weights.items()]))
    all_found = let(F.lower(F.coalesce(F.col(text), F.lit(""))), found)
    if maybe is not None:
        all_found = F.when(maybe, all_found).otherwise(F.array().cast("array<struct<k:string,w:int>>"))
    out = held(df, __found=all_found)
    score = F.aggregate("__found", F.lit(0), lambda n, x: n + x["w"])
    return out.withColumns({"score": score, "matched_keywords": F.transform("__found", lambda x: x["k"])}).drop("__found")


def gate_verb(text: Column) -> Column:
    return has(text, whole(X.GATE_VERBS, escape=True))


def gate_marker(text: Column) -> Column:
    return has(text, whole(X.GATE_MARKERS, escape=True))


def gate_actor(text: Column) -> Column:
    return has(text, whole(X.GATE_ACTORS))


def gate_reason(text: Column) -> Column:
    """'passed', or what is missing first: verb, marker, actor."""
    return F.when(~gate_verb(text), X.DROPPED["verb"]).when(~gate_marker(text), X.DROPPED["marker"]).when(~gate_actor(text), X.DROPPED["actor"]).otherwise(X.DROPPED[None])


def passage_filter(df: DataFrame, weights: dict[str, int] = X.WEIGHTED, min_score: int = X.MIN_SCORE, text: str = "text", url: str = "source_url", gate: bool = True) -> DataFrame:
    """Scored passages of records (text, source_url, ...): cheap tests first, page tests before sentences are exploded.

    The cleaned text is made once, below the tests that read it; score is the raw score,
    while the test uses the score with the source's modifier.
    """
    seen, n = F.col("__seen"), len(T.INSIDE)
    # Keywords beyond ASCII may be folded otherwise than lower() has them: then any text may hold one.
    keyword = alternation([re.escape(k) for k in weights]) if weights and all(k.isascii() for k in weights) else ""
    out = may_hold(df.where(~blocked_url(F.col(url))), text, "__seen", [*T.INSIDE, whole(X.SPAM_CONTENT), keyword], gaps=True)
    out = out.where(~(bit(seen, n) & spam_content(F.col(text))))
    out = held(out, __clean=T.clean_nav(F.col(text), seen)).where(F.length("__clean") >= 80)
    # A deleted link cluster may make a keyword of what is around it.
    out = with_keyword_score(out, weights, "__clean", bit(seen, n + 1) | bit(seen, 1)).drop("__seen").where(F.col("score") + source_modifier(F.col(url)) >= min_score)
    if gate:
        out = out.where(cooccurrence(F.col("__clean")))
    out = out.withColumn("is_docs_page", docs_url(F.col(url)))
    return T.context_windows(out, list(weights), "__clean", gate=gate).drop("__clean")
