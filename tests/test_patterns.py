"""Folded patterns, and values that are worked out once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import any_of, bit, folded, java, java_folded, let, loose, may_hold, whole
from prosemill.operators import extract, signals
from prosemill.operators import text as T
from prosemill.plans.queries import QUERIES

TABLES = [whole(t) for t in (X.BLOCKED_URL, X.SPAM_CONTENT, X.DECISION_STEMS, X.PRODUCT_NOUNS, X.REASONING_PHRASES, X.NARRATIVE_MARKERS, X.GATE_ACTORS, X.BIO, X.BIO_OVERRIDE, X.PROMO, X.NAV_TERMS)]
TABLES += [whole(t, escape=True) for t in (X.GATE_VERBS, X.GATE_MARKERS)]
TABLES += [r"\b(?:" + "|".join(f"(?:{p})" for p in t.values()) + ")" for t in extract.LABELS.values()]


def firsts(parsed) -> set[str]:
    """Kinds of what a pattern can begin with: 'ok' for a letter or digit of ASCII, else its opcode."""
    out = set()
    for op, arg in parsed:
        name = str(op)
        if name == "AT":
            continue
        if name == "LITERAL":
            return out | {"ok" if chr(arg).isascii() and chr(arg).isalnum() else chr(arg)}
        if name == "SUBPATTERN":
            return out | firsts(arg[3])
        if name == "BRANCH":
            return out | set().union(*map(firsts, arg[1]))
        if name == "MAX_REPEAT":
            out |= firsts(arg[2])
            if arg[0]:
                return out
            continue
        if name == "IN":
            # Unicode's digits are letters' equals to \d alone, which only PROMO begins with.
            return out | {"ok" if all(str(o) == "LITERAL" and chr(a).isalnum() or str(o) == "RANGE" for o, a in arg) else str(arg)}
        return out | {name}
    return out


@pytest.mark.parametrize("pattern", TABLES)
def test_terms_begin_as_the_look_ahead_says(pattern):
    assert firsts(re._parser.parse(pattern)) - {"[(CATEGORY, CATEGORY_DIGIT)]"} == {"ok"}


def test_folded_patterns_find_what_ignoring_case_finds(spark):
    texts = ["We CHOSE it", "we choſe it", "SWİTCHED, switched", "mıgrated", "KK sla İİ chose a thing because", "İ Evaluated ſince", "échose chose", "after TESTıNG foo we", "50 % OFF 50% off sign up now", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    same = [(F.regexp_instr(F.coalesce(t, F.lit("")), F.lit(java(p))) == F.regexp_instr(folded(t), F.lit(java_folded(p)))) for p in TABLES]
    assert all(all(r) for r in df.select(*same).collect())


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_long_searches_are_made_once(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert plan(df.select(extract.centred_snippet(F.col("text")))).count("filter(") <= 2
    assert plan(df.where(any_of(F.col("text"), ["a", "b", "c"]))).count("lower(") == 1
    assert plan(signals.with_keyword_score(df)).count("lower(") == 1
    assert df.select(let(F.lit(3), lambda x: x * x)).first()[0] == 9


def test_question_texts_are_made_once(spark):
    # Of questions, of those that are rated and of answers: markup, white space and both ends, once each.
    assert plan(QUERIES["question_records"](spark, "/root/testdata/sf0.001")).lower().count("regexp_replace") <= 9


def odd_texts(n=400, seed=3):
    """Words of all tables, cut and joined by odd white space, lines, capitals and letters that fold."""
    draw = random.Random(seed)
    words = [w for t in TABLES + T.INSIDE for w in re.findall(r"[a-z]{2,}", t, re.I)] + ["50", "\u0663", "%", "\u00a9", "|", ">", "\u2022", "\u00e9", "home", "page 7"]
    phrases = ["privacy policy", "all rights reserved", "follow us", "facebook", "twitter", "skip to content", "we use cookies", "years of experience", "sign up now", "get a demo", "page 3", "about us", "we chose", "passive income online", "cookie policy"]
    gaps = [" ", " ", " ", "\n", "\n", "", "\u00a0", "\u2003", "\t", ". ", " | ", " > ", "\x1c", "\x85", "\n\n\n\n"]
    fold = str.maketrans({"s": "\u017f", "k": "\u212a", "i": "\u0130"})
    out = ["Privacy\nab\nab\nab\nab\nab\nPolicy x", "CookFollow us Facebookie policy foo\nx", "abcdefgh hoFollow us Facebookme\nzz", "a b c d", "a b c d e", " a\u00a0b c d e ", "", None]
    for _ in range(n):
        parts = [draw.choice(words if draw.random() < 0.4 else phrases) + draw.choice(gaps) for _ in range(draw.randrange(1, 14))]
        out.append("".join(draw.choice([str, str, str.title, str.upper, lambda p: p.translate(fold)])(p) for p in parts))
    return out


@pytest.mark.parametrize("gaps", [False, True])
def test_loose_patterns_miss_nothing(spark, gaps):
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string").repartition(2)
    all_of = TABLES + T.INSIDE
    got = may_hold(df, "t", "bits", all_of, gaps)
    found = [F.coalesce(F.col("t"), F.lit("")).rlike(java(p, lines=p in T.INSIDE and p != X.SOCIAL)) for p in all_of]
    missed = got.select(*[F.sum((f & ~bit(F.col("bits"), k)).cast("int")) for k, f in enumerate(found)], *[F.sum(f.cast("int")) for f in found]).first()
    assert not any(missed[: len(all_of)]) and sum(n > 0 for n in missed[len(all_of) :]) > len(all_of) // 2


def test_cleaning_where_something_was_seen_is_cleaning(spark):
    df = spark.createDataFrame(list(enumerate(odd_texts(600, 9))), "k int, text string").repartition(2)
    t, seen = F.col("text"), F.col("seen")
    bits = may_hold(df, "text", "seen", T.INSIDE, gaps=True)
    assert bits.where(~T.clean_nav(t, seen).eqNullSafe(T.clean_nav(t)) | ~T.clean_lines(t, seen).eqNullSafe(T.clean_lines(t))).count() == 0
    c = F.col("cleaned")
    reason = F.when(T.nav_noise(c), X.DROPPED["nav"]).when(T.bio_content(c), X.DROPPED["bio"]).when(T.promo_content(c), X.DROPPED["nav"])
    out = T.with_full_clean(df)
    assert out.where(~F.col("drop_reason").eqNullSafe(reason) | ~c.eqNullSafe(T.clean_lines(t))).count() == 0 and out.groupBy("drop_reason").count().count() == 3
    # Each text is looked at once before and once after it is cleaned.
    assert plan(out).count("ArrowEvalPython") == 2


def test_terms_are_looked_for_by_their_first_characters():
    assert java(X.COOKIES).startswith("(?iU)(?=[") and java_folded(whole(X.GATE_VERBS, escape=True)).startswith("(?U)(?=[acemprst][")
    assert java("a?b|c") == "(?iU)a?b|c" and java("(?:a?b|c)") == "(?iU)(?=[abc])(?:a?b|c)" and java("^a") == "(?iU)^a"
    assert loose(r"\bab\s+c\w*\b") == r"(?s)\bab[^a-z0-9]+c[^ ]*"
