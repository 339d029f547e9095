"""Cleaning, truncation and sentence windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import any_of, bit, has, held, hits, java, let, may_hold, strip, whole

NAV = whole(X.NAV_TERMS)
#: What cleaning looks for inside lines, in the order of the bits that tell where it may be found.
INSIDE = [X.FOOTER, X.SOCIAL, X.SKIP_LINK, X.COOKIES, NAV]


def _without(text: Column, pattern: str, ignore_case: bool = False, lines: bool = True) -> Column:
    return F.regexp_replace(text, java(pattern, ignore_case, lines), "")


def _guarded(text: Column, mark: str, pattern: str) -> Column:
    """Patterns with nested repetition only start on lines that hold their separator."""
    return _without(text, f"^(?=[^\n]*{mark})" + pattern.removeprefix("^"))


def _where_seen(out: Column, seen: Column | None, bits: int, deleted) -> Column:
    """deleted of a text where one of these bits of INSIDE is set, or where nothing was looked at; else the text.

    Only a link cluster is deleted from the middle of a line, so that what is left may make a new word: with its bit, all are searched for.
    """
    return deleted(out) if seen is None else let(out, lambda o: F.when(seen.bitwiseAND(F.lit(bits | 2)) != 0, deleted(o)).otherwise(o))


def clean_nav(text: Column, seen: Column | None = None) -> Column:
    """Deletes menus, breadcrumbs, clusters of short lines, footers, link clusters, skip links and cookie notices.

    seen has the bits of may_hold(..., INSIDE, gaps=True), if they are known.
    """
    out = F.coalesce(text, F.lit(""))
    out = _guarded(out, "[|/•·]", X.MENU)
    out = _guarded(out, ">", X.BREADCRUMB)
    # Possessive: the greedy form recurses once for each line. Nothing follows the group, so both match the same.
    out = _without(out, X.SHORT_LINES + "+")

    def inside(out: Column) -> Column:
        out = _without(out, X.FOOTER, True)
        out = _without(out, X.SOCIAL, True, False)
        out = _without(out, X.SKIP_LINK, True)
        return _without(out, X.COOKIES, True, False)

    out = _where_seen(out, seen, 1 | 4 | 8, inside)
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def _is_nav_line(short: Column) -> Column:
    """Of a stripped line. Long lines are settled by their length."""
    length = F.aggregate(F.regexp_extract_all(short, F.lit(java(NAV)), F.lit(0)), F.lit(0), lambda n, m: n + F.length(m))
    return (F.length(short) < 40) & let(length, lambda n: (n > 0.5 * F.length(short)) & (n > 0))


def clean_lines(text: Column, seen: Column | None = None) -> Column:
    """Deletes navigation structures, then short lines that are mostly navigation terms; collapses white space. seen as in clean_nav."""
    out = F.coalesce(text, F.lit(""))
    out = _guarded(out, "[|/•·]", X.PIPE_MENU)
    out = _guarded(out, ">", X.BREADCRUMB)
    out = _without(out, X.SHORT_LINES + "+")
    out = _where_seen(out, seen, 1, lambda o: _without(_without(o, X.FOOTER, True), X.SOCIAL, True, False))

    def told(out: Column) -> Column:
        # The stripped line is made once, beside the line itself.
        lines = F.transform(F.split(out, "\n"), lambda line: F.struct(line.alias("line"), strip(line).alias("short")))
        return F.array_join(F.transform(F.filter(lines, lambda x: ~_is_nav_line(x["short"])), lambda x: x["line"]), "\n")

    out = _where_seen(out, seen, 16, told)
    out = F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"[ \t]+", " ")
    return strip(out)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S+"))


def few_words(text: Column) -> Column:
    """Fewer than five words; no more of the text is read."""
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)\A\s*+(?:\S++\s++){4}\S")


def nav_noise(text: Column, threshold: float = 0.5) -> Column:
    """Fewer than five words, or more than this share of them navigation terms."""
    # Words are counted once.
    return let(word_count(text), lambda words: (words < 5) | (hits(text, NAV) > threshold * words))


def bio_content(text: Column) -> Column:
    return has(text, whole(X.BIO)) & ~has(text, whole(X.BIO_OVERRIDE))


def bio_dropped(text: Column) -> Column:
    """Biography or job text without a first-person phrase that readmits it."""
    return bio_content(text) & ~any_of(text, X.FIRST_PERSON)


def promo_content(text: Column) -> Column:
    return hits(text, whole(X.PROMO)) >= 2


def with_full_clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds cleaned and drop_reason (null: keep). Promotion is reported as navigation noise."""
    out = held(may_hold(df, text, "__seen", INSIDE, gaps=True), cleaned=clean_lines(F.col(text), F.col("__seen"))).drop("__seen")
    c, seen = F.col("cleaned"), F.col("__seen")
    out = may_hold(out, "cleaned", "__seen", [NAV, whole(X.BIO), whole(X.PROMO)])
    noise = F.when(bit(seen, 0), nav_noise(c)).otherwise(few_words(c))
    reason = F.when(noise, X.DROPPED["nav"]).when(bit(seen, 1) & bio_content(c), X.DROPPED["bio"]).when(bit(seen, 2) & promo_content(c), X.DROPPED["nav"])
    return held(out, drop_reason=reason).drop("__seen")


def truncated(text: Column, most: int, mark: str = "...") -> Column:
    """Cut to most characters, the last three of them the mark."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - len(mark)), F.lit(mark))).otherwise(text)


def sentences(text: Column) -> Column:
    """Array of sentences: cut at white space after . ! or ?, not after known abbreviations; blank ones left out."""
    held = F.regexp_replace(F.coalesce(text, F.lit("")), java(r"\b(" + "|".join(X.ABBREVIATIONS) + r")\.", False), "$1<DOT>")
    parts = F.split(held, r"(?U)(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: strip(F.replace(s, F.lit("<DOT>"), F.lit(".")))), lambda s: s != "")


def context_windows(df: DataFrame, keywords: list[str], text: str = "text", before: int = 1, after: int = 1, most: int = X.MAX_SNIPPET, gate: bool = True) -> DataFrame:
    """A row for each sentence that holds a keyword as a substring: sentence_index, snippet, matched_keyword, has_reasoning, has_narrative.

    The snippet is the sentence with its neighbours; with gate, it must hold a verb of deciding and a product noun.
    """
    out = held(df, __s=sentences(F.col(text))).select("*", F.posexplode("__s").alias("sentence_index", "__one"))
    low = F.lower("__one")
    first = F.coalesce(*[F.when(low.contains(k.lower()), k) for k in keywords])
    out = out.withColumn("matched_keyword", first).where(F.col("matched_keyword").isNotNull())
    start = F.greatest(F.col("sentence_index") - before, F.lit(0))
    length = F.least(F.col("sentence_index") + after + 1, F.size("__s")) - start
    out = held(out, snippet=truncated(F.array_join(F.slice("__s", start + 1, length), " "), most))
    if gate:
        out = out.where(has(F.col("snippet"), whole(X.DECISION_STEMS)) & has(F.col("snippet"), whole(X.PRODUCT_NOUNS)))
    flags = {"has_reasoning": has(F.col("snippet"), whole(X.REASONING_PHRASES)), "has_narrative": has(F.col("snippet"), whole(X.NARRATIVE_MARKERS))}
    return out.withColumns(flags).drop("__s", "__one")
