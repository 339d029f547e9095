"""Labels, confidence, snippets and extracted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import folded, has, held, java_folded, let, strip, whole
from prosemill.operators import signals as S
from prosemill.operators import text as T

LABELS = {"workflow_step": X.WORKFLOW, "criteria": X.CRITERIA, "objection": X.OBJECTION, "industry_hint": X.INDUSTRY}


def labels(text: Column, table: dict[str, str]) -> Column:
    """Array of the labels whose pattern is found, in the table's order. One pattern of all tells most texts apart."""

    def of(low: Column) -> Column:
        found = F.array_compact(F.array(*[F.when(low.rlike(java_folded(rf"\b(?:{p})")), k) for k, p in table.items()]))
        any_of = low.rlike(java_folded(r"\b(?:" + "|".join(f"(?:{p})" for p in table.values()) + ")"))
        return F.when(any_of, found).otherwise(F.array().cast("array<string>"))

    return let(folded(F.lower(text)), of)


def confidence(workflow: Column, criteria: Column, objection: Column, industry: Column, length: Column, reasoning: Column, narrative: Column, docs: Column) -> Column:
    """Additive score from counts and flags, summed in whole hundredths, within 0 and 1."""
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    kinds = sum((points(c > 0, 1) for c in (workflow, criteria, objection, industry)), F.lit(0))
    total = (
        points(workflow > 0, 30) + points(workflow > 1, 5) + points(criteria > 0, 25) + points(criteria > 1, 8) + points(objection > 0, 10) + points(industry > 0, 5)
        + points(reasoning, 6) + points(narrative, 6) + F.when(kinds >= 3, 12).when(kinds >= 2, 8).otherwise(0)
        + F.when((length > 80) & (length < 240), 5).when(length >= 50, 3).otherwise(0) - points(docs & ~narrative, 12)
    )
    return F.least(F.greatest(total, F.lit(0)), F.lit(100)) / F.lit(100.0)


def centred_snippet(text: Column, most: int = X.MAX_SNIPPET) -> Column:
    """A window of the text around the mean place of its first verb, marker and actor; starts after a sentence end near its begin."""
    firsts = lambda low: [F.regexp_instr(low, F.lit(java_folded(p))) for p in (whole(X.GATE_VERBS, escape=True), whole(X.GATE_MARKERS, escape=True), whole(X.GATE_ACTORS))]
    found = F.filter(let(folded(text), lambda low: F.array(*firsts(low))), lambda i: i > 0)

    def cut(found: Column) -> Column:
        mean = F.when(F.size(found) > 0, F.floor((F.aggregate(found, F.lit(0), lambda a, b: a + b) - F.size(found)) / F.size(found))).otherwise(0)
        start = F.greatest(F.lit(0), F.least(mean - most // 2, F.length(text) - most)).cast("int")
        return let(F.substring(text, start + 1, F.lit(most)), tail)

    def tail(window: Column) -> Column:
        dot = F.locate(". ", window)
        return F.when((dot > 1) & (dot < 81), F.substring(window, dot + 2, F.lit(most))).otherwise(window)

    # The searches are long: short texts need none, and each is made once.
    return strip(F.when(F.length(text) <= most, text).otherwise(let(found, cut)))


def extract_rows(df: DataFrame, text: str = "text", most: int = X.MAX_SNIPPET, flags: dict[str, Column] | None = None) -> DataFrame:
    """Rows with labels and confidence; needs 30 characters and a workflow step or a criterion.

    df has text, has_reasoning, has_narrative, is_docs_page and whatever is to be carried along. Flags that are given as
    expressions are worked out, like the labels that no test needs, for the rows that stay.
    """
    out = df.where(F.length(strip(F.coalesce(F.col(text), F.lit("")))) >= 30)
    tested = ("workflow_step", "criteria")
    out = held(out, **{f"__{k}": labels(F.col(text), LABELS[k]) for k in tested}).where((F.size("__workflow_step") > 0) | (F.size("__criteria") > 0))
    out = held(out, **{f"__{k}": labels(F.col(text), t) for k, t in LABELS.items() if k not in tested}, **(flags or {}))
    sizes = [F.size(f"__{k}") for k in LABELS]
    value = confidence(*sizes, F.length(text), F.col("has_reasoning"), F.col("has_narrative"), F.col("is_docs_page"))
    out = held(out, **{"decision_context": T.truncated(F.col(text), most), "confidence": value, **{k: F.concat_ws(", ", f"__{k}") for k in LABELS}})
    return out.drop(*[f"__{k}" for k in LABELS])


def extract_from_documents(df: DataFrame, text: str = "text", url: str = "source_url") -> DataFrame:
    """Gate, snippet and row of each document; the gate reads the whole document once, before anything is exploded."""
    t = F.col(text)
    out = df.where(F.length(F.coalesce(t, F.lit(""))) >= 80).where(~T.bio_dropped(t) & ~T.promo_content(t)).where(S.gate_reason(t) == X.DROPPED[None])
    flags = {"has_reasoning": has(t, whole(X.REASONING_PHRASES)), "has_narrative": has(t, whole(X.NARRATIVE_MARKERS)), "is_docs_page": S.docs_url(F.col(url))}
    return extract_rows(held(out, snippet=centred_snippet(t), **flags), "snippet")


def quality_gate(df: DataFrame, text: str = "decision_context") -> DataFrame:
    """Adds gate_reason: a reason of cleaning, navigation noise if fewer than 30 characters are left, or 'passed'."""
    out = T.with_full_clean(df, text)
    reason = F.when(F.col("drop_reason").isNotNull(), F.col("drop_reason")).when(F.length("cleaned") < 30, X.DROPPED["nav"]).otherwise(X.DROPPED[None])
    return out.withColumn("gate_reason", reason).drop("drop_reason")


def best_per_key(df: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """The row with the largest value of each key (null last); ties go to the smallest tie. Aggregated before the shuffle."""
    order = F.struct(F.col(value).isNull().alias("__n"), (-F.col(value)).alias("__v"), F.col(tie).alias("__t"))
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), order).alias("__row")).select("__row.*")


def top_per_key(df: DataFrame, key: str, k: int, *order: Column) -> DataFrame:
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("__rank") <= k).drop("__rank")
