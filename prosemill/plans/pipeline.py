"""The whole chain: records, passages, rows, validated rows. Each step is a DataFrame transform; nothing runs until written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import held
from prosemill.operators import dedup, extract, pii, report, signals
from prosemill.operators.text import bio_dropped, promo_content, truncated
from prosemill.sources.records import best_text

MIN_CONFIDENCE = 0.35


def filtered(records: DataFrame, weights: dict[str, int] = X.WEIGHTED, min_score: int = X.MIN_SCORE) -> DataFrame:
    return signals.passage_filter(records, weights, min_score)


#: Characters of a record that the gate and the snippet read.
FULL_TEXT = 8000
#: Columns of an extracted row.
ROW = ["decision_context", "criteria", "objection", "workflow_step", "industry_hint", "confidence", "source_url", "crawl_date", "matched_keywords"]


def narratives(records: DataFrame, weights: dict[str, int] = X.WEIGHTED, min_score: int = X.MIN_SCORE, key: str = "row_id") -> DataFrame:
    """From records (key, text, source_url, crawl_date) to extracted rows: the columns of ROW and the key.

    A record is gated once, on its beginning, and its snippet is taken there, before its passages are exploded; each
    passage that the filter keeps gives a row with the passage's flags; rows are cleaned and gated again, and the best
    row of each URL stays. Records of the second shape bring a full_text, which is read in place of the text.
    """
    full = F.col("__full")
    records = records.withColumn("text", best_text(records))
    out = held(records.where(F.length("text") >= 50), __full=F.substring("text", 1, FULL_TEXT)).where(F.length(full) >= 80)
    out = out.where(~bio_dropped(full) & ~promo_content(full)).where(signals.gate_reason(full) == X.DROPPED[None])
    passages = filtered(held(out, best_snippet=extract.centred_snippet(full)).drop("__full", "full_text"), weights, min_score)
    rows = extract.extract_rows(passages.drop("text"), "best_snippet").withColumn("matched_keywords", F.array_join("matched_keywords", ","))
    kept = extract.quality_gate(rows).where(F.col("gate_reason") == X.DROPPED[None])
    kept = kept.withColumn("decision_context", truncated(F.col("cleaned"), X.MAX_SNIPPET)).select(key, *ROW)
    return extract.best_per_key(kept, "source_url", "confidence", key)


def validated(rows: DataFrame, order: str, checkpoint: Callable[[DataFrame], DataFrame], threshold: float = 90.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(passing, flagged, report): near-duplicates go, then rows with personal data, then empty ones; then the split by confidence.

    order (a column of any kind) says which rows come first; rows are numbered by it without gaps.
    """
    rows, order = checkpoint(dedup.numbered(rows, order, "__number", checkpoint)), "__number"
    unique = checkpoint(dedup.greedy_kept(rows, dedup.similar_pairs(rows, "decision_context", order, threshold), order, checkpoint))
    clean = pii.drop_pii(unique, ["decision_context"]).withColumn("decision_context", truncated(F.col("decision_context"), X.MAX_SNIPPET))
    clean = checkpoint(clean.where(F.length("decision_context") > 10))
    passing, flagged = clean.where(F.col("confidence") >= MIN_CONFIDENCE), clean.where(F.col("confidence") < MIN_CONFIDENCE)
    counts = {k: F.count("*").alias(k) for k in ("n_in", "n_unique", "n_out", "n_flagged")}
    one = rows.agg(counts["n_in"]).crossJoin(unique.agg(counts["n_unique"])).crossJoin(passing.agg(counts["n_out"])).crossJoin(flagged.agg(counts["n_flagged"]))
    rates = report.rates(F.col("n_in"), F.col("n_out"), F.col("n_in") - F.col("n_unique"))
    return passing, flagged, one.withColumns(rates)
