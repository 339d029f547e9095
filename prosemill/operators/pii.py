"""Detection of personal data, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import held, hits, java, java_ascii

TYPES = ("email", "phone", "ssn", "address", "credit_card")


def _first_family(*counts: Column) -> Column:
    """The count of the first pattern that hits."""
    out = F.lit(0)
    for c in reversed(counts):
        out = F.when(c > 0, c).otherwise(out)
    return out


def pii_counts(text: Column, unicode: bool = True) -> dict[str, Column]:
    """Matches of each type. Nine digits that begin with at most 031 pass as a date, not as a number of the ssn kind.

    With unicode, a letter of any script continues a word, so that an address never ends inside one ("12 Main st" in
    "12 Main stöbe"); without it boundaries, digits and white space are those of ASCII, as in RE2.
    """
    text, of = F.coalesce(text, F.lit("")), java if unicode else java_ascii
    found = F.regexp_extract_all(text, F.lit(of(X.SSN, False)), F.lit(0))
    digits = lambda s: F.regexp_replace(s, "[- ]", "")
    ssn = F.size(F.filter(found, lambda s: ~((F.length(digits(s)) == 9) & F.coalesce(F.substring(digits(s), 1, 3).try_cast("int") <= 31, F.lit(False)))))
    count = lambda p, ignore_case=False: hits(text, p, ignore_case, of)
    return {
        "email": F.when(text.contains("@"), count(X.EMAIL)).otherwise(0),
        "phone": _first_family(*[count(p) for p in X.PHONES]),
        "ssn": ssn,
        "address": _first_family(count(X.STREET, True), count(X.PO_BOX, True), count(X.CITY_ZIP)),
        "credit_card": count(X.CARD),
    }


def with_pii(df: DataFrame, columns: list[str], types: tuple[str, ...] = TYPES, unicode: bool = True) -> DataFrame:
    """Adds pii_types (array, in a fixed order) and pii_details, from the columns joined by spaces; types switches kinds off,
    unicode is that of pii_counts."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    out = held(df, __text=text)
    counts = {k: c for k, c in pii_counts(F.col("__text"), unicode).items() if k in types}
    out = held(out, **{f"__{k}": c for k, c in counts.items()})
    out = out.withColumn("pii_types", F.array_compact(F.array(*[F.when(F.col(f"__{k}") > 0, k) for k in counts])))
    out = out.withColumn("pii_details", F.array_compact(F.array(*[F.when(F.col(f"__{k}") > 0, F.concat(F.lit(f"{k}:"), F.col(f"__{k}"))) for k in counts])))
    return out.drop("__text", *[f"__{k}" for k in counts])


def drop_pii(df: DataFrame, columns: list[str], unicode: bool = True) -> DataFrame:
    return with_pii(df, columns, unicode=unicode).where(F.size("pii_types") == 0).drop("pii_types", "pii_details")


def pii_summary(df: DataFrame, columns: list[str], unicode: bool = True) -> DataFrame:
    """Rows of each type."""
    return with_pii(df, columns, unicode=unicode).select(F.explode("pii_types").alias("pii_type")).groupBy("pii_type").agg(F.count("*").alias("n_rows"))
