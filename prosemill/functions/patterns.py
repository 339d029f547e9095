"""From term tables to expressions: Java patterns for Spark, RE2 patterns for the SQL that checks them.

Spark's side always has Unicode classes ((?U)) and, for line-wise patterns, newline alone as the end of a line ((?d)).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.session import bounded


def alternation(terms: list[str]) -> str:
    return "(?:" + "|".join(terms) + ")"


def whole(terms: list[str], escape: bool = False) -> str:
    """Any of the terms between word boundaries."""
    return r"\b" + alternation([re.escape(t) for t in terms] if escape else terms) + r"\b"


def _end(pattern: str, at: int) -> int:
    """Where the group or class that opens here ends."""
    depth, bracket = 0, False
    while True:
        c = pattern[at]
        if c == "\\":
            at += 1
        elif bracket:
            bracket = c != "]"
        elif c == "[":
            bracket = True
        else:
            depth += (c == "(") - (c == ")")
        at += 1
        if not depth and not bracket:
            return at


def _alternatives(pattern: str) -> list[str]:
    out, start, at = [], 0, 0
    while at < len(pattern):
        if pattern[at] == "|":
            out.append(pattern[start:at])
            start = at + 1
        at = _end(pattern, at)
    return out + [pattern[start:]]


def _leads(pattern: str, n: int = 2) -> set[tuple[str, ...]] | None:
    """What every match begins with, as members of classes of characters: one or two of them. None where it can't be told."""
    out: set[tuple[str, ...]] = set()
    for p in _alternatives(pattern):
        while p.startswith(r"\b"):
            p = p[2:]
        if not p or p[0] in "^$.)?*+{|" or (p[0] == "[" and (p[1] in "^]" or "&&" in p or "[" in p[1 : _end(p, 0)])):
            return None
        end = _end(p, 0)
        part, rest = p[:end], p[end:]
        if rest[:1] == "{":
            return None
        if rest[:1] in ("?", "*"):
            # There or not: what follows can begin a match, too.
            first, then = _leads(part, 1), _leads(rest[1:].lstrip("?+"), n)
            if first is None or then is None:
                return None
            out |= first | then
            continue
        if part[0] == "(":
            if part.startswith("(?") and not part.startswith("(?:"):
                return None
            first = _leads(part[3:-1] if part.startswith("(?:") else part[1:-1], n)
            if first is None:
                return None
            # Of a short group only the first is known here.
            out |= first
            continue
        if part[0] == "\\" and part[1].isalnum() and part[1] not in "dws":
            return None
        member = part if part[0] in "[\\" or part.isalnum() else "\\" + part
        then = _leads(rest, 1) if n > 1 and rest and rest[0] != "+" and len(_alternatives(rest)) == 1 else None
        out |= {(member, *t) for t in then} if then else {(member,)}
    return out


def _sought(pattern: str) -> str:
    """A look at the first one or two characters, which turns most places away before the terms are tried; nothing where they
    can't be told. It asks for no more than the pattern does."""
    found = _leads(pattern) if len(_alternatives(pattern)) == 1 else None
    if not found:
        return ""
    classes = ["".join(sorted({f[k] for f in found})) for k in range(min(map(len, found)))]
    return f"(?={''.join(f'[{c}]' for c in classes)})"


def java(pattern: str, ignore_case: bool = True, lines: bool = False) -> str:
    return f"(?{'i' * ignore_case}{'md' * lines}U)" + _sought(pattern) + pattern


def re2(pattern: str, ignore_case: bool = True, lines: bool = False) -> str:
    """The pattern as a DuckDB string literal."""
    flags = "i" * ignore_case + "m" * lines
    return "'" + (f"(?{flags})" if flags else "") + pattern.replace("'", "''") + "'"


#: RE2's word, and the letters beyond ASCII that RE2 folds to s and k.
_ASCII_WORD, _LONG_S, _KELVIN = "[0-9A-Za-z_]", "\u017f", "\u212a"


def java_ascii(pattern: str, ignore_case: bool = True) -> str:
    """A Java pattern that finds what RE2 finds: digits, white space and boundaries of ASCII, letters folded as Unicode has it."""
    edge = f"(?:(?={_ASCII_WORD})(?<!{_ASCII_WORD})|(?!{_ASCII_WORD})(?<={_ASCII_WORD}))"
    folded = {**dict.fromkeys("sS", f"[sS{_LONG_S}]"), **dict.fromkeys("kK", f"[kK{_KELVIN}]")} if ignore_case else {}
    escapes = {r"\b": edge, r"\d": "[0-9]", r"\s": "[\t\n\f\r ]"}

    def of(m: re.Match) -> str:
        part = m[0]
        if part[0] == "[":
            part = part.replace(r"\s", "\t\n\f\r ").replace(r"\d", "0-9")
            return re.sub("A-Z|a-z", lambda r: r[0] + _LONG_S + _KELVIN, part) if ignore_case else part
        return escapes.get(part) or folded.get(part, part)

    # Before what can only be a character of a word, that character is looked for first, and a look back is enough.
    first = re.match(r"\\b(?=(?:\(\?:)?(\\d|\[A-Z\]|[A-Za-z]))", pattern)
    start = f"(?={first[1]})" if first else ""
    out = re.sub(r"\\.|\[[^]]*\]|.", of, start + pattern[first.end() if first else 0 :])
    if first:
        out = re.sub(r"^\(\?=.*?\)", lambda m: f"{m[0]}(?<!{_ASCII_WORD})", out)
    return ("(?i)" if ignore_case else "") + out


def folded(text: Column) -> Column:
    """The text in lower case, character by character, as patterns that ignore case compare it: null is empty, places stay."""
    out = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("i")))
    return F.replace(F.replace(out, F.lit(_LONG_S), F.lit("s")), F.lit("\u0131"), F.lit("i"))


def java_folded(pattern: str) -> str:
    """A Java pattern that finds in folded texts what java(pattern) finds in texts, without folding each character it meets.

    All terms between boundaries begin with a letter or a digit of ASCII, which is looked for first.
    """
    low = re.sub(r"\\.|.", lambda m: m[0] if m[0][0] == "\\" else m[0].lower(), pattern, flags=re.S)
    return "(?U)" + (_sought(low) or ("(?=[a-z0-9])" if low.startswith(r"\b(?:") else "")) + low


def loose(pattern: str, gaps: bool = False) -> str:
    """An RE2 pattern that is found in each folded text in which java(pattern) is found in the text, and in some others.

    Lines, ends of words and what only Unicode tells are given up; with gaps, white space may be anything, so that deleting
    lines from the text makes no match that wasn't seen.
    """
    low = re.sub(r"\\.|.", lambda m: m[0] if m[0][0] == "\\" else m[0].lower(), pattern, flags=re.S)
    space = ".*" if gaps else "[^a-z0-9]"

    def of(m: re.Match) -> str:
        part = m[0]
        if part[0] == "[":
            return "." if "\\" in part or not part.isascii() else part
        if part[:2] == r"\s":
            return space if gaps else space + part[2:]
        return {r"\b": "", r"\d": "[^a-z ]", r"\w": "[^ ]", "^": "", "$": ""}.get(part, part)

    out = re.sub(r"\\s[+*]?|\\.|\[[^]]*\]|.", of, low, flags=re.S)
    # A boundary before a letter of ASCII is one of RE2, too.
    leads = _leads(low, 1) if low.startswith(r"\b") else None
    return "(?s)" + (r"\b" if leads and all(re.fullmatch("[a-z]", x[0]) for x in leads) else "") + out


def may_hold(df: DataFrame, text: str, name: str, patterns: list[str], gaps: bool = False) -> DataFrame:
    """Adds a whole number whose bit k says that the text may hold pattern k: without it, it doesn't.

    Arrow's matcher looks at each character once, whatever a pattern's terms are; so the patterns themselves, which take
    longer, are searched for where they may be found. Null is empty.
    """
    sought = [loose(p, gaps) for p in patterns]

    def of(low: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out = np.zeros(len(low), np.int32)
        for k, p in enumerate(sought):
            out |= pc.match_substring_regex(low, p).to_numpy(zero_copy_only=False).astype(np.int32) << k
        return pa.array(out)

    bounded(df.sparkSession)
    # Called nondeterministic, so that the optimizer doesn't copy it into the filters that read it.
    return df.withColumn(name, F.arrow_udf(of, "int").asNondeterministic()(folded(F.col(text))))


def bit(bits: Column, k: int) -> Column:
    return bits.bitwiseAND(F.lit(1 << k)) != 0


def has(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return folded(text).rlike(java_folded(pattern)) if ignore_case else F.coalesce(text, F.lit("")).rlike(java(pattern, False))


def hits(text: Column, pattern: str, ignore_case: bool = True, of: Callable[[str, bool], str] = java) -> Column:
    if ignore_case and of is java:
        return F.regexp_count(folded(text), F.lit(java_folded(pattern)))
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(of(pattern, ignore_case)))


def any_of(text: Column, terms: list[str]) -> Column:
    """Any term is a substring of the lower-cased text, which is made once."""

    def tested(low: Column) -> Column:
        tests = [low.contains(t.lower()) for t in terms] or [F.lit(False)]
        while len(tests) > 1:  # a tree of little depth
            tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) // 2 * 2 :]
        return tests[0]

    return let(F.lower(F.coalesce(text, F.lit(""))), tested)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body reads it: the optimizer doesn't copy what a lambda is bound to."""
    return F.transform(F.array(value), body)[0]


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each worked out once.

    A generator makes them, so that the optimizer doesn't copy long expressions into each filter that reads them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
