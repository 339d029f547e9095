"""SQL text for the checks, made from the same term tables: RE2 patterns with boundaries spelt out."""

from __future__ import annotations

import re

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import whole

_WORD = r"[\p{L}\p{M}\p{N}_]"
_EDGE = r"[^\p{L}\p{M}\p{N}_]"


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(names: str, rows: list[str]) -> str:
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t({names})) AS v"


#: Fixture rows: id, text, URL.
_ROWS = [
    (-1, "We evaluated three vendors because our old CRM lacked integration. Our team selected the new platform after testing. Pricing was a concern for finance.", "https://blog.example.com/why-we-switched"),
    (-2, "The company chose a cloud solution due to compliance. Security review took a month. We migrated from the old suite and replaced it with a new vendor.", "https://docs.example.com/guide/setup"),
    (-3, "Home\nAbout us\nPricing\nBlog\nLogin\nOur team evaluated the software platform because support was slow, and we switched to another vendor after a trial.", "https://www.example.com/case-study/one"),
    (-4, "Senior software engineer. Responsible for cloud platforms. Five years of experience in operations and security, apply now for this position.", "https://jobs.example.com/career/4"),
    (-5, "Sign up for free today! Start your free trial. No credit card required. Trusted by 500 companies everywhere.", "https://shop.example.com/pricing"),
    (-6, "Mr. Lee left. We chose it! Why? Cost, etc. was low", "https://example.org/"),
    (-7, "mail bob@x.io now or call (555) 123-4567, id 123-45-6789, card 4111 1111 1111 1111, 12 Main Street", "https://example.org/contact"),
    (-8, "Home | About | Pricing | Contact\nHome > Products > Software > Pricing\nWe use cookies to help. Copyright 2020 someone\nThe vendor selection took time because of risk, so that we rejected two tools.", "https://casino.example.com/"),
    (-9, "Free spins and no deposit bonus for all who act now, while we selected the software", "https://example.net/docs/x"),
    (-10, "home about contact login", "https://example.net/products/"),
]
FIXTURES = values("row_id, text, source_url", ["({}, {}, {})".format(i, " || chr(10) || ".join(literal(p) for p in t.split("\n")), literal(u)) for i, t, u in _ROWS])
TEXTS = f"(SELECT doc_id AS row_id, text, 'https://' || source || '.example.com/page/' || doc_id AS source_url FROM documents UNION ALL SELECT row_id, text, source_url FROM {FIXTURES})"


def re2(pattern: str, ignore_case: bool = True, lines: bool = False, edges: bool = False) -> str:
    """A pattern as a literal; with edges, boundaries at its ends take a character that is no part of a word."""
    out = pattern
    if edges:
        out = re.sub(r"^\\b", lambda _: f"(?:^|{_EDGE})", out)
        out = re.sub(r"\\b$", lambda _: f"(?:$|{_EDGE})", out)
    out = out.replace(r"\w", _WORD)
    flags = "i" * ignore_case + "m" * lines
    return literal((f"(?{flags})" if flags else "") + out)


def match(column: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({column}, ''), {re2(pattern, edges=True)})"


def words_sql(column: str, terms: list[str]) -> str:
    """Any of the terms between boundaries; one that ends in a space needs a character of a word next."""
    ends = [re.escape(t) + (_WORD if t.endswith(" ") else f"(?:$|{_EDGE})") for t in terms]
    return f"regexp_matches(coalesce({column}, ''), {literal(f'(?i)(?:^|{_EDGE})(?:' + '|'.join(ends) + ')')})"


def all_matches(column: str, pattern: str, ignore_case: bool = True) -> str:
    return f"regexp_extract_all({column}, {re2(pattern, ignore_case)})"


def any_like(column: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), {literal(t.lower())})" for t in terms) + ")"


def strip_sql(expression: str) -> str:
    return f"regexp_replace({expression}, '^\\s+|\\s+$', '', 'g')"


def truncated_sql(expression: str, most: int) -> str:
    return f"CASE WHEN length({expression}) > {most} THEN substr({expression}, 1, {most - 3}) || '...' ELSE {expression} END"


def _present(column: str, keyword: str) -> str:
    k = keyword.lower()
    return f"contains(lower({column}), {literal(k)})" if " " in k else f"regexp_matches(lower({column}), {re2(whole([k], True), False, edges=True)})"


def score_sql(column: str, weights: dict[str, int], prefix: str = "") -> str:
    total = " + ".join(f"CASE WHEN {_present(column, k)} THEN {w} ELSE 0 END" for k, w in weights.items())
    found = ", ".join(f"CASE WHEN {_present(column, k)} THEN {literal(k)} END" for k in weights)
    return f"CAST({total} AS BIGINT) AS {prefix}score, array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ',') AS {prefix}matched"


def labels_sql(column: str, table: dict[str, str]) -> str:
    found = ", ".join(f"CASE WHEN {match(f'lower({column})', rf'\b(?:{p})')} THEN {literal(k)} END" for k, p in table.items())
    return f"array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ', ')"


def points_sql(w: str, c: str, o: str, i: str, n: str, reasoning: str, narrative: str, docs: str) -> str:
    kinds = " + ".join(f"CASE WHEN {x} > 0 THEN 1 ELSE 0 END" for x in (w, c, o, i))
    one = lambda cond, points: f"CASE WHEN {cond} THEN {points} ELSE 0 END"
    parts = [one(f"{w} > 0", 30), one(f"{w} > 1", 5), one(f"{c} > 0", 25), one(f"{c} > 1", 8), one(f"{o} > 0", 10), one(f"{i} > 0", 5), one(reasoning, 6), one(narrative, 6)]
    parts += [f"CASE WHEN {kinds} >= 3 THEN 12 WHEN {kinds} >= 2 THEN 8 ELSE 0 END", f"CASE WHEN {n} > 80 AND {n} < 240 THEN 5 WHEN {n} >= 50 THEN 3 ELSE 0 END", one(f"{docs} AND NOT {narrative}", -12)]
    return f"least(greatest({' + '.join(parts)}, 0), 100) / 100.0"


def first_at(column: str, pattern: str) -> str:
    """Place of the first match, from 0; null without one."""
    prefix = literal("(?is)^(.*?)" + pattern.replace(r"\w", _WORD))
    return f"CASE WHEN regexp_matches({column}, {re2(pattern)}) THEN length(regexp_extract({column}, {prefix}, 1)) END"


def _without(expression: str, pattern: str, ignore_case: bool = False, lines: bool = True) -> str:
    return f"regexp_replace({expression}, {re2(pattern, ignore_case, lines)}, '', 'g')"


def clean_nav_sql(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern, ignore_case, lines in ((X.MENU, False, True), (X.BREADCRUMB, False, True), (X.SHORT_LINES, False, True), (X.FOOTER, True, True), (X.SOCIAL, True, False), (X.SKIP_LINK, True, True), (X.COOKIES, True, False)):
        out = _without(out, pattern, ignore_case, lines)
    return strip_sql(f"regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def clean_lines_sql(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern, ignore_case, lines in ((X.PIPE_MENU, False, True), (X.BREADCRUMB, False, True), (X.SHORT_LINES, False, True), (X.FOOTER, True, True), (X.SOCIAL, True, False)):
        out = _without(out, pattern, ignore_case, lines)
    nav = re2(whole(X.NAV_TERMS))
    hit = f"coalesce(list_sum(list_transform(regexp_extract_all({strip_sql('s')}, {nav}), lambda m: length(m))), 0)"
    out = f"array_to_string(list_filter(string_split({out}, chr(10)), lambda s: NOT (length({strip_sql('s')}) < 40 AND {hit} > 0.5 * length({strip_sql('s')}) AND {hit} > 0)), chr(10))"
    return strip_sql(f"regexp_replace(regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")


def sentences_sql(column: str) -> str:
    held = f"regexp_replace(coalesce({column}, ''), '\\b({'|'.join(X.ABBREVIATIONS)})\\.', '\\1<DOT>', 'g')"
    parts = f"string_split(regexp_replace({held}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({parts}, lambda s: {strip_sql('replace(s, chr(60) || chr(68) || chr(79) || chr(84) || chr(62), chr(46))')}), lambda s: s <> '')"


GATE_SQL = (
    f"CASE WHEN NOT {match('text', whole(X.GATE_VERBS, True))} THEN '{X.DROPPED['verb']}' WHEN NOT {match('text', whole(X.GATE_MARKERS, True))} THEN '{X.DROPPED['marker']}' "
    f"WHEN NOT {match('text', whole(X.GATE_ACTORS))} THEN '{X.DROPPED['actor']}' ELSE 'passed' END"
)
