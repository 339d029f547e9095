"""HTML to text: native expressions where a pattern will do, an Arrow function with the standard parser for the rest."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.functions import lexicon as X
from prosemill.functions.patterns import any_of, strip
from prosemill.session import bounded

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def stripped(html: Column) -> Column:
    """Scripts and styles gone, tags and character references spaces, white space collapsed."""
    out = F.coalesce(html, F.lit(""))
    for pattern in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"<[^>]+>", r"&[#A-Za-z0-9]+;"):
        out = F.regexp_replace(out, pattern, " ")
    return strip(F.regexp_replace(out, r"(?U)\s+", " "))


def article(html: Column, at_least: int = 200) -> Column:
    """Text of the first article element, null if it is no longer than at_least."""
    text = stripped(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<article\b[^>]*>(.*?)</article>", 1))
    return F.when(F.length(text) > at_least, text)


def links(html: Column, most: int = 50) -> Column:
    """Up to so many link targets, in order."""
    return F.slice(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('href="([^"]+)"'), F.lit(1)), 1, most)


def feed_links(xml: Column, most: int = 50) -> Column:
    """Link targets of a feed: texts of its link elements, then targets of its alternate links; of the first so many, web addresses alone."""
    xml = F.coalesce(xml, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(xml, F.lit(p), F.lit(1)) for p in ("<link>([^<]+)</link>", '<link rel="alternate"[^>]+href="([^"]+)"')])
    return F.filter(F.slice(found, 1, most), lambda x: x.startswith("http"))


def http_body(raw: Column) -> Column:
    """What follows the headers of a response: after the first blank line, with or without carriage returns."""
    at = F.instr(raw, "\r\n\r\n")
    lf = F.instr(raw, "\n\n")
    return F.when(at > 0, F.substring(raw, at + 4, F.length(raw))).when(lf > 0, F.substring(raw, lf + 2, F.length(raw))).otherwise(raw)


class Node:
    """An element: its parts are texts and elements. Unclosed elements may nest to any depth, so nothing here recurses."""

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent, self.parts = tag, attributes, parent, []
        self.place = len(parent.parts) if parent else 0

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def text(self, without: frozenset = frozenset()) -> str:
        """Pieces of text, each stripped, joined by spaces."""
        out: list[str] = []
        todo: list = [self]
        while todo:
            p = todo.pop()
            if isinstance(p, str):
                out += [p.strip()] if p.strip() else []
            elif p.tag not in without:
                todo += reversed(p.parts)
        return " ".join(out)

    def following(self) -> list[Node]:
        return [p for p in self.parent.parts[self.place + 1 :] if isinstance(p, Node)] if self.parent else []


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs).get("class") or "", self.at)
        self.at.parts.append(node)
        if tag not in _VOID:
            self.at = node
            self.open[tag] += 1

    def handle_endtag(self, tag):
        if self.open[tag]:  # an end without a start closes nothing
            while True:
                closed, self.at = self.at, self.at.parent
                self.open[closed.tag] -= 1
                if closed.tag == tag:
                    break

    def handle_data(self, data):
        self.at.parts.append(data)


def parsed(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


CHROME = frozenset("script style nav footer".split())
ALL_CHROME = CHROME | frozenset("header aside form iframe".split())


def dom_text(html: str | None, without: frozenset = CHROME | {"header"}) -> str:
    return parsed(html).text(without)


HEADERS, TITLES = frozenset("h2 h3 h4 strong b".split()), frozenset("h2 h3 h4".split())


def _says(node: Node, words: list[str]) -> bool:
    low = node.text().lower()
    return any(w in low for w in words)


def _has_class(pattern: str) -> Callable[[Node], bool]:
    return lambda node: bool(re.search(pattern, node.attributes, re.I))


def _is_header(words: list[str]) -> Callable[[Node], bool]:
    return lambda node: node.tag in HEADERS and _says(node, words)


def _next(node: Node) -> str:
    """The text of the element after a header."""
    return next((n.text() for n in node.following()), "")


def _titled(stops: list[str], most: int) -> Callable[[Node], str]:
    """'Header: body' of a header and so many elements after it, up to the next header."""

    def ends(node: Node) -> bool:
        return node.tag in TITLES or node.tag in HEADERS and _says(node, stops)

    def of(header: Node) -> str:
        body = [n.text() for n in takewhile(lambda n: not ends(n), header.following()[:most])]
        body = " ".join(t for t in body if t)
        return f"{header.text()}: {body}" if body else ""

    return of


@dataclass(frozen=True)
class Rule:
    """A section for each element that is picked, if its text is longer than least."""

    pick: Callable[[Node], bool]
    text: Callable[[Node], str]
    least: int


#: Each parser: rules, of which all (or only the first element of the first rule that picks one) give sections; what the
#: page's text leaves out if there is none; and the length that it must exceed.
@dataclass(frozen=True)
class Parser:
    rules: tuple[Rule, ...]
    all_of_them: bool
    without: frozenset
    least: int = 200

    def sections(self, html: str | None) -> list[str]:
        root = parsed(html)
        if self.all_of_them:
            out = [t for r in self.rules for n in root.walk() if r.pick(n) and len(t := r.text(n)) > r.least]
            return out or self._long([root.text(self.without)])
        nodes = [n for n in root.walk() if n.tag not in self.without]
        main = next((n for r in self.rules for n in nodes if r.pick(n)), root)
        return self._long([main.text(self.without)])

    def _long(self, texts: list[str]) -> list[str]:
        return [t for t in texts if len(t) > self.least]


PARSERS = {
    "review": Parser((Rule(_has_class(X.REVIEW_CLASS), Node.text, 100), Rule(_is_header(X.REVIEW_HEADERS), _next, 50)), True, CHROME),
    "case_study": Parser((Rule(_is_header(X.CASE_HEADERS), _titled(X.CASE_STOPS, 5), 100),), True, CHROME),
    "blog": Parser(tuple(Rule(pick, Node.text, 0) for pick in (lambda n: n.tag == "article", lambda n: n.tag == "main", _has_class(X.MAIN_CLASS))), False, ALL_CHROME),
}


def _udf(f, kind: str):
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield html.map(f)

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, kind)


def with_dom_text(df: DataFrame, html: str = "html") -> DataFrame:
    bounded(df.sparkSession)
    return df.withColumn("text", _udf(dom_text, "string")(F.col(html)))


def with_section_list(df: DataFrame, parser: str, html: str = "html") -> DataFrame:
    """Adds sections, a list of what the parser of that name finds. A page at a time in Python, as a tree needs it."""
    bounded(df.sparkSession)
    return df.withColumn("sections", _udf(PARSERS[parser].sections, "array<string>")(F.col(html)))


def with_sections(df: DataFrame, parser: str, html: str = "html") -> DataFrame:
    """A row for each section that the parser of that name finds."""
    return with_section_list(df, parser, html).withColumn("section", F.explode("sections")).drop("sections")


def with_dispatched_sections(df: DataFrame, source: str, parsers: dict[str, str], keywords: list[str], html: str = "html") -> DataFrame:
    """Sections of pages by the parser that parsers names for their source key ('blog' for others), of those that hold a
    keyword; only they are exploded."""
    bounded(df.sparkSession)
    out = None
    for name in PARSERS:
        keys = [k for k, p in parsers.items() if p == name]
        own = F.col(source).isin(keys)
        if name == "blog":
            own = own | ~F.coalesce(F.col(source), F.lit("")).isin(list(parsers))
        part = with_sections(df.where(F.coalesce(own, F.lit(name == "blog"))), name, html)
        out = part if out is None else out.unionByName(part)
    return out.where(any_of(F.col("section"), keywords))
