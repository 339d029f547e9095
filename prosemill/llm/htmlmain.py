"""Main text of web pages by template deduction from equivalence classes.

Tokens are of two kinds: a structural tag in its place (the path of containers down to it, with their classes), and a
block of text in its place. Across the pages of a host, tokens with the same occurrence vector (how often in which page)
form an equivalence class. Vectors are compared by two linear hashes, sums over pages of page hash times count, so they
are aggregated like any sum and no page list is gathered. A class is valid if at least half of the host's pages have it
(text: four pages at least) and if it nests: its tokens stand in order, and beside any valid class of more pages it lies
within one gap, or that class within one of its gaps. Nested in this way the valid classes are the host's template. The
texts of the template go; what stands between its tokens are slots.

The tags met once in each page but one, or but a tenth of them, frame the pages (pages without tags or text don't
count). Slots under the frame's article are the main text; without one, all slots count. In both cases slots in
boilerplate elements and, outside an article, in places that are mostly links over all pages of the host are left out.
Texts that change from page to page (adverts, comments) are told by their element, and where that is a mere div by the
words of its class, if it holds less than half of the host's text.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import attach, tune, written

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
_MARK = re.compile(r"[>\"']")
#: Elements whose content is no text of the page, each with what ends it.
_RAW = {n: re.compile(rf"</{n}\s*>", re.I | re.A) for n in "script style noscript template textarea iframe svg title select".split()}
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th option".split())  # hold no other block that would need a path
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav header footer aside form button dialog menu head".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus "
    "footer gdpr header login masthead menu modal navbar navigation nav newsletter notice overlay paywall popup promo promoted promotion "
    "recommended related replies reply search share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget".split()
)


def _token(tag: str, attributes: str) -> str:
    names = {w for m in _NAMES.finditer(attributes) for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())}
    return ".".join([tag, *sorted(names)])


def _told_by_tag(element: str) -> bool:
    return element.split(".", 1)[0] in BOILERPLATE


def _told_by_words(element: str) -> bool:
    return any(n in BOILERPLATE_WORDS for n in element.split(".")[1:])


class Place:
    """A container in its place: its element and the place around it. The token is a hash of the whole path, made from the
    one around, so that a place costs the same at any depth."""

    __slots__ = ("around", "element", "token", "depth", "in_content")

    def __init__(self, around: Place | None = None, element: str = ""):
        self.around, self.element = around, element
        self.token = xxhash.xxh3_64_hexdigest(f"{around.token}/{element}".encode()) if around else ""
        self.depth = around.depth + 1 if around else 0
        self.in_content = bool(around) and (around.in_content or element.split(".", 1)[0] in CONTENT)


def text_token(place: Place, text: str) -> str:
    """The token of a block of text: no place's token begins with its mark."""
    return "#" + xxhash.xxh3_64_hexdigest(f"{place.token}\n{text}".encode())


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of all markup in order; what isn't a tag (comments, scripts) has no name.

    A tag ends at the first > outside quotes; a < from which none is found is text. Time is linear for any page: no part
    is searched again for what it was found not to hold.
    """
    size, last, at = len(page), page.rfind(">"), 0
    dead: set[int] = set()  # quotes from which on no tag ends
    low = high = -1  # the next mark from low on is at high

    def mark(start: int) -> int:
        found = _MARK.search(page, start)
        return found.start() if found else size

    def end_of(start: int) -> int:
        nonlocal low, high
        if start > last:
            return -1
        if not low <= start <= high:
            low, high = start, mark(start)
        at, passed = high, []
        while at < size and at not in dead:
            if page[at] == ">":
                return at + 1
            passed.append(at)
            closing = page.find(page[at], at + 1)
            at = size if closing < 0 else mark(closing + 1)
        dead.update(passed)
        return -1

    while (at := page.find("<", at)) >= 0:
        end, slash, tag, attributes = -1, "", "", ""
        if page.startswith("<!--", at):
            closing = page.find("-->", at + 4)
            end = size if closing < 0 else closing + 3
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1 if at < last else -1
        elif name := _NAME.match(page, at):
            end = end_of(name.end())
            if end >= 0:
                slash, tag, attributes = name[1], name[2].lower(), page[name.end() : end - 1]
                if tag in _RAW and not slash and not re.match(r"\w", attributes):
                    closing = _RAW[tag].search(page, end)
                    end, tag = closing.end() if closing else size, ""
        if end < 0:
            at += 1
            continue
        yield at, end, slash, tag, attributes
        at = end


def blocks(page: str) -> Iterator[tuple[Place, str, int]]:
    """(place, text, characters in links) of each block in page order; also (place, '', 0) where a container opens."""
    place = Place()
    opened: dict[str, int] = {}
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        out, linked = linked, 0
        return (place, text, out) if text else None

    for start, end, slash, tag, attributes in tags(page):
        if start > at:
            parts.append(page[at:start])
            linked += in_link * (start - at)
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not slash
        if tag in INLINE or tag in VOID and tag != "hr":
            continue
        if found := flush():
            yield found
        if tag in CLOSES or tag == "hr":
            continue
        if not slash:
            opened[tag] = opened.get(tag, 0) + 1
            place = Place(place, _token(tag, attributes))
            yield place, "", 0
        elif opened.get(tag):
            closed = ""
            while closed != tag:
                closed = place.element.split(".", 1)[0]
                opened[closed] -= 1
                place = place.around
    parts.append(page[at:])
    if found := flush():
        yield found


_KEYS = ("host", "token", "around", "element", "depth")
_SUMS = ("n", "pages", "once", "h1", "h2", "place", "text", "linked")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums for each host and token: occurrences, pages, two hashes of the vector, place, text, linked text.

    A token comes with the one around it, its element and depth (a text: with none), which its hash stands for.
    """
    for batch in batches:
        sums: dict[tuple, list[int]] = {}
        for host, page_id, page in zip(*(c.to_pylist() for c in batch.columns)):
            own: dict[tuple[str, str, str, int], list[int]] = {("", "", "", 0): [1, 0, 0, 0]}
            found = list(blocks(page or ""))
            for k, (p, text, linked) in enumerate(found):
                # Places in thousandths of the page, so that pages of any length are alike.
                x = own.setdefault((p.token, p.around.token if p.around else "", p.element, p.depth), [0, 1000 * k // len(found), 0, 0])
                if text:
                    x[2] += len(text)
                    x[3] += linked
                    x = own.setdefault((text_token(p, text), "", "", 0), [0, 1000 * k // len(found), 0, 0])
                    x[0] += 1
                    x[2] += len(text)
                else:
                    x[0] += 1
            own["", "", "", 0][0] = int(len(own) > 1)
            h = xxhash.xxh64_intdigest(str(page_id))
            h1, h2 = h & 0x7FFFFFFF, h >> 33
            for token, (n, place, text, linked) in own.items():
                x = sums.setdefault((host, *token), [0] * 8)
                for i, v in enumerate((n, 1, int(n == 1), n * h1, n * h2, place, text, linked)):
                    x[i] += v
        rows = [(*k, *v) for k, v in sums.items()]
        types = [pa.string()] * 4 + [pa.int64()] * 9
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[*_KEYS, *_SUMS])


#: Pages that a text must be on to belong to a template: on fewer, copies of an article would look like one.
TEXT_PAGES = 4


def templates(pages: DataFrame) -> DataFrame:
    """(host, pages, template): for each host the tokens of valid support in page order, as JSON; pages: host, page_id, html.

    Tokens below half of a host's pages are left out before anything is gathered, so a template has at most twice as
    many tokens as a page of the host has on average.
    """
    schema = "host string, token string, around string, element string, depth long, " + ", ".join(f"{c} long" for c in _SUMS)
    sums = pages.select("host", "page_id", "html").mapInArrow(_counts, schema).groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
    is_text = F.col("token").startswith("#")
    sums = written(sums.where(~is_text | (F.col("pages") >= TEXT_PAGES)), "html-tokens")
    total = sums.where("token = ''").select("host", F.col("pages").alias("size"), F.col("n").alias("of"))
    valid = sums.where("token <> '' AND n > 0").join(total, "host").where("2 * pages >= of")
    # The frame: exactly once in each page that has anything, but for one odd page or a tenth of them.
    frame = (~is_text & F.expr("of - once <= greatest(1, of div 10)") & (2 * F.col("once") >= F.col("of"))).alias("frame")
    at = (F.col("place") / F.col("pages")).alias("at")
    entry = F.struct(at, "depth", "token", "around", "element", frame, F.xxhash64("h1", "h2", "pages").alias("class"), "pages", "of", "text", "linked")
    classes = valid.groupBy("host").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("template"))
    return total.join(classes, "host", "left").select("host", F.col("size").alias("pages"), "template")


@dataclass
class Class:
    """Tokens that share an occurrence vector, in page order, with the classes nested in the gaps between them."""

    pages: int
    places: list[float] = field(default_factory=list)
    tokens: list[str] = field(default_factory=list)
    text: int = 0  # characters of its texts, over all pages
    inside: dict[int, list[Class]] = field(default_factory=dict)

    def gap(self, other: Class) -> int | None:
        """The gap (0: before the first token) that all of the other class lies in."""
        low, high = bisect_left(self.places, other.places[0]), bisect_right(self.places, other.places[-1])
        return low if low == high else None


def nested(tokens: list[dict]) -> Class:
    """The template: classes put into each other from the most pages and tokens on; those that cross a valid one are left out."""
    found: dict[int, Class] = {}
    for t in tokens:  # in page order
        own = found.setdefault(t["class"], Class(t["pages"]))
        own.places.append(t["at"])
        own.tokens.append(t["token"])
        own.text += t["text"] * t["token"].startswith("#")
    root = Class(0)
    for own in sorted(found.values(), key=lambda c: (-c.pages, -len(c.tokens), c.tokens)):
        at = root
        while True:
            gap = at.gap(own) if at.tokens else 0
            if gap is None:
                break
            beside = at.inside.setdefault(gap, [])
            around = next((c for c in beside if c.gap(own) is not None and c.places[0] < own.places[0] and own.places[-1] < c.places[-1]), None)
            if around:
                at = around
                continue
            apart = all(own.places[-1] <= c.places[0] or c.places[-1] <= own.places[0] or own.gap(c) is not None for c in beside)
            if apart:
                beside.append(own)
            break
    return root


def _classes(template: Class) -> Iterator[Class]:
    todo = [template]
    while todo:
        own = todo.pop()
        yield own
        todo += [c for inside in own.inside.values() for c in inside]


class Template:
    """The slots of a host that hold main text."""

    def __init__(self, template: str | None):
        tokens = json.loads(template) if template else []
        of = tokens[0]["of"] if tokens else 0
        whole = nested(tokens)
        # A place has the place around it in the template too, as that is on all its pages.
        tokens = [t for t in tokens if not t["token"].startswith("#")]
        self.all = sum(t["text"] for t in tokens)
        # The template's texts; a class with half of a page's text or more is an article that many pages have. In an
        # article only what nearly all of many pages say alike.
        self.fixed, self.fixed_inside = set(), set()
        for c in _classes(whole):
            if c.text and 2 * c.text * of < self.all * c.pages:
                self.fixed.update(c.tokens)
                if of >= 10 and 10 * c.pages >= 9 * of:
                    self.fixed_inside.update(c.tokens)
        told: dict[str, bool] = {}
        for t in sorted(tokens, key=lambda t: t["depth"]):
            told[t["token"]] = told.get(t["around"], False) or _told_by_tag(t["element"]) or _told_by_words(t["element"])
        tag = {t["token"]: t["element"].split(".")[0] for t in tokens}
        tops = [t["token"] for t in tokens if t["frame"] and (tag[t["token"]] in CONTENT or "main" in t["element"].split(".")[1:])]
        # Of nested content elements the innermost that frames the page: an article inside main.
        inner = [t for t in tops if tag[t].startswith("article")] or tops
        self.content = {t: k for k, t in enumerate(t for t in inner if not told[t])}
        self.links = {t["token"] for t in tokens if 2 * t["linked"] > t["text"] > 0}
        # Text under each place, over all pages of the host.
        self.mass = {t["token"]: t["text"] for t in tokens}
        for t in sorted(tokens, key=lambda t: -t["depth"]):
            if t["depth"] > 1:
                self.mass[t["around"]] += self.mass[t["token"]]

    def _boilerplate(self, place: Place, in_content: bool) -> bool:
        """Told by this element alone; a header in an article holds its title."""
        names = place.element.split(".")
        if _told_by_tag(place.element) and not (in_content and names[0] == "header"):
            return True
        words = [n for n in names[1:] if n in BOILERPLATE_WORDS and not (in_content and n == "header")]
        return bool(words) and 2 * self.mass.get(place.token, 0) < max(1, self.all)

    def _state(self, place: Place, known: dict[str, tuple[int | None, bool]]) -> tuple[int | None, bool]:
        """(the first of the content elements that the place is in, whether it is boilerplate), by the places around it."""
        todo = []
        while place.token not in known:
            todo.append(place)
            place = place.around
        for p in reversed(todo):
            top, out = known[p.around.token]
            own = self.content.get(p.token)
            if own is not None and (top is None or own < top):
                known[p.token] = own, False
            else:
                known[p.token] = top, out or self._boilerplate(p, top is not None)
            place = p
        return known[place.token]

    def keeps(self, place: Place, known: dict[str, tuple[int | None, bool]]) -> bool:
        top, out = self._state(place, known)
        return not out and (top is not None or not self.content and place.token not in self.links)

    def text(self, page: str) -> str:
        known: dict[str, tuple[int | None, bool]] = {"": (None, False)}
        found = [(p, t) for p, t, _ in blocks(page) if t]
        if self.fixed:
            said = lambda p: self.fixed if self._state(p, known)[0] is None else self.fixed_inside
            found = [(p, t) for p, t in found if text_token(p, t) not in said(p)]
        out = [t for p, t in found if self.keeps(p, known)]
        if not out and self.content:  # this page lacks the host's frame
            own, known = Template(None), {"": (None, False)}
            articles = [(p, t) for p, t in found if p.in_content]
            out = [t for p, t in articles or found if own.keeps(p, known)]
        return "\n\n".join(out)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty html gives an empty text, as does a page of boilerplate alone. Pages without a host share the host
    ''. Repeated rows are pages of their own. A host with fewer than four pages has no text in its template. Tokens at
    the same place (ties) stand in the order of their depth. Texts of any length are whole tokens. Pages of any depth and
    with any unclosed tags, quotes or comments take time and memory in proportion to their length. An empty table gives no
    rows; other columns are ignored.
    """
    tune(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    own = pages.select(host.alias("host"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = written(templates(own), "html-templates")
    n = found.agg(F.sum("pages"), F.max(F.length("template"))).first()
    both = attach(own, found, "host", "pages", n[0] or 0, 64 + (n[1] or 0))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Template] = {}
        for batch in batches:
            texts = []
            for page, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if template not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[template] = Template(template)
                texts.append(known[template].text(page or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return both.select("page_id", "url", "html", "template").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
