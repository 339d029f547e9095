"""Pages with unclosed tags, quotes, comments and containers: the scanner against a plain pattern, and whole runs."""

import random
import re
import time
import tracemalloc

import pytest

pytest.importorskip("prosemill.llm")

from prosemill.llm import htmlmain  # noqa: E402

# A pattern says the same as the scanner, but it may search a page once for each of its characters.
RAW = "script|style|noscript|template|textarea|iframe|svg|title|select"
ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
PATTERN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)({ATTRIBUTES})>", re.S | re.I)
PIECES = ["<", "b", " ", ">", '"', "'", "<div>", "</div>", "<!--", "-->", "<script>", "</script >", "<a href='x'>", "</a>", "x y", "<!", "<?", "/", "<svg", "<script_a>", "<TITLE>", "</title>", "é"]

BROKEN = {
    "unclosed tags": ("<b " * 340_000, 1_019_999),
    "unclosed quotes": ('<a "' * 250_000, 999_999 + 1),
    "one quote at the end": ("<b " * 300_000 + '"', 900_001),
    "both quotes": ("<a \"'" * 200_000 + ">", None),
    "unclosed containers": ("<div>" * 200_000, 0),
    "containers with text": ("<div>x" * 150_000, 150_000 + 2 * 149_999),
    "closing what isn't open": ("<div>" * 100_000 + "</nav>" * 100_000 + "<p>end", 3),
    "unclosed declarations": ("<!x " * 250_000, 999_999),
    "an unclosed comment": ("before<!-- " + "x" * 1_000_000, 6),
}


def test_the_scanner_says_what_the_pattern_says():
    rng = random.Random(4)
    for _ in range(20_000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24)))
        want = [(m.start(), m.end(), m[2] or "", (m[3] or "").lower(), m[4] or "") for m in PATTERN.finditer(page)]
        got = [(a, b, slash, tag, "" if not tag else attributes) for a, b, slash, tag, attributes in htmlmain.tags(page)]
        assert [w if w[3] else (*w[:2], w[2], "", "") for w in want] == [g if g[3] else (*g[:2], "", "", "") for g in got], page


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_time_and_memory_by_their_length(name):
    page, n_chars = BROKEN[name]
    start = time.monotonic()
    text = htmlmain.Template(None).text(page)
    assert time.monotonic() - start < 10  # about a second; by the square of the length it would be hours
    assert n_chars is None or len(text) == n_chars
    tracemalloc.start()
    try:
        assert sum(1 for _ in htmlmain.blocks(page[: len(page) // 4])) >= 0
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()


def test_broken_pages_in_a_run(spark):
    """They leave the other pages of their host as they are."""
    good = [(k, f"https://a.example/{k}", f"<nav>Menu of all</nav><article><p>Text {k} of its own</p></article><footer>Foot</footer>") for k in range(6)]
    bad = [(100 + k, f"https://a.example/b{k}", page) for k, (page, _) in enumerate(BROKEN.values())]
    bad += [(200 + k, f"https://b.example/b{k}", "<div>" * 20_000 + "deep" + "<nav>no") for k in range(5)]
    got = {r["page_id"]: r["text"] for r in htmlmain.main_text(spark.createDataFrame(good + bad, "page_id long, url string, html string")).collect()}
    assert {k: got[k] for k in range(6)} == {k: f"Text {k} of its own" for k in range(6)}
    assert len(got) == len(good) + len(bad)
    # Half of the host's text is its own, so the same text on five pages is an article that many pages have.
    assert [got[200 + k] for k in range(5)] == ["deep"] * 5
