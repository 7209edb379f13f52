"""Page scanners against plain patterns, golden derived records, alignment against brute force, and odd long inputs in time."""

import html
import re
import time
from itertools import product

import numpy as np
import pytest

from homespan.llm import licenses, warc

PIECES = [
    "<a ", "<a>", "<A HREF=", "href='x>y'", 'href="q"', "href=z", ">", "<!-- ", "-->", "<script", "</script >", "<style>", "</STYLE>",
    "<br/>", "<p", "</p>", "<title", "</title>", "<html lang=en", "<html", " lang='de-x'", "text", "&amp;", "\n", "\r\n", "  ", "<3", "<head>",
    "</head>", '"', "'", "langlang=fr", "<a\thref = 'k'",
]


def plain(page):
    """Text, language, title and links by patterns, which are slow on unclosed tags."""
    unseen = re.compile(r"<(script|style|noscript|template|head)\b.*?</\1\s*>", re.S | re.I)
    breaks = re.compile(r"<(?:br|/?(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|nav|footer|header|blockquote|pre|title))\b[^>]*>", re.I)
    tag = re.compile(r"<[!/?a-zA-Z][^>]*>")
    text = unseen.sub("", re.sub(r"(?s)<!--.*?-->", "", page))
    text = tag.sub("", breaks.sub("\n", text.replace("\r\n", " ").replace("\r", " ").replace("\n", " ")))
    text = re.sub(r" ?(?:\r\n|\r|\n) ?(?:\s*\n)?", "\n", re.sub(r"[ \t\f\v ]+", " ", html.unescape(text))).strip()
    language = re.search(r"(?i)<html[^>]*\blang\s*=\s*[\"']?([\w-]+)", page)
    title = re.search(r"(?is)<title[^>]*>(.*?)</title\s*>", page)
    links = re.findall(r"(?i)<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", page)
    return text, language and language[1], title and title[1], ["".join(m) for m in links]


def test_scanners_equal_the_patterns():
    draw = np.random.default_rng(4)
    for _ in range(6000):
        page = "".join(PIECES[i] for i in draw.integers(0, len(PIECES), int(draw.integers(1, 14))))
        got = warc.plain_text(page), warc.language_of(page), warc.title_of(page), list(warc.targets(page))
        assert got == plain(page), page


@pytest.mark.parametrize("piece", ["<!-- ", "<a ", "<script>", "<title ", "<html ", "<html lang ", "<p ", "< ", "<a href=", "<head></hea"])
def test_pages_that_never_close_take_linear_time(piece):
    page = piece * (1_000_000 // len(piece))
    begin = time.perf_counter()
    warc.derived(warc.response(1, "http://x/", page))
    assert time.perf_counter() - begin < 6


def test_golden_records():
    page = "<html lang=DE><head><title>Ein &amp; <b>Titel</b></title></head><body><p>Gr&uuml;n<br>rot <a href='/a?b=1&amp;c'>x</a></p></body>"
    source = warc.response(7, "http://x/y", page)
    about, text = warc.derived(source)
    assert about[1] == "metadata" and text[1] == "conversion" and about[3] == text[3] == source[2] and text[4] == about[2]
    lines = about[7].split("\r\n")
    assert lines[0] == "http-status: 200" and "language: de" in lines and "title: Ein & Titel" in lines
    assert "outlink: /a?b=1&c L a/@href" in lines and f"source-payload-digest: {source[9]}" in lines
    assert text[7] == "Grün\nrot x" and text[10] == len(text[7].encode())
    assert f"WARC-Block-Digest: {warc.digest(text[7].encode())}" in text[6] and f"WARC-Refers-To: {source[2]}" in text[6]


def longest(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[j]))
        rows.append(row)
    return rows[-1][-1]


@pytest.mark.parametrize("cells", [0, 12, 10**6])
def test_common_subsequences_are_longest(monkeypatch, cells):
    monkeypatch.setattr(licenses, "TABLE_CELLS", cells)
    words = [list(w) for n in range(5) for w in product("ab", repeat=n)]
    draw = np.random.default_rng(5)
    pairs = list(product(words, words)) + [(draw.choice(list("abc"), n).tolist(), draw.choice(list("abc"), m).tolist()) for n, m in draw.integers(0, 40, (60, 2))]
    for a, b in pairs:
        found = licenses._common_subsequence(a, b)
        assert len(found) == licenses.common_length(a, b) == longest(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found[:-1], found[1:], strict=True))


def test_alignment_pairs_equal_words_in_order():
    draw = np.random.default_rng(6)
    for _ in range(400):
        a, b = (draw.choice(list("abcdefgh"), int(draw.integers(0, 14))).tolist() for _ in range(2))
        found = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in found) and len(found) <= longest(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found[:-1], found[1:], strict=True))


KNOWN = licenses.Templates(licenses.TEMPLATES)


def test_a_notice_after_words_of_its_own():
    text = b"Released under embargo last week now released under the MIT License"
    assert [(p[0], p[1]) for p in KNOWN.passages(text)] == [("MIT", 1.0)]


@pytest.mark.parametrize("name", ["GPL-2.0-text", "GPL-3.0-text"])
def test_license_texts_in_a_row(name):
    text = next(t for n, t in licenses.TEMPLATES.items() if n.startswith(name.removesuffix("-text")) and len(t) > 10_000)
    begin = time.perf_counter()
    found = KNOWN.passages((text + " some words between. ").encode() * 5)
    assert time.perf_counter() - begin < 8
    assert len([p for p in found if p[1] > 0.95]) == 5


def scattered(draw, template):
    """A text of pieces of the template, some changed, between other words."""
    out = []
    for _ in range(int(draw.integers(1, 6))):
        out += [f"o{i}" for i in draw.integers(0, 30, int(draw.integers(0, len(template) * 2)))]
        begin, end = sorted(draw.integers(0, len(template) + 1, 2))
        piece = template[begin:end] if draw.random() < 0.5 else template[:]
        out += [w for w in piece if draw.random() < draw.choice([0.8, 0.9, 1.0])]
    return " ".join(out).encode()


def test_passages_do_not_depend_on_the_size_of_a_table(monkeypatch):
    draw = np.random.default_rng(8)
    for _ in range(150):
        template = [f"w{i}" for i in draw.integers(0, 40, int(draw.integers(8, 60)))]
        known, text = licenses.Templates({"t": " ".join(template)}), scattered(draw, template)
        found = []
        for cells in (0, 300, 10**9):
            monkeypatch.setattr(licenses, "TABLE_CELLS", cells)
            found.append(known.passages(text))
        assert found[0] == found[1] == found[2]


def test_long_templates_find_what_short_ones_find():
    """Passages of four times as long a template, each word drawn out to four, lie at four times the places."""
    draw = np.random.default_rng(9)
    for _ in range(25):
        template = [f"w{i}" for i in range(100)]
        begin = int(draw.integers(0, 21))
        words = [f"o{i}" for i in range(int(draw.integers(0, 300)))] + template[begin : begin + 80]
        words = template[:begin] + [f"p{i}" for i in range(int(draw.integers(0, 90)))] + words + ["q"] * int(draw.integers(0, 200))
        long = lambda ws: " ".join(f"{w}{c}" for w in ws for c in "abcd")
        one = licenses.Templates({"t": " ".join(template)}).passages(" ".join(words).encode())
        four = licenses.Templates({"t": long(template)}).passages(long(words).encode())
        assert one and [(p[1], p[2] * 4, p[3] * 4) for p in one] == [p[1:] for p in four]
