"""Fill-in-the-middle rows against a plain re-implementation, the chunks against the text, odd inputs."""

import hashlib
import re

import numpy as np
import pytest

from homespan.llm import middles

DOCS = "doc_id long, text string, output string, form string, tags map<string,string>"
PASSAGE = "".join(f"line {i % 89} of a passage é 漢 that many texts share\n" for i in range(400))
TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "two\nlines", "ends\n", "a<P>b", "x<" + "S>\n", "almost <P <S <M > P>\n<\nP>", PASSAGE,
    PASSAGE, "before\n" + PASSAGE, PASSAGE + "after", "漢字\né\n" * 30, "x" * 20_000, "y" * 5000 + "\n" + "z" * 9000, "\r\n \r",
]


def plain(doc_id, text, seed=7, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", {"a": "b"}) for i, t in rows], DOCS)


@pytest.mark.parametrize("options", [{}, {"seed": 11, "rate": 40, "spm": 80}])
def test_same_as_plain(spark, options):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc"), (4, "repeated\nid"), (4, "repeated\nid")]
    got = middles.fill_in_middle(docs(spark, rows).repartition(2), **options)
    found = got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    want = [(i, *plain(i, t or "", **options)) for i, t in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    back = got.select(middles.restored(got["output"], got["form"]).alias("text")).collect()
    assert sorted(r[0] for r in back) == sorted(t or "" for _, t in rows)


def test_empty_table(spark):
    assert middles.digest_columns(middles.fill_in_middle(docs(spark, []))).count() == 0


def test_cut_pieces_with_marker_parts(spark):
    texts = ["<\nS>", "<S\n>", "a<\nP>b<\nM>c\n<S", "<<S\n<<\n>"] * 40
    got = middles.fill_in_middle(docs(spark, enumerate(texts)))
    rows = got.select("doc_id", "form", middles.restored(got["output"], got["form"]).alias("text")).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate(texts))
    assert {r["form"] for r in rows} == {"psm", "spm"}


def ends_of(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return [[e - b for e in ends] for b, ends in zip(bounds, middles.chunk_ends(np.frombuffer(b"".join(texts), np.uint8), bounds), strict=False)]


def test_chunks_depend_on_content_alone():
    draw = np.random.default_rng(1)
    shared = draw.integers(32, 127, 60_000, dtype=np.uint8).tobytes()
    own = [draw.integers(32, 127, n, dtype=np.uint8).tobytes() for n in (0, 1, 700, 5000)]
    texts = [o + shared for o in own]
    chunks = []
    for text, ends in zip(texts, ends_of(texts), strict=True):
        assert ends == ends_of([text])[0] and ends[-1] == len(text)
        sizes = np.diff([0, *ends])
        assert sizes.max() <= middles.MOST and (sizes[:-1] >= middles.LEAST).all()
        chunks.append({text[a:b] for a, b in zip([0, *ends], ends, strict=False)})
    for other in chunks[1:]:
        assert len(chunks[0] & other) > 0.9 * len(chunks[0])


def test_rolling_hash_forgets():
    draw = np.random.default_rng(2)
    a, b = (np.concatenate([draw.integers(0, 256, 100), np.arange(200) % 256]).astype(np.uint8) for _ in range(2))
    assert (middles.rolling_hashes(a)[100 + middles.WINDOW :] == middles.rolling_hashes(b)[100 + middles.WINDOW :]).all()


def test_summaries_are_bounded_and_right():
    known = middles.Summaries(most=20_000)
    for i in range(300):
        chunk = (b"row %d\n" % (i % 120)) * 30
        found = known.of(chunk)
        assert (found.size, len(found.ends), found.chars) == (len(chunk), 30, len(chunk))
    assert sum(map(len, known.new)) + sum(map(len, known.old)) <= 25_000


def test_markers_across_a_seam():
    parts = [middles.summarize(c) for c in (b"abc<", b"P>def")]
    assert middles.holds_marker(parts) and not any(p.marked for p in parts)
    assert not middles.holds_marker([middles.summarize(c) for c in (b"abc<", b"Q>def")])
