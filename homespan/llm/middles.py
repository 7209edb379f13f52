"""Fill-in-the-middle rows: texts cut at line ends, their pieces reordered around markers.

Method. A rolling hash over the bytes cuts texts into chunks whose ends depend on content alone, so texts that share
passages share chunks. A worker keeps a summary of each chunk it has seen, looked up by the chunk's bytes, so that a
shared chunk is known only when every byte agrees: its line ends, its code points, whether it holds a marker and its
outer bytes, by which markers across a seam are seen. Adding up the summaries gives a text's units, and adding them in
order finds the chunk in which a cut lies; the cached line ends give the place in it.

Scale. One pass without a shuffle. A worker holds one text's chunks and at most ``CACHE_BYTES`` of shared ones in two
generations; what the cache holds changes time, never results, so a task that is run again gives the same rows.

Cases. Null or empty text: no units, plain. A text that holds a marker is plain: its output is the text itself. Null
ids are hashed as the empty text. Repeated rows give equal rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import emit, in_chunks, text_bytes, worker_cache

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW = 32
BITS = 9
LEAST, MOST = 128, 4096
CACHE_BYTES = 24_000_000
PART_BYTES = 1_000_000

_random = np.random.default_rng(20250711)
_GEAR = _random.integers(0, 2**63, 256, dtype=np.uint64)
_MARKER = re.compile(b"|".join(m.encode() for m in (PREFIX, SUFFIX, MIDDLE)))
_CONTINUED = bytes(range(0x80, 0xC0))

ROWS_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.binary())]
)


@dataclass(frozen=True, slots=True)
class Summary:
    """What a chunk tells about cuts: its size, places after its line ends, code points, and what it holds of markers."""

    size: int
    ends: np.ndarray
    chars: int
    marked: bool
    head: bytes
    tail: bytes


def summarize(chunk: bytes) -> Summary:
    ends = np.flatnonzero(np.frombuffer(chunk, np.uint8) == 10).astype(np.int32) + 1
    return Summary(len(chunk), ends, code_points(chunk), bool(_MARKER.search(chunk)), chunk[:2], chunk[-2:])


def code_points(text: bytes) -> int:
    return len(text.translate(None, _CONTINUED))


class Summaries:
    """Summaries by content, the last used in two generations of half the bound each."""

    def __init__(self, most: int = CACHE_BYTES):
        self.new, self.old, self.held, self.half = {}, {}, 0, most // 2

    def of(self, chunk: bytes) -> Summary:
        if (known := self.new.get(chunk)) is None:
            known = self.old.get(chunk) or summarize(chunk)
            if self.held > self.half:
                self.new, self.old, self.held = {}, self.new, 0
            self.new[chunk] = known
            self.held += len(chunk) + 8 * len(known.ends) + 200
        return known


def rolling_hashes(raw: np.ndarray) -> np.ndarray:
    """At every byte, a hash of the last ``WINDOW`` bytes up to it (of fewer at the begin), doubling the window at each step."""
    rolled, span = _GEAR[raw], 1
    while span < WINDOW:
        rolled[span:] += rolled[:-span] * np.uint64(0x9E3779B97F4A7C15 ** span % 2**64)
        span *= 2
    return rolled


def chunk_ends(raw: np.ndarray, bounds: np.ndarray) -> Iterator[list[int]]:
    """Ends of the chunks of each text; ``bounds`` are the texts' begins and the last one's end.

    A chunk ends where the hash's top bits are zero, not before ``LEAST`` bytes and at ``MOST`` at the latest. The window
    reaches into the text before only within the first ``WINDOW`` bytes, where no chunk ends.
    """
    fits = np.flatnonzero(rolling_hashes(raw) >> np.uint64(64 - BITS) == 0) + 1
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = fits[np.searchsorted(fits, begin + LEAST) : np.searchsorted(fits, end)].tolist()
        ends, at = [], begin
        for fit in own:
            while fit - at > MOST:
                at += MOST
                ends.append(at)
            if fit - at >= LEAST:
                at = fit
                ends.append(at)
        while end - at > MOST:
            at += MOST
            ends.append(at)
        if end > at:
            ends.append(end)
        yield ends


def cut_after(text: bytes, parts: list[Summary], ends: list[int], lines: np.ndarray, chars: np.ndarray, units: int) -> tuple[int, int]:
    """Bytes and code points of the first ``units`` units; ``lines`` and ``chars`` count those before each chunk, and all."""
    if units > lines[-1]:
        return len(text), int(chars[-1])
    which = max(0, int(np.searchsorted(lines, units)) - 1)
    inside = int(parts[which].ends[units - int(lines[which]) - 1]) if units else 0
    begin = ends[which - 1] if which else 0
    return begin + inside, int(chars[which]) + code_points(text[begin : begin + inside])


def before_each(counts: Iterable[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(counts, np.int64))])


def holds_marker(parts: list[Summary]) -> bool:
    if any(p.marked for p in parts):
        return True
    return any(b"<" in a.tail and _MARKER.search(a.tail + b.head) for a, b in zip(parts[:-1], parts[1:], strict=True))


def rearranged(text: bytes, first: int, second: int, form: str) -> bytes:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    return p + prefix + s + suffix + m + middle if form == "psm" else s + suffix + p + prefix + m + middle


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, text: bytes, parts: list[Summary], ends: list[int], seed: int, rate: int, spm: int) -> tuple:
    """A row of ``ROWS`` for one text, given the summaries and the ends of its chunks (counted from its begin)."""
    lines = before_each(len(p.ends) for p in parts)
    n = int(lines[-1]) + (bool(text) and not text.endswith(b"\n"))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or holds_marker(parts):
        return doc_id, n, "plain", None, None, text
    chars = before_each(p.chars for p in parts)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, first_chars = cut_after(text, parts, ends, lines, chars, low)
    second, second_chars = cut_after(text, parts, ends, lines, chars, high)
    form = "spm" if h4 % 100 < spm else "psm"
    return doc_id, n, form, first_chars, second_chars - first_chars, rearranged(text, first, second, form)


def _rows(batches: Iterable[pa.RecordBatch], seed: int, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    known = worker_cache("chunk summaries", Summaries)
    for batch in batches:
        ids, texts = (c.to_pylist() for c in batch.columns)
        for part in in_chunks(map(len, texts), PART_BYTES):
            told = texts[part]
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in told])]).astype(np.int64)
            raw = np.frombuffer(b"".join(told), np.uint8)
            out = []
            for doc_id, text, begin, ends in zip(ids[part], told, bounds.tolist(), chunk_ends(raw, bounds), strict=False):
                own = [e - begin for e in ends]
                parts = [known.of(text[a:b]) for a, b in zip([0, *own], own, strict=False)]
                out.append(transform(doc_id, text, parts, own, seed, rate, spm))
            if out:
                yield emit(dict(zip(ROWS.names, zip(*out, strict=True), strict=True)), ROWS)


def fill_in_middle(documents: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``documents(doc_id, text)``.

    A text is cut after two drawn numbers of its ``n`` lines into prefix, middle and suffix. ``rate`` percent of texts are
    rearranged, ``spm`` percent of these with the suffix first; all others are ``plain``.
    """
    rows = documents.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    made = rows.mapInArrow(lambda b: _rows(b, seed, rate, spm), ROWS_SQL)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text again. No piece holds a marker, so each marker's first occurrence is its own."""
    inner = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    head, middle = _split(inner, MIDDLE)
    psm_prefix, psm_suffix = _split(head, SUFFIX)
    spm_suffix, spm_prefix = _split(head, PREFIX)
    return (
        F.when(form == "psm", F.concat(psm_prefix, middle, psm_suffix))
        .when(form == "spm", F.concat(spm_prefix, middle, spm_suffix))
        .otherwise(output)
    )


def _split(text: Column, marker: str) -> tuple[Column, Column]:
    before = F.substring_index(text, marker, 1)
    return before, F.substring(text, F.length(before) + len(marker) + 1, F.length(text))


def digest_columns(rows: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
