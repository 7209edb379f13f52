"""Benchmark passages in documents, found by a generalised suffix automaton over item words.

Method. Benchmark items are normalised to words (A-Z lowered; words are runs of digits, letters and
non-ASCII bytes). One suffix automaton holds all runs of words of all items of a block. The words of a
document stream through it: the state and the length of the longest suffix that occurs in an item
are kept word by word. Where that length reaches ``window`` words, the match holds windows of an
item; an item shorter than a window counts when it is matched whole. The items of a window are
those of the automaton state whose run has just that length.

Scale. Documents are never shuffled: each partition is streamed. Items are read in blocks of at most
``BLOCK_WORDS`` words (one longer item stands alone), whose total is counted first; each block makes
one automaton in each Python worker and one pass over the rows, so what is sent to the executors is
bounded by the block, not by the table.

Cases. Null or empty text, or no word: no words, no hits. Items without words match nothing, null
item ids are ignored, repeated items count once by id. Repeated documents come back as often as
they came in. Other columns are kept by ``remove_passages`` and ignored by ``passages``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.llm.common import stored, text_bytes, worker_cache

BLOCK_WORDS = 1_000_000

#: Word bytes are kept, A-Z lowered; every other byte becomes a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton of word runs; states know the items their runs occur in."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.steps: list[dict[bytes, int]] = [{}]
        self.length = [0]
        self.link = [-1]
        paths = []
        for item, words in items:
            if words:
                paths.append((item, words))
                last = 0
                for word in words:
                    last = self._extend(last, word)
        self._name_items(paths)

    def _state(self, length: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.steps) - 1

    def _split(self, at: int, word: bytes, to: int) -> int:
        """A state for the runs of ``to`` that end at ``at`` + word, taken out of ``to``."""
        clone = self._state(self.length[at] + 1, dict(self.steps[to]), self.link[to])
        self.link[to] = clone
        while at >= 0 and self.steps[at].get(word) == to:
            self.steps[at][word] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        to = self.steps[last].get(word)
        if to is not None:  # the run is known from an earlier item
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last >= 0:
            to = self.steps[last][word]
            self.link[new] = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        return new

    def _name_items(self, paths: list[tuple[object, list[bytes]]]) -> None:
        """``marks[s]``: (length, items) of windows that are a suffix of the runs of state s, longest first."""
        window, named = self.window, {}
        for item, words in paths:
            state = held = 0
            for word in words:
                state, held = self.step(state, held, word)
                if held >= window:
                    at = state
                    while self.length[self.link[at]] >= window:
                        at = self.link[at]
                    named.setdefault((at, window), set()).add(item)
            if len(words) < window:
                named.setdefault((state, len(words)), set()).add(item)
        own: dict[int, list[tuple[int, frozenset]]] = {}
        for (state, length), found in named.items():
            own.setdefault(state, []).append((length, frozenset(found)))
        self.marks: list[tuple[tuple[int, frozenset], ...]] = [()] * len(self.steps)
        for state in sorted(range(1, len(self.steps)), key=self.length.__getitem__):
            self.marks[state] = (*sorted(own.get(state, ()), key=lambda m: -m[0]), *self.marks[self.link[state]])
        self.least = [m[-1][0] if m else 1 << 60 for m in self.marks]

    def step(self, state: int, held: int, word: bytes) -> tuple[int, int]:
        to = self.steps[state].get(word)
        if to is not None:
            return to, held + 1
        while state:
            state = self.link[state]
            to = self.steps[state].get(word)
            if to is not None:
                return to, self.length[state] + 1
        return 0, 0

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Word spans [begin, end) covered by windows, merged and in order, and the items that occur."""
        steps, link, length, marks, least = self.steps, self.link, self.length, self.marks, self.least
        root = steps[0]
        spans: list[list[int]] = []
        items: set = set()
        state = held = 0
        for place, word in enumerate(words):
            to = steps[state].get(word)
            if to is not None:
                held += 1
                state = to
            elif not state:
                continue
            else:
                while state:
                    state = link[state]
                    to = root.get(word) if not state else steps[state].get(word)
                    if to is not None:
                        held = length[state] + 1
                        state = to
                        break
                else:
                    held = 0
                    continue
            if held >= least[state]:
                longest = 0
                for size, found in marks[state]:
                    if size <= held:
                        longest = max(longest, held if size == self.window else size)
                        items |= found
                begin = place + 1 - longest
                while spans and spans[-1][0] >= begin:
                    spans.pop()
                if spans and begin <= spans[-1][1]:
                    spans[-1][1] = place + 1
                else:
                    spans.append([begin, place + 1])
        return spans, items


def _automaton(items: tuple[tuple[str, bytes], ...], window: int) -> Automaton:
    return worker_cache((items, window), lambda: Automaton(((i, item_words(t)) for i, t in items), window))


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


FOUND_SQL = "n_words long, spans array<array<int>>, items array<string>"
FOUND = [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))]


def item_blocks(benchmark: DataFrame) -> Iterator[tuple[tuple[str, bytes], ...]]:
    """The items in blocks of at most BLOCK_WORDS words, one block at a time on the driver."""
    items = benchmark.filter("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), text_bytes().alias("text")
    )
    words = items.select("item", "text", (F.floor(F.length("text") / 2) + 1).alias("most_words"))
    total = words.agg(F.sum("most_words")).first()[0] or 0
    blocks = max(1, -(-2 * int(total) // BLOCK_WORDS))
    if blocks > 1:
        words = stored(words.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))))
    for block in range(blocks):
        part = words if blocks == 1 else words.filter(F.col("block") == block)
        yield tuple(sorted({(r["item"], bytes(r["text"])) for r in part.select("item", "text").collect()}))


ADDED = ("n_words", "spans", "items", "scan_text")


def passages(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Add ``n_words``, ``spans`` (word spans [begin, end) inside occurring windows) and ``items`` to each row.

    Columns of these names are replaced.
    """
    return _passages(documents, benchmark, window)


def _passages(documents: DataFrame, benchmark: DataFrame, window: int, finish: Callable | None = None) -> DataFrame:
    """``finish`` takes and gives batches in the columns of ``documents`` and runs with the last block's scan."""
    documents = documents.drop(*ADDED)
    now = documents.withColumn("scan_text", text_bytes())
    blocks = item_blocks(benchmark)
    block, again = next(blocks), False
    for following in blocks:
        now = _scan_block(now, block, window, again)
        block, again = following, True
    if finish is None:
        return _scan_block(now, block, window, again).drop("scan_text")
    return _scan_block(now, block, window, again, finish, documents.schema)


def _scan_block(
    rows: DataFrame,
    block: tuple,
    window: int,
    again: bool,
    finish: Callable | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(sent.value, window)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("scan_text")).to_pylist()
            kept = batch.select([n for n in batch.schema.names if n not in ("n_words", "spans", "items")])
            old = batch.select(["spans", "items"]).to_pylist() if again else None
            counts, spans, items = [], [], []
            for i, text in enumerate(texts):
                words = item_words(text)
                got, which = machine.scan(words)
                if old:
                    got = _merged([*got, *old[i]["spans"]])
                    which |= set(old[i]["items"])
                counts.append(len(words))
                spans.append(got)
                items.append(sorted(which))
            if finish is not None:
                yield finish(kept, counts, spans)
                continue
            columns = [pa.array(x, t) for x, (_, t) in zip((counts, spans, items), FOUND, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*kept.schema.names, *(n for n, _ in FOUND)])

    if schema is None:
        kept = [f for f in rows.schema if f.name not in ("n_words", "spans", "items")]
        schema = T.StructType([*kept, *T.StructType.fromDDL(FOUND_SQL)])
    return rows.mapInArrow(scanned, schema)


def hit_words(spans: str = "spans") -> Column:
    """Number of words inside the spans of a row."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))


def cut_spans(text: str | None, spans: list[list[int]]) -> str | None:
    if not spans or text is None:
        return text
    raw = text.encode()
    marked = raw.translate(_TABLE)
    begins, at = [], 0
    for word in marked.split():
        at = marked.index(word, at)
        begins.append(at)
        at += len(word)
    begins.append(len(raw))
    kept, last = [], 0
    for begin, end in spans:
        kept.append(raw[last : begins[begin]])
        last = begins[end]
    return b"".join([*kept, raw[last:]]).decode()


def remove_passages(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, longest: int = 0, coverage: float = 0.5
) -> DataFrame:
    """Documents without benchmark passages, in the columns they came in.

    A document whose words lie in passages by more than ``coverage`` goes; from the others, every
    passage of more than ``longest`` words is cut out, and ``n_chars``, if there, is counted anew.
    """
    private = {c: f"of documents: {c}" for c in documents.columns if c.lower() in ADDED}
    documents = documents.withColumnsRenamed(private)
    names = documents.columns

    def clean(batch: pa.RecordBatch, counts: list[int], spans: list[list[list[int]]]) -> pa.RecordBatch:
        covered = [sum(end - begin for begin, end in found) for found in spans]
        stay = [i for i, (hit, n) in enumerate(zip(covered, counts, strict=True)) if hit <= n * coverage]
        batch = batch.select(names).take(pa.array(stay, pa.int64()))
        place = batch.schema.get_field_index("text")
        texts = batch.column(place).to_pylist()
        cut = [cut_spans(t, [s for s in spans[i] if s[1] - s[0] > longest]) for t, i in zip(texts, stay, strict=True)]
        return batch.set_column(place, batch.schema.field(place), pa.array(cut, batch.schema.field(place).type))

    clean_rows = _passages(documents, benchmark, window, clean)
    if "n_chars" in names:
        changed = F.length("text").cast(documents.schema["n_chars"].dataType)
        clean_rows = clean_rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return clean_rows.withColumnsRenamed({p: c for c, p in private.items()})


def digest_columns(found: DataFrame) -> DataFrame:
    """The result of ``passages`` as counts and a digest of the items."""
    hits = hit_words()
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )
