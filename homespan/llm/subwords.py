"""Subword ids of many texts from public tokenizer files, with a cache of words per Python worker.

The tokenizers cut at white space before anything else, so the ids of a text are those of its words between
ASCII white space, one after the other; each distinct word is encoded once while it stays in the cache.
The cache is emptied when it exceeds ``most_words`` words, which changes no result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable
from itertools import chain, repeat

import numpy as np

from homespan.llm.common import GOLD, worker_cache


def _numbered(words: Iterable[bytes]) -> tuple[dict[bytes, int], list[int]]:
    """Distinct words by first place, and the number of each word."""
    numbers: dict[bytes, int] = {}
    return numbers, [numbers.setdefault(w, len(numbers)) for w in words]


class WordCache:
    """Ids of words; subclasses encode words that are new."""

    size: int
    most_words = 200_000

    def __init__(self) -> None:
        self._empty()

    def _empty(self) -> None:
        self.place: dict[bytes, int] = {}
        self.pool = array("I")
        self.begins = array("q", [0])

    def _encode_new(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has."""
        raise NotImplementedError

    def _learn(self, words: list[bytes]) -> None:
        ids, sizes = self._encode_new(words)
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        ends = np.cumsum(sizes, dtype=np.int64) + len(self.pool)
        self.pool.frombytes(ids.astype(np.uint32).tobytes())
        self.begins.frombytes(ends.tobytes())

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the cache of the words of all texts, and where each text's words begin (one more at the end)."""
        cut = [t.lower().split() for t in texts]
        flat = list(chain.from_iterable(cut))
        at = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0)
        numbers, told = _numbered(map(flat.__getitem__, missing.tolist()))
        if numbers and len(self.place) + len(numbers) > self.most_words:
            self._empty()
            missing = np.arange(len(flat))
            numbers, told = _numbered(flat)
        if numbers:
            at[missing] = np.array(told, np.int64) + len(self.place)
            self._learn(list(numbers))
        return at, np.concatenate([[0], np.cumsum([len(w) for w in cut], dtype=np.int64)]).astype(np.int64)

    def sizes_at(self, at: np.ndarray) -> np.ndarray:
        """Numbers of ids of words by their places."""
        return np.diff(np.array(self.begins, np.int64))[at]

    def ids_at(self, at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each text begins (one more at the end)."""
        pool, begins = np.array(self.pool, np.uint32), np.array(self.begins, np.int64)
        starts, sizes = begins[at], begins[at + 1] - begins[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        return ids, np.concatenate([[0], ends])[first]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.ids_at(*self.words(texts))


class Subwords(WordCache):
    """Ids of a file of the library tokenizers; texts that hold the opening of a special token are encoded whole.

    Words of simple letters, digits and marks are cut by a pattern and merged by tiktoken, many at a time, if
    the file's pieces are numbered in the order of their merges and each piece, encoded alone, is itself. Then both
    libraries merge alike: within the span of a piece the same merges come first, so two neighbours that make up a
    piece are the two that its own merge names. All other words, and other files, go to the file's own library.
    """

    most_words = 300_000

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.runs = Runs(path) if _merges_in_order(path, self.tokenizer) else None

    def _encode_new(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = b"\n".join(words).decode().split("\n")
        runs = _simple_runs(texts) if self.runs else [None] * len(texts)
        other = self.tokenizer.encode_batch_fast(
            [t for t, r in zip(texts, runs, strict=True) if r is None], add_special_tokens=False
        )
        simple = np.array([r is not None for r in runs])
        sizes = np.zeros(len(words), np.int64)
        sizes[~simple] = [len(e.ids) for e in other]
        told = np.zeros(0, np.uint32)
        if simple.any():
            told, sizes[simple] = self.runs.encode([r for r in runs if r is not None])
        ids = np.zeros(int(sizes.sum()), np.uint32)
        whose = np.repeat(simple, sizes)
        ids[whose] = told
        ids[~whose] = np.fromiter(chain.from_iterable(e.ids for e in other), np.uint32)
        return ids, sizes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = [i for i, t in enumerate(texts) if b"<|" in t]
        if not whole:
            return super().encode(texts)
        ids, bounds = super().encode([b"" if b"<|" in t else t for t in texts])
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


WORD_END = "\0"
#: Lower-case letters that no normalisation changes, single digits, and runs of marks: what the file's own pattern cuts alike.
_MARKS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
_SIMPLE = re.compile(rf"[a-zß-öø-ÿ]+|[0-9]|[{_MARKS}]+")
_SIMPLE_OR_LINE = re.compile(rf"{_SIMPLE.pattern}|\n")
_NOT_SIMPLE = re.compile(rf"[^a-zß-öø-ÿ0-9{_MARKS}]")


def _simple_runs(words: list[str]) -> list[str | None]:
    """Runs of simple words parted by word ends; none for other words. Words hold no line ends and are not empty."""
    out: list[str | None] = [w if w.isascii() and w.isalpha() else None for w in words]
    mixed = [i for i, w in enumerate(out) if w is None]
    mixed = [i for i in mixed if not _NOT_SIMPLE.search(words[i])]
    if mixed:
        found = WORD_END.join(_SIMPLE_OR_LINE.findall("\n".join([words[i] for i in mixed])))
        for i, runs in zip(mixed, found.replace(f"{WORD_END}\n{WORD_END}", "\n").split("\n"), strict=True):
            out[i] = runs
    return out


_RUNS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+|\s+")
#: What a text may not hold beside word ends, and how it is written instead, so that different words differ.
_ESCAPED = {0: "\1\3", 1: "\1\2"} | {0xDC00 + b: "\1" + chr(0x100 + b) for b in range(128, 256)}
_ODD = re.compile("[\0\1\udc80-\udcff]")


def _merges_in_order(path: str, tokenizer: object) -> bool:
    """Whether the file cuts text as ``_SIMPLE`` does, numbers pieces by their merges, and gives each piece for itself."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    vocabulary, model = stored["model"]["vocab"], tokenizer.model
    merges = stored["model"].get("merges", [])
    numbers = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if stored["model"].get("end_of_word_suffix") != "</w>" or numbers != sorted(numbers) or not numbers:
        return False
    singles = {p.removesuffix("</w>") for p, n in vocabulary.items() if n < numbers[0]}
    if any(len(p) != 1 for p in singles) or not set(_byte_letters().values()) <= singles:
        return False
    probe = "ab,.cé 12;:x!?y()z ÿß #$%&*+-/<=>@[ ]^_`{|}~ \"a\\"
    pieces = _SIMPLE.findall(probe)
    cut = [t for t, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(probe))]
    letters = _byte_letters()
    if cut != ["".join(letters[b] for b in p.encode()) for p in pieces]:
        return False
    whole = (p.removesuffix("</w>") for p in vocabulary if p.endswith("</w>"))
    return all([t.id for t in model.tokenize(p)] == [vocabulary[p + "</w>"]] for p in whole)


class Runs:
    """Ids of runs of characters over the vocabulary of a file with word ends, merged by tiktoken."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary, added = stored["model"]["vocab"], {t["content"]: t["id"] for t in stored["added_tokens"]}
        byte_of = {c: b for b, c in _byte_letters().items()}
        ranks = {}
        for piece, number in vocabulary.items():
            body = piece.removesuffix("</w>")
            if all(c in byte_of for c in body):
                ranks[bytes(byte_of[c] for c in body) + WORD_END.encode() * (body != piece)] = number
        alone = max(*vocabulary.values(), *added.values()) + 1
        ranks.setdefault(WORD_END.encode(), alone)
        self.size, self.end_id = alone + 1, added["<|endoftext|>"]
        self.closes = np.zeros(self.size, bool)
        self.closes[[number for piece, number in ranks.items() if piece.endswith(WORD_END.encode())]] = True
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[str], runs: Iterable[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words whose runs are parted by word ends, and how many each word has; ``runs``: its numbers of runs."""
        ids = self.encoding.encode_to_numpy(WORD_END.join(words) + WORD_END)
        run_ends = np.flatnonzero(self.closes[ids]) + 1
        word_ends = run_ends[np.cumsum([w.count(WORD_END) + 1 for w in words] if runs is None else runs) - 1]
        return ids, np.diff(word_ends, prepend=0)


#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class ShortWords:
    """Places of words of up to 16 bytes by those bytes, one word a slot. A word that is not held has the place -1."""

    def __init__(self, bits: int = 18):
        self.shift = np.uint64(64 - bits)
        self.low, self.high = (np.zeros(1 << bits, np.uint64) for _ in range(2))
        self.place = np.full(1 << bits, -1, np.int64)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (((low ^ (high * np.uint64(0x94D049BB133111EB))) * GOLD) >> self.shift).view(np.int64)

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        slots = self._slots(low, high)
        return np.where((self.low[slots] == low) & (self.high[slots] == high), self.place[slots], -1)

    def hold(self, low: np.ndarray, high: np.ndarray, places: np.ndarray) -> None:
        """Without words of which no bytes are told (zeros)."""
        told = low > 0
        slots = self._slots(low[told], high[told])
        last = np.zeros(len(self.place), np.int64)
        last[slots] = np.arange(len(slots))
        last = last[slots]  # one word for words that share a slot
        self.low[slots], self.high[slots], self.place[slots] = low[told][last], high[told][last], places[told][last]


def _first_bytes(data: bytes, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes 1 to 8 and 9 to 16 of words, as numbers; zeros for longer words, and for all if there are zero bytes."""
    if b"\0" in data:
        return np.zeros(len(begins), np.uint64), np.zeros(len(begins), np.uint64)
    at = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    short = sizes <= 16
    low = at[begins] & _FIRST_BYTES[np.where(short, np.minimum(sizes, 8), 0)]
    return low, at[begins + 8] & _FIRST_BYTES[np.where(short, np.maximum(sizes, 8) - 8, 0)]


class LetterRuns(WordCache):
    """Pieces of runs of letters, digits and marks.

    They need not be those of the file's own library, which normalises characters. Different words have different
    ids, also where bytes are no UTF-8. Words are cut and short ones looked up many at a time.
    """

    most_words = 400_000

    def __init__(self, path: str):
        super().__init__()
        self.runs = Runs(path)
        self.size, self.end_id = self.runs.size, self.runs.end_id

    def _empty(self) -> None:
        super()._empty()
        self.short = ShortWords()

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = b"\n".join([b"", *texts, b" " * 16]).lower()
        raw = np.frombuffer(data, np.uint8)
        space = (raw == 32) | (raw - np.uint8(9) < 5)
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        begins, ends = edges[::2], edges[1::2]
        first = np.searchsorted(begins, np.cumsum([1, *(len(t) + 1 for t in texts)]))
        low, high = _first_bytes(data, begins, ends - begins)
        at = self.short(low, high)
        while True:
            missing = np.flatnonzero(at < 0)
            flat = [data[b:e] for b, e in zip(begins[missing].tolist(), ends[missing].tolist(), strict=True)]
            found = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
            new = np.flatnonzero(found < 0)
            unknown = [flat[i] for i in new.tolist()]
            distinct = list(dict.fromkeys(unknown))
            if not distinct or not self.place or len(self.place) + len(distinct) <= self.most_words:
                break
            self._empty()
            at[:] = -1
        if distinct:
            self._learn(distinct)
            found[new] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        at[missing] = found
        self.short.hold(low[missing], high[missing], found)
        return at, first

    def _encode_new(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b"\n".join(words).decode("utf-8", "surrogateescape")
        if _ODD.search(text):
            text = text.translate(_ESCAPED)
        told = text.split("\n")
        runs = np.ones(len(told), np.int64)
        for i in [i for i, w in enumerate(told) if not w.isalpha()]:
            parts = _RUNS.findall(told[i])
            told[i], runs[i] = WORD_END.join(parts), len(parts)
        return self.runs.encode(told, runs)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where printable, else from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def subwords(path: str) -> Subwords:
    """One tokenizer and cache per worker and file."""
    return worker_cache(("subwords", path), lambda: Subwords(path))


def letter_runs(path: str) -> LetterRuns:
    return worker_cache(("letter runs", path), lambda: LetterRuns(path))
