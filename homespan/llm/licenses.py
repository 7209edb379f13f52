"""License notices in documents, measured by patience alignment with known texts.

Method. Text and template are words (A-Z lowered runs of letters, digits and non-ASCII bytes). Patience alignment
takes the words that are unique in both as anchors, keeps the longest increasing subsequence of their places, and
aligns the gaps between anchors again; a gap without anchors gives up its common ends and is then aligned in full,
by rows of bits of which ``TABLE_CELLS`` are held at a time and others made again. Coverage is the share of template
words that are aligned. The same steps are taken at every length of text and template.

Where to align. A passage that covers at least ``coverage`` of a template lacks fewer than ``m`` of its words, so
one of its ``m`` least frequent distinct words is in it; every place of such a word is looked at in a stretch of
twice the template's length to both sides, and half a length more to the right, so that a stretch without passages
settles the places in that half too. A stretch whose longest common subsequence with the template is too short by k
words settles the places fewer than k words farther on, as each of these words adds one at most. All passages
are found; of overlapping ones that with more words aligned, then with more coverage, then the earlier, stays.

Scale. A map over the rows with whole texts; templates are a bounded parameter.

Cases. Null or empty text has no passages. Templates without words are refused. Repeated rows come back as often
as they came in; other columns are kept, a column ``licenses`` is replaced.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from itertools import islice
from math import ceil
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from homespan.llm.decontamination import item_words

COVERAGE = 0.8
TABLE_CELLS = 400_000

#: Short statements and file notices; ``license_texts.json`` adds other statements, file notices and whole license texts.
TEMPLATES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
}
TEMPLATES |= json.loads(Path(__file__).with_name("license_texts.json").read_text())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (x, y), sorted by x, with y increasing."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        before.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(y)
            ends.append(i)
        else:
            tops[at], ends[at] = y, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _rows(a: list, b: list, row: int) -> Iterator[int]:
    """Rows of the table of common subsequences after each word of a: bit j is 0 where b[j] adds one to the length."""
    marks: dict = {}
    for j, word in enumerate(b):
        marks[word] = marks.get(word, 0) | 1 << j
    whole = (1 << len(b)) - 1
    for word in a:
        if same := row & marks.get(word, 0):
            row = ((row + same) | (row - same)) & whole
        yield row


def common_length(a: list, b: list) -> int:
    """Length of a longest common subsequence, a row of the table held in the bits of one number."""
    row = whole = (1 << len(b)) - 1
    for row in _rows(a, b, whole):
        pass
    return len(b) - row.bit_count()


def _common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence, read from the table's end; TABLE_CELLS of it are held, others made again."""
    step = max(1, TABLE_CELLS // max(1, len(b)))
    whole = (1 << len(b)) - 1
    firsts = [whole, *islice(_rows(a[: (len(a) - 1) // step * step], b, whole), step - 1, None, step)]
    out, i, j, rows, low = [], len(a), len(b), [], len(a)
    while i and j:
        if i <= low:
            low = (i - 1) // step * step
            rows = [firsts[low // step], *_rows(a[low:i], b, firsts[low // step])]
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif ((rows[i - 1 - low] ^ rows[i - low]) & ((1 << j) - 1)).bit_count() & 1:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Pairs of places (in text, in template) whose words agree, both increasing."""
    if not text or not template:
        return []
    lead = 0
    while lead < min(len(text), len(template)) and text[lead] == template[lead]:
        lead += 1
    trail = 0
    while trail < min(len(text), len(template)) - lead and text[-1 - trail] == template[-1 - trail]:
        trail += 1
    head = [(i, i) for i in range(lead)]
    tail = [(len(text) - k, len(template) - k) for k in range(trail, 0, -1)]
    a, b = text[lead : len(text) - trail], template[lead : len(template) - trail]
    inner: list[tuple[int, int]] = []
    if a and b:
        seen_a, seen_b = Counter(a), Counter(b)
        places = {w: j for j, w in enumerate(b) if seen_b[w] == 1}
        anchors = increasing([(i, places[w]) for i, w in enumerate(a) if seen_a[w] == 1 and w in places])
        if anchors:
            i = j = 0
            for x, y in [*anchors, (len(a), len(b))]:
                inner += [(i + p, j + q) for p, q in align(a[i:x], b[j:y])]
                if x < len(a):
                    inner.append((x, y))
                i, j = x + 1, y + 1
        else:
            inner = _common_subsequence(a, b)
    return [*head, *((lead + p, lead + q) for p, q in inner), *tail]


class Templates:
    def __init__(self, texts: Mapping[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.words = {name: item_words(text.encode()) for name, text in texts.items()}
        if empty := [n for n, w in self.words.items() if not w]:
            raise ValueError(f"templates without words: {empty}")
        by_length = {name: sorted(words, key=lambda w: (-len(w), w)) for name, words in self.words.items()}
        self.distinct = {name: Counter(words) for name, words in by_length.items()}

    def passages(self, text: bytes | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, last word + 1) of every passage, in order."""
        words = item_words(text or b"")
        seen = Counter(words)
        found = []
        for name, template in self.words.items():
            counts = self.distinct[name]
            size = len(template)
            if len(words) < self.coverage * size or self._lacks_too_much(counts, size, seen):
                continue
            found += self._aligned(name, template, counts, words, seen)
        kept: list[tuple[str, float, int, int]] = []
        for p in sorted(found, key=lambda p: (-round(len(self.words[p[0]]) * p[1]), -p[1], p[2], p[0])):
            if all(p[3] <= q[2] or p[2] >= q[3] for q in kept):
                kept.append(p)
        return sorted(kept, key=lambda p: (p[2], p[0]))

    def _lacks_too_much(self, counts: Counter, size: int, seen: Counter) -> bool:
        """Whether a text with the words ``seen`` has too few to align; long words, which are rarer, are looked up first."""
        left = size
        for word, n in counts.items():
            if (there := seen.get(word, 0)) < n:
                left -= n - there
                if left < self.coverage * size:
                    return True
        return False

    def _aligned(self, name: str, template: list, counts: Counter, words: list, seen: Counter) -> list[tuple]:
        size = len(template)
        may_lack = int((1 - self.coverage) * size + 1e-9)
        rare = sorted(counts, key=lambda w: (seen[w], w))
        chosen, lacked = set(), 0
        for word in rare:  # as many words as a passage cannot all lack
            chosen.add(word)
            lacked += counts[word]
            if lacked > may_lack:
                break
        places = [i for i, w in enumerate(words) if w in chosen]
        out: list[tuple] = []
        done, empty, beyond = -1, None, -1
        for place in places:
            stretch = max(0, place - 2 * size, done), min(place + 2 * size + size // 2 + 1, len(words))
            if place < max(done, beyond) or stretch == empty:
                continue
            lacking = self._lacking(name, template, words[slice(*stretch)])
            found = [] if lacking else self._within(name, template, words, *stretch)
            out += found
            empty = None if found else stretch
            done = max([done, *(p[3] for p in found)])
            if not found:
                beyond = place + max(lacking, size // 2 + 1)
        return out

    def _lacking(self, name: str, template: list, words: list) -> int:
        """By how many words the longest common subsequence is too short for a passage; of words in any order, if these do."""
        seen = Counter(words)
        least = self.coverage * len(template)
        for most in (
            lambda: sum(min(n, seen.get(w, 0)) for w, n in self.distinct[name].items()),
            lambda: common_length(words, template),
        ):
            if (lacking := least - most()) > 0:
                return ceil(lacking)
        return 0

    def _within(self, name: str, template: list, words: list, low: int, high: int) -> list[tuple]:
        """The passage that the alignment of a stretch finds, and those left and right of it."""
        size = len(template)
        least = self.coverage * size
        while not self._lacking(name, template, stretch := words[low:high]):
            if len(stretch) > size + 2 * _slack(size):
                near = low + _likely_begin(stretch, template)
                inner = max(low, near - _slack(size)), min(high, near + size + _slack(size))
                if found := self._within(name, template, words, *inner):
                    sides = (low, found[0][2]), (found[-1][3], high)
                    left, right = (self._within(name, template, words, *side) for side in sides)
                    return [*left, *found, *right]
            pairs = align(stretch, template)
            if len(pairs) < least:
                return []
            pairs = _densest(pairs, least, size)
            begin, end = low + pairs[0][0], low + pairs[-1][0] + 1
            if end - begin > 2 * size:  # words far apart: the passage, if any, lies on one side of the widest gap
                if not self._near_enough(name, stretch, size):
                    return []
                gap = max(range(1, len(pairs)), key=lambda k: (pairs[k][0] - pairs[k - 1][0], min(k, len(pairs) - k)))
                middle = low + pairs[gap - 1][0] + 1
                if middle - low < least:
                    low = middle
                elif high - middle < least:
                    high = middle
                else:
                    sides = (low, middle), (middle, high)
                    return [p for side in sides for p in self._within(name, template, words, *side)]
                continue
            lacking = size - len(pairs)
            if lacking:  # words like those at its ends, farther away, may have been aligned in their place
                near = max(low, begin - lacking)
                again = align(words[near : min(high, end + lacking)], template)
                if len(again) > len(pairs):
                    pairs, begin, end = again, near + again[0][0], near + again[-1][0] + 1
            here = (name, len(pairs) / size, begin, end)
            left, right = (self._within(name, template, words, a, b) for a, b in ((low, begin), (end, high)))
            return [*left, here, *right]
        return []

    def _near_enough(self, name: str, words: list, size: int) -> bool:
        """Whether twice the template's length holds enough of its words, in any order, somewhere."""
        counts, seen, held = self.distinct[name], Counter(), 0
        for i, word in enumerate(words):
            seen[word] += 1
            held += seen[word] <= counts.get(word, 0)
            if i >= 2 * size:
                gone = words[i - 2 * size]
                held -= seen[gone] <= counts.get(gone, 0)
                seen[gone] -= 1
            if held >= self.coverage * size:
                return True
        return False


def _slack(size: int) -> int:
    return size // 4 + 8


def _likely_begin(words: list, template: list) -> int:
    """Where the template would begin by most of the words that are seldom in both: the place that they agree on."""
    here, there = {}, {}
    for told, side in ((words, here), (template, there)):
        for i, word in enumerate(told):
            side.setdefault(word, []).append(i)
    shifts = [i - j for w, js in there.items() if len(js) * len(here.get(w, ())) <= 64 for i in here.get(w, ()) for j in js]
    if not shifts:
        return 0
    wide = max(8, len(template) // 20)
    bins = np.array(shifts, np.int64) // wide
    values, counts = np.unique(bins, return_counts=True)
    return max(0, int(values[counts.argmax()]) * wide)


def _densest(pairs: list[tuple[int, int]], least: float, size: int) -> list[tuple[int, int]]:
    """Drop aligned words at the ends that lie far from the rest, as long as enough remain."""
    while len(pairs) - 1 >= least and pairs[1][0] - pairs[0][0] > max(4, size // 4):
        pairs = pairs[1:]
    while len(pairs) - 1 >= least and pairs[-1][0] - pairs[-2][0] > max(4, size // 4):
        pairs = pairs[:-1]
    return pairs


FOUND_SQL = "licenses array<struct<license:string,coverage:double,first_word:long,end_word:long>>"
FOUND_ARROW = pa.list_(
    pa.struct(
        [("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]
    )
)


def scan_licenses(
    documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, column: str = "text"
) -> DataFrame:
    """Add ``licenses``: every passage of a template with its coverage and its word span."""
    documents = documents.drop("licenses")
    known = Templates(templates, coverage)
    names = ("license", "coverage", "first_word", "end_word")

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            found = [[dict(zip(names, p, strict=True)) for p in known.passages(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, FOUND_ARROW)], [*batch.schema.names, "licenses"]
            )

    return documents.mapInArrow(scanned, T.StructType([*documents.schema, *T.StructType.fromDDL(FOUND_SQL)]))
