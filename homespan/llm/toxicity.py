"""Toxicity categories from a classifier chain.

Method. The categories are predicted one after the other. Each has a logistic model over the presence of
words and word beginnings that its training rows tie to the category, over a few surface measures, and over the log-odds of all
earlier categories. While training, those come from out-of-fold models, so that a later model sees
earlier probabilities as good as they will be on new text; at prediction they come from the final models.

Bounds. Models are fitted on at most ``TRAIN_ROWS`` labelled rows (smallest hash of the id first) and keep at
most ``MOST_WORDS`` words each, chosen by how far a word's share in the category is from its share outside
(a z value of at least ``LEAST_Z``). Prediction streams whole texts and shuffles nothing.

Cases. Null or empty text: probabilities of a text without words. A category that training rows never or
always show gets that constant. Null labels are left out of that category's training. Repeated rows
come back as often as they came in; other columns are kept, clashing names are refused.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.llm.common import free_worker_cache, text_bytes

TRAIN_ROWS = 6000
MOST_WORDS = 2000
LEAST_Z = 4.0
FOLDS = 4
PENALTY = 0.02
TOXIC_FROM = 0.5

#: (category, label column, value that shows the category), in the order of the chain
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))

#: Word bytes are kept, A-Z lowered; every other byte becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UPPER = bytes(range(65, 91))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()")


def distinct_words(text: bytes) -> set[bytes]:
    """Words and, marked, their first four and five bytes, which catch inflected and compound forms."""
    words = set(text.translate(_TABLE).split())
    return words | {b"^" + w[:4] for w in words} | {b"^" + w[:5] for w in words}


def measures(text: bytes, distinct: int) -> list[float]:
    """Upper-case share, mark share, repetition."""
    n = len(text) + 1
    words = 2 * (text.count(b" ") + text.count(b"\n") + 1)
    upper = len(text) - len(text.translate(None, _UPPER))
    marks = len(text) - len(text.translate(None, _MARKS))
    return [upper / n, min(1.0, 5 * marks / n), 1 - min(1.0, distinct / words)]


@dataclass
class Logistic:
    words: dict[bytes, float]
    dense: np.ndarray
    bias: float

    def log_odds(self, words: set[bytes], dense: Sequence[float]) -> float:
        get = self.words
        total = self.bias + float(np.dot(self.dense, dense))
        return float(np.clip(total + sum(get[w] for w in words & get.keys()), -30, 30))


@dataclass
class Coded:
    """Word presence of the training rows: row and word number of each presence, and the words."""

    row: np.ndarray
    word: np.ndarray
    words: list[bytes]
    rows: int


def code_rows(rows: Iterable[set[bytes]], least_rows: int = 5) -> Coded:
    """Number the words that enough rows show; ``rows`` is read once and not kept."""
    place: dict[bytes, int] = {}
    found = [np.array([place.setdefault(w, len(place)) for w in sorted(r)], np.int32) for r in rows]
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    word = np.concatenate([np.zeros(0, np.int32), *found])
    kept = np.flatnonzero(np.bincount(word, minlength=len(place)) >= least_rows)
    number = np.full(len(place), -1)
    number[kept] = np.arange(len(kept))
    live = number[word] >= 0
    words = list(place)
    return Coded(row[live], number[word[live]], [words[i] for i in kept], len(found))


def _telling_words(x: Coded, use: np.ndarray, y: np.ndarray) -> np.ndarray:
    size = len(x.words)
    live = use[x.row]
    row, word = x.row[live], x.word[live]
    inside = np.bincount(word, y[row], size)
    outside = np.bincount(word, 1 - y[row], size)
    a, b = y[use].sum(), (1 - y[use]).sum()
    share = (inside + outside + 1) / (a + b + 2)
    z = np.abs(inside / a - outside / b) / np.sqrt(share * (1 - share) * (1 / a + 1 / b))
    order = np.lexsort((np.arange(size), -z))[:MOST_WORDS]
    return order[z[order] >= LEAST_Z]


def fit_logistic(
    x: Coded, dense: np.ndarray, y: np.ndarray, use: np.ndarray, penalty: float = PENALTY
) -> tuple[Logistic, np.ndarray]:
    """Penalised logistic regression on the rows marked in ``use``: Newton steps by conjugate gradients.

    Returns the model and its log-odds of all rows.
    """
    shape = dense.shape[1]
    target = y[use]
    if not len(target) or target.min() == target.max():
        constant = 30.0 if len(target) and target[0] else -30.0
        return Logistic({}, np.zeros(shape), constant), np.full(x.rows, constant)
    kept = _telling_words(x, use, y)
    k = len(kept)
    new_word = np.full(len(x.words), -1)
    new_word[kept] = np.arange(k)
    new_row = np.cumsum(use) - 1
    live = use[x.row] & (new_word[x.word] >= 0)
    at, col, rows = new_row[x.row[live]], new_word[x.word[live]], dense[use]

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(at, v[col], len(target)) + rows @ v[k:-1] + v[-1]

    def turned(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(col, r[at], k), rows.T @ r, [r.sum()]])

    hold = np.full(k + shape + 1, penalty)
    hold[k:] = 1e-2 * penalty
    w = np.zeros(k + shape + 1)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        grad = turned(target - p) - hold * w
        if np.abs(grad).max() < 1e-5 * len(target):
            break
        bend = np.maximum(p * (1 - p), 1e-6)
        step, rest = np.zeros_like(w), grad.copy()
        way, power = rest.copy(), rest @ rest
        for _ in range(15):
            moved = turned(bend * times(way)) + hold * way
            size = power / (way @ moved)
            step += size * way
            rest -= size * moved
            new = rest @ rest
            if new < 1e-10 * len(target):
                break
            way, power = rest + (new / power) * way, new
        w += step * min(1.0, 8 / max(1e-9, np.abs(step).max()))
    words = [x.words[i] for i in kept]
    odds = np.bincount(x.row, np.append(w[:k], 0)[new_word[x.word]], x.rows) + dense @ w[k:-1] + w[-1]
    return Logistic(dict(zip(words, w[:k].tolist(), strict=True)), w[k:-1], float(w[-1])), np.clip(odds, -30, 30)


@dataclass
class Chain:
    names: list[str]
    models: list[Logistic]

    def probabilities(self, text: bytes) -> list[float]:
        words = distinct_words(text)
        dense, out = measures(text, len(words)), []
        for model in self.models:
            odds = model.log_odds(words, dense)
            out.append(1 / (1 + np.exp(-odds)))
            dense = [*dense, odds]
        return [float(p) for p in out]


def fit_rows(rows: list[tuple[object, bytes, list]], categories: Sequence[tuple]) -> Chain:
    """``rows``: (id, text, label of each category). Folds are dealt by a checksum of the id."""
    dense = np.zeros((len(rows), 3))

    def read() -> Iterator[set[bytes]]:
        for i, (_, text, _) in enumerate(rows):
            words = distinct_words(text)
            dense[i] = measures(text, len(words))
            yield words

    coded, models = code_rows(read()), []
    fold = np.array([zlib.crc32(str(i).encode()) // 7 % FOLDS for i, _, _ in rows])
    for place, (_, _, shows) in enumerate(categories):
        known = np.array([labels[place] is not None for _, _, labels in rows], bool)
        y = np.array([labels[place] == shows for _, _, labels in rows], float)
        held_out = np.zeros(len(rows))
        for f in range(FOLDS):
            _, odds = fit_logistic(coded, dense, y, known & (fold != f))
            held_out[fold == f] = odds[fold == f]
        models.append(fit_logistic(coded, dense, y, known)[0])
        dense = np.column_stack([dense, held_out])
    return Chain([c[0] for c in categories], models)


def fit_chain(documents: DataFrame, labels: DataFrame, categories: Sequence[tuple] = CATEGORIES) -> Chain:
    """Fit on a bounded sample of ``labels(doc_id, <label columns>)`` and the texts of ``documents``."""
    columns = list(dict.fromkeys(c[1] for c in categories))
    draw = labels.filter("doc_id is not null").select(F.col("doc_id").alias("labelled"), *columns)
    sample = draw.orderBy(F.xxhash64("labelled"), "labelled", *columns).limit(TRAIN_ROWS)
    joined = documents.select("doc_id", text_bytes().alias("text")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("labelled")
    )
    found = [(r["doc_id"], bytes(r["text"]), [r[c[1]] for c in categories]) for r in joined.toLocalIterator()]
    return fit_rows(sorted(found, key=lambda r: (str(r[0]), r[1])), categories)


def score_toxicity(documents: DataFrame, chain: Chain, column: str = "text") -> DataFrame:
    """Add ``p_<category>`` for every category of the chain to every row; columns of these names are replaced."""
    names = [f"p_{n}" for n in chain.names]
    documents = documents.drop(*names)
    sent = documents.sparkSession.sparkContext.broadcast(chain)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_cache()
        chain = sent.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            rows = [chain.probabilities(t or b"") for t in texts]
            added = [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    schema = T.StructType([*documents.schema, *(T.StructField(n, T.DoubleType()) for n in names)])
    return documents.mapInArrow(scored, schema)
