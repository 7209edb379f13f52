"""Language of a text from a byte convolutional network.

Method. Bytes (A-Z lowered) are embedded; filters of several widths run over fixed-length windows; each
filter keeps its maximum over the window; a softmax layer reads the maxima. Training is plain numpy
with Adam; as only the position of a maximum gets a gradient, a step costs little more than its
forward pass. For scoring, embedding and filters fold into look-up tables over byte pairs. A text is cut
into windows from end to end and its probabilities are the mean over windows, weighed by their bytes.

Bounds. The network is fitted on at most ``DOCS_PER_LANGUAGE`` documents of each language (smallest
hash of the id first) and ``WINDOWS_PER_DOC`` evenly spaced windows of each. Prediction reads whole texts,
in matrices of at most ``BATCH_WINDOWS`` windows, and shuffles nothing.

Cases. Null text or text without a letter: ``und`` with score 0; so is everything when nothing could be
learned. Null languages are not learned. Very short texts are one padded window. Repeated rows come
back as often as they came in; other columns are kept, and clashing names are refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.llm.common import free_worker_cache, in_chunks, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 8
BATCH_WINDOWS = 512
EPOCHS = 8
LEAST_STEPS = 300
UNKNOWN = "und"
LEAST_SCORE = 0.35

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, the last padded with zero bytes."""
    count = -(-len(text) // WINDOW)
    raw = np.zeros(count * WINDOW, np.uint8)
    raw[: len(text)] = _LOWER[np.frombuffer(text, np.uint8)]
    return raw.reshape(count, WINDOW)


@dataclass
class ByteConvNet:
    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> ByteConvNet:
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
        weights = {"embed": normal(256, EMBEDDING, scale=0.5)}
        for w in WIDTHS:
            weights[f"filter{w}"] = normal(w, EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5)
        weights["bias"] = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        weights["out"] = normal(len(WIDTHS) * FILTERS, len(languages), scale=0.1)
        weights["prior"] = np.zeros(len(languages), np.float32)
        return cls(languages, weights)

    def pair_tables(self) -> dict[tuple[int, int], np.ndarray]:
        """(width, offset) -> filter response of a byte (odd tail) or of a byte pair at that offset."""
        tables = {}
        for w in WIDTHS:
            single = [self.weights["embed"] @ self.weights[f"filter{w}"][j] for j in range(w)]
            for j in range(0, w - 1, 2):
                tables[w, j] = (single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, FILTERS)
            if w % 2:
                tables[w, w - 1] = single[w - 1]
        return tables

    def maxima(self, x: np.ndarray, tables: dict, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter in each window, and where it is."""
        wide = x.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        best, where = [], []
        for w in WIDTHS:
            span = x.shape[1] - w + 1
            got = tables[w, 0].take(pairs[:, :span], axis=0)
            for j in range(2, w, 2):
                got += tables[w, j].take((pairs if j + 1 < w else wide)[:, j : j + span], axis=0)
            if places:
                at = got.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(got, at[:, None, :], axis=1)[:, 0])
            else:
                best.append(got.max(axis=1))
        return np.concatenate(best, axis=1), np.concatenate(where, axis=1) if places else None

    def probabilities(self, x: np.ndarray, tables: dict) -> np.ndarray:
        raw, _ = self.maxima(x, tables)
        return _softmax(np.maximum(raw + self.weights["bias"], 0) @ self.weights["out"] + self.weights["prior"])

    def fit(self, x: np.ndarray, y: np.ndarray, batch: int = 128, rate: float = 0.004) -> None:
        epochs = max(EPOCHS, -(-LEAST_STEPS * batch // len(x)))
        draw = np.random.default_rng(11)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for begin in range(0, len(x), batch):
                step += 1
                pick = order[begin : begin + batch]
                for name, grad in self._gradients(x[pick], y[pick]).items():
                    first, second = moments[name]
                    first += 0.1 * (grad - first)
                    second += 0.001 * (grad * grad - second)
                    scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[name] -= scale * first / (np.sqrt(second) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        raw, where = self.maxima(x, self.pair_tables(), places=True)
        active = np.maximum(raw + self.weights["bias"], 0)
        chances = _softmax(active @ self.weights["out"] + self.weights["prior"])
        chances[np.arange(len(y)), y] -= 1
        top = chances / len(y)
        back = (top @ self.weights["out"].T) * (active > 0)
        grads = {"out": active.T @ top, "prior": top.sum(0), "bias": back.sum(0), "embed": np.zeros((256, EMBEDDING), np.float32)}
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(WIDTHS):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            g, at = back[:, part], where[:, part]
            filters = self.weights[f"filter{w}"]
            change = np.zeros_like(filters)
            for j in range(w):
                seen = x[rows, at + j]
                change[j] = np.einsum("nfe,nf->ef", self.weights["embed"][seen], g)
                np.add.at(grads["embed"], seen.ravel(), (g[:, :, None] * filters[j].T[None]).reshape(-1, EMBEDDING))
            grads[f"filter{w}"] = change
        return grads


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _training_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, doc, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            cut = windows_of(text)
            picks = np.unique(np.linspace(0, len(cut) - 1, WINDOWS_PER_DOC).astype(int)) if len(cut) else []
            out += [(lang, doc, int(p), cut[p].tobytes()) for p in picks]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "doc", "at", "bytes"])


def fit_languages(documents: DataFrame) -> ByteConvNet | None:
    """Train on a bounded sample of ``documents(doc_id, text, lang)``; None when nothing can be learned."""
    usable = documents.filter("lang is not null and text is not null and length(text) > 0")
    marked = usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("draw"))
    # First in buckets, so that no task gathers what all input partitions offer of one language.
    sample = marked.withColumn("bucket", F.pmod("draw", F.lit(64)))
    for keys in (("lang", "bucket"), ("lang",)):
        by_draw = Window.partitionBy(*keys).orderBy("draw", "doc_id")
        sample = sample.withColumn("n", F.row_number().over(by_draw)).filter(F.col("n") <= DOCS_PER_LANGUAGE)
    picked = usable.select("lang", F.col("doc_id").cast("long"), text_bytes().alias("text")).join(
        F.broadcast(sample.select("lang", "doc_id").distinct()), ["lang", "doc_id"]
    )
    found = picked.select("lang", "doc_id", "text").mapInArrow(_training_windows, "lang string, doc long, at int, bytes binary")
    rows = sorted(((r["lang"], r["doc"], r["at"], bytes(r["bytes"])) for r in found.collect()))
    rows = [r for r in rows if has_letter(r[3])]
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    net = ByteConvNet.fresh(languages)
    x = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, WINDOW)
    net.fit(x, np.array([languages.index(r[0]) for r in rows]))
    return net


def predict_text_batch(net: ByteConvNet, tables: dict, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    spoken = [i for i, t in enumerate(texts) if has_letter(t)]
    for part in in_chunks([len(texts[i]) for i in spoken], BATCH_WINDOWS * WINDOW):
        ids = spoken[part]
        if not ids:
            continue
        lengths = np.array([len(texts[i]) for i in ids])
        cut = np.concatenate([windows_of(texts[i]) for i in ids])
        counts = -(-lengths // WINDOW)
        chances = np.concatenate(
            [net.probabilities(cut[b : b + BATCH_WINDOWS], tables) for b in range(0, len(cut), BATCH_WINDOWS)]
        )
        begins = np.concatenate([[0], np.cumsum(counts)])
        weight = np.full(len(cut), float(WINDOW))
        weight[begins[1:] - 1] = lengths - (counts - 1) * WINDOW
        total = np.add.reduceat(chances * weight[:, None], begins[:-1]) / lengths[:, None]
        for i, p in zip(ids, total, strict=True):
            names[i], scores[i] = net.languages[int(p.argmax())], float(min(1.0, p.max()))
    return names, scores


def identify(documents: DataFrame, net: ByteConvNet | None, column: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``lang_score`` to every row; columns of these names are replaced."""
    documents = documents.drop("lang_pred", "lang_score")
    if net is None:
        return documents.withColumns({"lang_pred": F.lit(UNKNOWN), "lang_score": F.lit(0.0)})
    sent = documents.sparkSession.sparkContext.broadcast(net)

    def predicted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_cache()
        net = sent.value
        tables = net.pair_tables()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
            names, scores = predict_text_batch(net, tables, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "lang_score"],
            )

    schema = T.StructType([*documents.schema, *T.StructType.fromDDL("lang_pred string, lang_score double")])
    return documents.mapInArrow(predicted, schema)
