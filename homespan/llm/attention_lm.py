"""Scores of whole texts under a causal self-attention model over subword ids.

Model. The ``ACTIVE`` most frequent ids are grouped into ``CLASSES`` classes by the ids they follow. The chance of the
next id is the chance of its class times its chance within the class. Classes come from one causal attention
layer: each id has a query, a key and a value; queries meet the keys of their window up to themselves under a bias
by distance; the mixed values are read by a softmax over classes, on top of the class counts after the last id.
Within a class, chances are counts after the last id, smoothed by the counts of the ids. Other ids share a
slot of their own, within which chances follow smoothed counts over the whole vocabulary. So the chances of all ids
add up to one after every context. A text ends with the end id, which is predicted too. Pairs with other ids count
for their slot, on either side; which of the other ids comes next does not depend on the id before.

Windows. A text is cut into windows of ``CONTEXT`` ids that overlap: the first ``OVERLAP`` ids of a window only give
context, the others are scored, so each id is scored once, with at least ``OVERLAP`` ids before it where the text
has them. Windows go through masked attention in batches.

Reading. Texts are cut into words and ids once and kept as 16-bit ids and a byte a word in the checkpoint folder; counting,
fitting and scoring read those. Words are told apart by 64-bit hashes of their ids, which differ for different words.

Learning. Counts of words, ids and id pairs cover all training documents (one shuffle of partial counts). The attention
weights are fitted by numpy with Adam on all windows of all training documents. Texts are cut into blocks of windows, which
are dealt by hash into shards of about ``SHARD_WINDOWS`` and into ``ROUNDS`` rounds; in each round every shard goes on from the
same weights over its windows of that round in its own task, and the new weights are averaged, in ``GROUPS`` groups first, so
the driver adds up no more than these. So each window is learnt from once, and again where a round has fewer than
``ROUND_STEPS`` batches. Windows of repeated rows are held once and weigh as often as they came in.

Base score. Words and their counts are exact over all training documents. The ``HEAD_WORDS`` most frequent words are sent to
all tasks; every other word of a text is joined with its count.

Cases. Null text is empty: one token, the end. Null ids count as the empty text for the split. Repeated rows come back as
often as they came in. Null conditions for learning are false. Without training documents all counts are zero and ids are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import GOLD, emit, in_chunks, mix, power_table, sorted_groups, stored, text_bytes
from homespan.llm.subwords import letter_runs

ACTIVE = 2048
CLASSES = 64
WIDTH = 16
CONTEXT = 32
OVERLAP = 8
BLOCK_WINDOWS = 64
SHARD_WINDOWS = 131_072
ROUNDS = 4
ROUND_STEPS = 128
TRAIN_BATCH = 128
GROUPS = 16
HEAD_WORDS = 1 << 18
CHUNK_BYTES = 1_000_000
BATCH_WINDOWS = 64
COUNT_ROWS = 6_000_000
PRIOR = 60.0
#: Columns of a table row: query, key, value, and a one that adds up shares (and a zero, as columns are added in pairs).
QUERY, KEY, VALUE = (slice(i * WIDTH, (i + 1) * WIDTH) for i in range(3))
MIXED = slice(VALUE.start, VALUE.stop + 1)
ROW = 3 * WIDTH + 2
#: How far back each place of a window lies from each scored place.
GAPS = np.arange(OVERLAP, CONTEXT)[:, None] - np.arange(CONTEXT)[None]

WORD, PAIR = 0, 1
COUNTS = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])


def sequences(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids read and ids to predict of all texts one after the other, and where each text begins."""
    n = len(bounds) - 1
    begins = bounds + np.arange(n + 1)
    read, told = np.full(begins[-1], end_id, np.int64), np.full(begins[-1], end_id, np.int64)
    inner = np.ones(begins[-1], bool)
    inner[begins[1:] - 1] = False
    told[inner] = ids
    starts = np.ones(begins[-1], bool)
    starts[begins[:-1]] = False
    read[starts] = ids
    return read, told, begins


class _Counter:
    """Gathers keys and gives partial counts when enough are there."""

    def __init__(self, kind: int):
        self.kind, self.held, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.size += len(keys)
        if self.size >= COUNT_ROWS:
            yield from self.drain()

    def drain(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, n = np.unique(np.concatenate(self.held), return_counts=True)
            self.held, self.size = [], 0
            for b in range(0, len(keys), 100_000):
                part = slice(b, b + 100_000)
                yield emit({"kind": np.full(len(keys[part]), self.kind, np.int32), "key": keys[part], "n": n[part]}, COUNTS)


CODED = pa.schema(
    [("doc_id", pa.int64()), ("mark", pa.int64()), ("learnt", pa.bool_()), ("ids", pa.binary()), ("sizes", pa.binary())]
)
CODED_SQL = "doc_id long, mark long, learnt boolean, ids binary, sizes binary"


def sizes_to_bytes(sizes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids of words in base 255, all bytes but the last of each being 255; and where each text's bytes begin."""
    more, last = np.divmod(sizes, 255)
    ends = np.cumsum(more + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = last
    return out, np.concatenate([[0], ends])[first]


def bytes_to_sizes(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw != 255)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.add.reduceat(raw.astype(np.int64), np.concatenate([[0], ends[:-1] + 1]))


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _coded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Ids of each text and the numbers of ids of its words."""
    coder = letter_runs(path)
    kind = id_type(coder.size)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            at, first = coder.words(texts[part])
            ids, bounds = coder.ids_at(at, first)
            ids = ids.astype(kind)
            raw, opens = sizes_to_bytes(coder.sizes_at(at), first)
            n = len(first) - 1
            rows = batch.slice(part.start, n)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("mark"), rows.column("learnt"),
                    pa.array([ids[bounds[i] : bounds[i + 1]].tobytes() for i in range(n)], pa.binary()),
                    pa.array([raw[opens[i] : opens[i + 1]].tobytes() for i in range(n)], pa.binary()),
                ],
                schema=CODED,
            )


def code_texts(rows: DataFrame, path: str) -> DataFrame:
    """Stored ids of ``rows(doc_id, mark, learnt, text binary)``."""
    return stored(rows.mapInArrow(lambda b: _coded(b, path), CODED_SQL))


def id_arrays(ids: list[bytes], sizes: list[bytes], kind: str) -> tuple[np.ndarray, ...]:
    """Ids of all texts, where each text's begin, hashes of all words, and where each text's words begin."""
    raw = [np.frombuffer(x, np.uint8) for x in sizes]
    first = np.concatenate([[0], np.cumsum([np.count_nonzero(x != 255) for x in raw], dtype=np.int64)])
    each = bytes_to_sizes(np.concatenate([np.zeros(0, np.uint8), *raw]))
    flat = np.frombuffer(b"".join(ids), kind)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]) // np.dtype(kind).itemsize
    return flat, bounds, id_hashes(flat, each), first


def id_hashes(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, as signed numbers, from their ids."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    begins = np.cumsum(sizes) - sizes
    powers = power_table(int(sizes.max()) + 1)
    weighed = (ids.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(ids)) - np.repeat(begins, sizes)]
    return mix(np.add.reduceat(weighed, begins) + sizes.astype(np.uint64) * GOLD).view(np.int64)


def _counted(batches: Iterable[pa.RecordBatch], kind: str, end_id: int) -> Iterator[pa.RecordBatch]:
    words, pairs = _Counter(WORD), _Counter(PAIR)
    for batch in batches:
        texts, sizes = (c.to_pylist() for c in batch.columns)
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            ids, bounds, hashes, _ = id_arrays(texts[part], sizes[part], kind)
            yield from words.add(hashes)
            read, told, _ = sequences(ids, bounds, end_id)
            yield from pairs.add((read << 20) | told)
    yield from words.drain()
    yield from pairs.drain()


@dataclass
class Counts:
    """What the corpus says: exact totals, head words, and counts of pairs of slots (active ids, and one of all others)."""

    documents: int
    words: int
    distinct: int
    head: np.ndarray
    head_counts: np.ndarray
    active: np.ndarray
    id_counts: np.ndarray
    pairs: np.ndarray

    @property
    def tokens(self) -> int:
        return self.words + self.documents

    @property
    def vocabulary(self) -> int:
        return self.distinct + (self.documents > 0)


def _pair_totals(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of all ids, the active ids, and the counts of pairs of slots: active ids, then one slot of all others.

    No more rows than ids, then than pairs of slots.
    """
    pairs = counts.filter(F.col("kind") == PAIR).select(
        F.shiftright("key", 20).alias("a"), F.col("key").bitwiseAND((1 << 20) - 1).alias("b"), "n"
    )
    ids = np.zeros(size, np.int64)
    for row in pairs.groupBy("b").agg(F.sum("n").alias("n")).collect():
        ids[row["b"]] = row["n"]
    order = np.lexsort((np.arange(size), -ids))[:ACTIVE]
    active = np.sort(order[ids[order] > 0])
    others = len(active)
    listed = counts.sparkSession.createDataFrame([(int(i), s) for s, i in enumerate(active)], "id long, slot int")
    slots = pairs
    for side in ("a", "b"):
        slot = listed.select(F.col("id").alias(side), F.col("slot").alias(f"slot_{side}"))
        slots = slots.join(F.broadcast(slot), side, "left")
    slots = slots.select(*(F.coalesce(f"slot_{side}", F.lit(others)).alias(side) for side in ("a", "b")), "n")
    found = slots.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((others + 1, others + 1), np.float32)
    a, b, n = (found.column(c).to_numpy() for c in ("a", "b", "n"))
    table[a, b] = n
    return ids, active, table


def count_corpus(coded: DataFrame, size: int, end_id: int) -> tuple[DataFrame, Counts]:
    """Stored counts of all words and id pairs of coded texts, and their totals."""
    kind = id_type(size)
    partial = coded.select("ids", "sizes").mapInArrow(
        lambda b: _counted(b, kind, end_id), "kind int, key long, n long"
    )
    counts = stored(partial.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = counts.filter(F.col("kind") == WORD)
    totals = words.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    head = words.select("key", "n").orderBy(F.desc("n"), "key").limit(HEAD_WORDS).toArrow()
    keys, n = head.column("key").to_numpy(), head.column("n").to_numpy()
    order = np.argsort(keys)
    ids, active, pairs = _pair_totals(counts, size)
    return words, Counts(
        coded.count(), int(totals["n"]), int(totals["distinct"]), keys[order], n[order], active, ids, pairs
    )


def id_classes(pairs: np.ndarray, classes: int = CLASSES, seed: int = 3) -> np.ndarray:
    """Classes of active ids with alike ids before them: a low-rank view of the pair counts, then k-means."""
    n = len(pairs) - 1
    if n <= classes:
        return np.arange(n)
    draw = np.random.default_rng(seed)
    seen = np.sqrt(pairs[:n, :n]).T
    seen /= np.linalg.norm(seen, axis=1, keepdims=True) + 1e-6
    basis = np.linalg.qr(draw.normal(size=(n, 24)).astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(seen.T @ (seen @ basis))[0]
    points = seen @ basis
    weight = pairs.sum(0)[:n] ** 0.5 + 1e-6
    centres = points[draw.choice(n, classes, replace=False, p=weight / weight.sum())]
    for _ in range(15):
        gap = (centres**2).sum(1)[None] - 2 * points @ centres.T
        near = gap.argmin(1)
        for c in range(classes):
            if (near == c).any():
                centres[c] = np.average(points[near == c], axis=0, weights=weight[near == c])
    return np.unique(near, return_inverse=True)[1]


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


class AttentionModel:
    """A row by active id (one more for the slot of other ids, and one of zeros for places outside a text) and the readout."""

    def __init__(self, counts: Counts, seed: int = 5):
        n, size = len(counts.active), len(counts.id_counts)
        self.place = np.full(size, n, np.int32)
        self.place[counts.active] = np.arange(n)
        own = id_classes(counts.pairs)
        self.classes = int(own.max(initial=-1)) + 2
        self.class_of = np.append(own, self.classes - 1).astype(np.int32)
        self._count_tables(counts, n, size)
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
        rows = np.zeros((n + 2, ROW), np.float32)
        for part, scale in ((QUERY, 0.3), (KEY, 0.3), (VALUE, 0.1)):
            rows[:-1, part] = normal(n + 1, WIDTH, scale=scale)
        rows[:-1, VALUE.stop] = 1
        self.weights = {
            "rows": rows,
            "distance": np.zeros(CONTEXT, np.float32),
            "read": normal(WIDTH, self.classes, scale=0.1),
        }

    def _count_tables(self, counts: Counts, n: int, size: int) -> None:
        rare = counts.id_counts.astype(float).copy()
        rare[counts.active] = 0
        single = np.append(counts.id_counts[counts.active], rare.sum()).astype(float) + 0.5
        single /= single.sum()
        self.log_rare = np.zeros(size, np.float32)
        others = np.ones(size, bool)
        others[counts.active] = False
        self.log_rare[others] = np.log((rare[others] + 1) / (rare[others] + 1).sum()) if others.any() else 0
        order = np.zeros((n + 1, self.classes), np.float32)
        order[np.arange(n + 1), self.class_of] = 1
        by_class, class_share = counts.pairs @ order, single @ order
        total = counts.pairs.sum(1, keepdims=True)
        self.log_class = np.log((by_class + PRIOR * class_share) / (total + PRIOR)).astype(np.float32)
        inside = (counts.pairs + PRIOR * single) / (by_class + PRIOR * class_share)[:, self.class_of]
        self.log_inside = np.log(inside).astype(np.float32)

    def _attend(self, ids: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows of windows ``ids`` (windows, CONTEXT), their keys, values and ones by column, exponentials of the scored
        places' scores, their sums, and mixed values.

        A place outside its text has a row of zeros, whose one is a zero too, so that it is in neither sums nor values.
        """
        rows = self.weights["rows"].take(ids, axis=0)
        columns = np.ascontiguousarray(rows[:, :, KEY.start : MIXED.stop].transpose(0, 2, 1))
        shape = self._shape()
        for shifted in (False, True):
            raw = rows[:, OVERLAP:, QUERY] @ columns[:, :WIDTH]
            raw *= np.float32(WIDTH**-0.5)
            raw += shape
            if shifted:
                raw += np.where(valid, np.float32(0), np.float32(-1e9))[:, None, :]
                raw -= raw.max(axis=2, keepdims=True)
            with np.errstate(over="ignore", invalid="ignore"):
                np.exp(raw, out=raw)
                both = raw @ rows[:, :, MIXED]
            sums = both[:, :, WIDTH:]
            if _fair(sums):
                break
        return rows, columns, raw, sums, both[:, :, :WIDTH] / sums

    def _tops(self, mixed: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials of the readout of every scored place by class, and their sums."""
        prior = self.log_class.take(last.ravel(), axis=0)
        for shifted in (False, True):
            top = (mixed @ self.weights["read"]).reshape(prior.shape)
            top += prior
            if shifted:
                top -= top.max(axis=1, keepdims=True)
            with np.errstate(over="ignore", invalid="ignore"):
                sums = np.exp(top, out=top) @ np.ones(self.classes, np.float32)
            if _fair(sums):
                break
        return top, sums

    def _shape(self) -> np.ndarray:
        """Bias by distance, and the causal mask."""
        return np.where(GAPS >= 0, self.weights["distance"][np.maximum(GAPS, 0)], np.float32(-1e9))

    def ready(self) -> None:
        """Tables for scoring: scaled queries, the bias by distance, and whether exponentials need a shift."""
        w = self.weights
        self.scaled = w["rows"].copy()
        self.scaled[:, QUERY] *= np.float32(WIDTH**-0.5)
        self.shape = self._shape().astype(np.float32)
        longest = lambda t: float(np.linalg.norm(t, axis=-1).max(initial=0))
        reach = longest(self.scaled[:, QUERY]) * longest(w["rows"][:, KEY]) + float(np.abs(w["distance"]).max())
        self.small = max(reach, longest(w["rows"][:, VALUE]) * longest(w["read"].T)) < 60

    def log_chances(self, ids: np.ndarray, valid: np.ndarray | None, told: np.ndarray) -> np.ndarray:
        """Natural log of the chance of every scored place; ``told`` holds vocabulary ids. No mask: all are valid."""
        last, next_place = ids[:, OVERLAP:].ravel(), self.place.take(told.ravel())
        rows = self.scaled.take(ids if valid is None else np.where(valid, ids, len(self.scaled) - 1), axis=0)
        raw = rows[:, OVERLAP:, QUERY] @ np.ascontiguousarray(rows[:, :, KEY].transpose(0, 2, 1))
        raw += self.shape
        if not self.small:
            if valid is not None:
                raw += np.where(valid, np.float32(0), np.float32(-1e9))[:, None, :]
            raw -= raw.max(axis=2, keepdims=True)
        np.exp(raw, out=raw)
        both = raw @ rows[:, :, MIXED]
        z = ((both[:, :, :WIDTH] / both[:, :, WIDTH:]) @ self.weights["read"]).reshape(-1, self.classes)
        z += self.log_class.take(last, axis=0)
        if not self.small:
            z -= z.max(axis=1, keepdims=True)
        out = z.ravel().take(_cells(self.class_of.take(next_place), self.classes))
        out -= np.log(np.exp(z, out=z) @ np.ones(self.classes, np.float32))
        out += self.log_inside.ravel().take(last * len(self.log_inside) + next_place)
        out += self.log_rare.take(told.ravel())
        return out.reshape(told.shape)

    def fit(
        self, ids: np.ndarray, valid: np.ndarray, told: np.ndarray, times: np.ndarray, rate: float = 0.01, seed: int = 9
    ) -> None:
        """A whole pass over the windows, and on through them up to ROUND_STEPS steps; ``times`` is the weight of each."""
        draw = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        aims = self.class_of[self.place[told]]
        begins = range(0, len(ids), TRAIN_BATCH)
        for step in range(max(ROUND_STEPS, len(begins)) if len(ids) else 0):
            if step % len(begins) == 0:
                order = draw.permutation(len(ids))
            b = begins[step % len(begins)]
            pick = order[b : b + TRAIN_BATCH]
            scale = rate * np.sqrt(1 - 0.99 ** (step + 1)) / (1 - 0.9 ** (step + 1))
            for name, grad in self._gradients(ids[pick], valid[pick], aims[pick], times[pick]).items():
                first, second = moments[name]  # 10 times the mean of gradients, 100 times that of their squares
                first *= np.float32(0.9)
                first += grad
                grad *= grad
                second *= np.float32(0.99)
                second += grad
                root = np.sqrt(second, out=grad)
                root += np.float32(1e-6)
                np.divide(first, root, out=root)
                root *= np.float32(scale)
                self.weights[name] -= root

    def flat(self) -> np.ndarray:
        """All weights one after the other."""
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def learnt(self, flat: np.ndarray) -> AttentionModel:
        """The model under these weights, without the tables that only scoring reads."""
        ends = np.cumsum([w.size for w in self.weights.values()])
        parts = np.split(flat.astype(np.float32), ends[:-1])
        model = copy(self)
        model.weights = {k: p.reshape(w.shape).copy() for (k, w), p in zip(self.weights.items(), parts, strict=True)}
        model.log_inside = model.log_rare = None
        return model

    def _gradients(
        self, ids: np.ndarray, valid: np.ndarray, aims: np.ndarray, times: np.ndarray
    ) -> dict[str, np.ndarray]:
        """Of the mean loss over the valid scored places; ``aims`` holds the classes to predict there."""
        read = self.weights["read"]
        size = len(self.weights["rows"])
        at = np.where(valid, ids, size - 1)
        rows, columns, share, sums, mixed = self._attend(at, valid)
        top, tops = self._tops(mixed, ids[:, OVERLAP:])
        live = valid[:, OVERLAP:] * times[:, None].astype(np.float32)
        live /= max(1, live.sum())
        top.ravel()[_cells(aims, self.classes)] -= tops
        top, part = top.reshape(*live.shape, -1), live[:, :, None] / tops.reshape(*live.shape, 1)
        back = np.empty((*live.shape, WIDTH + 1), np.float32)
        np.multiply(top @ np.ascontiguousarray(read.T), part / sums, out=back[:, :, :WIDTH])
        np.negative(np.einsum("bij,bij->bi", back[:, :, :WIDTH], mixed), out=back[:, :, WIDTH])
        to_raw = back @ columns[:, WIDTH:]
        to_raw *= share
        near = np.bincount(GAPS[GAPS >= 0], to_raw.sum(axis=0)[GAPS >= 0], CONTEXT)
        grads = np.empty_like(rows)
        grads[:, :OVERLAP, QUERY] = 0
        grads[:, :, VALUE.stop :] = 0
        np.matmul(to_raw, rows[:, :, KEY], out=grads[:, OVERLAP:, QUERY])
        np.matmul(to_raw.transpose(0, 2, 1), rows[:, OVERLAP:, QUERY], out=grads[:, :, KEY])
        np.matmul(share.transpose(0, 2, 1), back[:, :, :WIDTH], out=grads[:, :, VALUE])
        added = _rows_added(at, grads, size)
        added[:, : KEY.stop] *= np.float32(WIDTH**-0.5)
        added[-1] = 0
        mixed *= part
        mixed, top = (t.reshape(_groups(len(t)), -1, t.shape[-1]) for t in (mixed, top))
        return {"rows": added, "distance": near.astype(np.float32), "read": (mixed.transpose(0, 2, 1) @ top).sum(axis=0)}


def _fair(sums: np.ndarray) -> bool:
    """Whether sums of exponentials are far from the ends of their type; if not, the largest is to be taken off first."""
    return bool(sums.min(initial=1) > 1e-12 and sums.max(initial=1) < 1e12)


def _groups(windows: int) -> int:
    """Into how many groups windows are put for sums over all their places."""
    return windows // 4 if windows % 4 == 0 else windows


def _cells(columns: np.ndarray, width: int) -> np.ndarray:
    """Places in a flat table of ``width`` columns of one column a row."""
    return np.arange(columns.size) * width + columns.ravel()


def _rows_added(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """A table of ``size`` rows with the sums of the rows at each place; an even number of columns, added in pairs."""
    at = at.ravel().astype(np.min_scalar_type(size))
    order = np.argsort(at, kind="stable")
    places = at[order]
    begins = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    out = np.zeros((size, rows.shape[-1]), np.float32)
    pairs = rows.reshape(len(at), -1).view(np.complex64).take(order, axis=0)
    out.view(np.complex64)[places[begins]] = np.add.reduceat(pairs, begins, axis=0)
    return out


def cut_windows(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (windows, CONTEXT) in the stream, which are inside their text, and the text of each window."""
    return _windows(begins, np.zeros(len(begins) - 1, np.int64))


def _windows(begins: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``cut_windows``, of texts or blocks whose first ``leads`` places only give context."""
    stride = CONTEXT - OVERLAP
    counts = -(-(np.diff(begins) - leads) // stride)
    owner = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = (begins[owner] + leads[owner] + number * stride)[:, None] + np.arange(-OVERLAP, stride)[None]
    valid = (places >= begins[owner][:, None]) & (places < begins[owner + 1][:, None])
    return np.where(valid, places, 0), valid, owner


def score_stream(model: AttentionModel, read: np.ndarray, told: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """log10 probability of each text of the stream."""
    stride, sizes = CONTEXT - OVERLAP, np.diff(begins)
    counts = -(-sizes // stride)
    firsts = np.cumsum(counts) - counts
    outside = len(model.weights["rows"]) - 1
    at = np.arange(len(read)) + np.repeat(firsts * stride - begins[:-1], sizes)
    aims = np.zeros(int(counts.sum()) * stride, np.int64)
    aims[at] = told
    last = np.zeros(len(aims), np.int64)  # places after a text's end: no place before them attends to them
    last[at] = model.place[read]
    ids = np.empty((len(aims) // stride, CONTEXT), np.int64)
    ids[:, OVERLAP:] = last.reshape(-1, stride)
    ids[1:, :OVERLAP] = ids[:-1, stride:]
    ids[firsts, :OVERLAP] = outside
    aims = aims.reshape(-1, stride)
    got = np.empty(aims.shape)
    for b in range(0, len(ids), BATCH_WINDOWS):
        part = slice(b, b + BATCH_WINDOWS)
        valid = None if model.small else ids[part] != outside
        got[part] = model.log_chances(ids[part], valid, aims[part])
    return np.add.reduceat(got.ravel()[at], begins[:-1]) / np.log(10)


BLOCKS = pa.schema([("shard", pa.int64()), ("key", pa.int64()), ("lead", pa.int64()), ("ids", pa.binary())])
BLOCKS_SQL = "shard long, key long, lead long, ids binary"
FITTED = pa.schema([("group", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("weights", pa.binary())])
FITTED_SQL = "group long, shard long, n long, weights binary"


def _blocks(batches: Iterable[pa.RecordBatch], kind: str, end_id: int, shards: int, turn: int) -> Iterator[pa.RecordBatch]:
    """A round's blocks of up to BLOCK_WINDOWS windows: ids from those that give context to the one after the last."""
    width, stride = np.dtype(kind).itemsize, BLOCK_WINDOWS * (CONTEXT - OVERLAP)
    end = np.array([end_id], kind).tobytes()
    for batch in batches:
        marks, texts = batch.column("mark").to_numpy(zero_copy_only=False), batch.column("ids").to_pylist()
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            places = np.array([len(t) // width + 1 for t in texts[part]])
            counts = -(-places // stride)
            number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            with np.errstate(over="ignore"):
                keys = mix(np.repeat(marks[part].view(np.uint64), counts) + GOLD * (number.astype(np.uint64) + np.uint64(1)))
            dealt = mix(keys)
            now = np.flatnonzero(dealt // np.uint64(shards) % np.uint64(ROUNDS) == turn)
            begins = number[now] * stride
            owners = np.repeat(np.arange(len(places)), counts)[now]
            ends = np.minimum(begins + stride, places[owners]) + 1
            leads = np.minimum(begins, OVERLAP)
            # the end id stands before the first id and after the last
            told = {i: end + texts[part.start + i] + end for i in np.unique(owners).tolist()}
            spans = zip(owners.tolist(), ((begins - leads) * width).tolist(), (ends * width).tolist(), strict=True)
            columns = {
                "shard": (dealt[now] % np.uint64(shards)).astype(np.int64), "key": keys[now].view(np.int64), "lead": leads,
                "ids": [told[i][b:e] for i, b, e in spans],
            }
            yield emit(columns, BLOCKS)


def deal_blocks(coded: DataFrame, kind: str, end_id: int, shards: int, turn: int) -> DataFrame:
    """A round's blocks of all coded texts, each shard in one partition, and how often each block came in."""
    blocks = coded.select("mark", "ids").mapInArrow(lambda b: _blocks(b, kind, end_id, shards, turn), BLOCKS_SQL)
    same = ("shard", "key", "lead", "ids")
    counted = blocks.repartition(shards, "shard").groupBy(*same).agg(F.count("*").alias("times"))
    return counted.sortWithinPartitions(*same)


def block_windows(rows: list[tuple], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids read, which are inside their text, ids to predict, and the weight of every window of rows (lead, ids, times)."""
    ids = np.frombuffer(b"".join(r[1] for r in rows), kind)
    ends = np.cumsum([len(r[1]) for r in rows], dtype=np.int64) // np.dtype(kind).itemsize
    read, told = np.delete(ids, ends - 1), np.delete(ids, np.append(0, ends[:-1]))
    begins = np.append(0, ends - np.arange(1, len(rows) + 1))
    places, valid, owner = _windows(begins, np.array([r[0] for r in rows], np.int64))
    return read[places], valid, told[places[:, OVERLAP:]], np.array([r[2] for r in rows], np.int64)[owner]


def _fitted(batches: Iterable[pa.RecordBatch], model: AttentionModel, kind: str, turn: int) -> Iterator[pa.RecordBatch]:
    """The weights that each shard goes on to."""
    for (shard,), rows in sorted_groups(batches, 1):
        read, valid, told, times = block_windows(rows, kind)
        own = model.learnt(model.flat())
        own.fit(model.place[read], valid, told, times, 0.01 * 0.7**turn, seed=9 + turn)
        weights = own.flat().astype("<f4").tobytes()
        yield emit({"group": [shard % GROUPS], "shard": [shard], "n": [int(times.sum())], "weights": [weights]}, FITTED)


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of a group, added up by their numbers of windows."""
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for group, _, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            before, total = sums.get(group, (0, 0.0))
            sums[group] = before + n, total + n * np.frombuffer(raw, "<f4").astype("<f8")
    for group, (n, total) in sums.items():
        yield emit({"group": [group], "shard": [0], "n": [n], "weights": [total.tobytes()]}, FITTED)


def fit_model(coded: DataFrame, counts: Counts, end_id: int) -> AttentionModel:
    """Fit the attention weights on all windows of the coded texts."""
    model = AttentionModel(counts)
    kind = id_type(len(counts.id_counts))
    windows = float(counts.id_counts.sum()) / (CONTEXT - OVERLAP)
    shards = int(-(-windows // SHARD_WINDOWS)) or 1
    context = coded.sparkSession.sparkContext
    for turn in range(ROUNDS):
        sent = context.broadcast(model.learnt(model.flat()))
        blocks = deal_blocks(coded, kind, end_id, shards, turn).select("shard", "lead", "ids", "times")
        fitted = blocks.mapInArrow(lambda b, sent=sent, turn=turn: _fitted(b, sent.value, kind, turn), FITTED_SQL)
        added = fitted.repartition("group").sortWithinPartitions("group", "shard").mapInArrow(_added, FITTED_SQL)
        sums = sorted((r["group"], r["n"], bytes(r["weights"])) for r in added.collect())
        if sums:
            mean = sum(np.frombuffer(w, "<f8") for _, _, w in sums) / sum(n for _, n, _ in sums)
            model.weights = model.learnt(mean).weights
    return model


SCORED = pa.schema(
    [
        ("doc_id", pa.int64()), ("mark", pa.int64()), ("key", pa.int64()), ("times", pa.int64()), ("copies", pa.int64()),
        ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
    ]
)
SCORED_SQL = (
    "doc_id long, mark long, key long, times long, copies long, n_tokens long, n_known long, base double, score double"
)


class HeadWords:
    """Looks hashes up among sorted ones, from where those of the same first bits begin."""

    def __init__(self, sorted_hashes: np.ndarray, bits: int = 18):
        self.shift, self.half = 64 - bits, 1 << bits - 1
        self.begins = np.searchsorted(sorted_hashes, np.arange(-self.half, self.half) << self.shift)
        self.most = int(np.diff(self.begins, append=len(sorted_hashes)).max())
        self.held = np.append(sorted_hashes, np.iinfo(np.int64).max)
        self.size = len(sorted_hashes)

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first that is not smaller, and whether it is the one; 0 and not, where there is none."""
        at = self.begins[(hashes >> self.shift) + self.half]
        for _ in range(self.most):
            at += self.held[at] < hashes
        known = (self.held[at] == hashes) & (at < self.size)
        at[at == self.size] = 0
        return at, known


def _scored(
    batches: Iterable[pa.RecordBatch], model: AttentionModel, counts: Counts, end_id: int
) -> Iterator[pa.RecordBatch]:
    """A row for each text (copies = 1) with what the head words give, and a row for each other word in it (copies = 0)."""
    kind = id_type(len(counts.id_counts))
    model.ready()
    share = np.log10(counts.tokens + counts.vocabulary + 1)
    head = HeadWords(counts.head)
    head_scores = np.log10(counts.head_counts + 1.0) - share
    end_score = np.log10(counts.documents + 1.0) - share
    for batch in batches:
        docs, marks, texts, sizes = (c.to_pylist() for c in batch.columns)
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            ids, bounds, hashes, first = id_arrays(texts[part], sizes[part], kind)
            n = len(first) - 1
            owner = np.repeat(np.arange(n), np.diff(first))
            at, known = head(hashes)
            in_head = owner[known]
            base = np.bincount(in_head, head_scores[at[known]], n) + end_score
            in_head = np.bincount(in_head, minlength=n) + (counts.documents > 0)
            scores = score_stream(model, *sequences(ids, bounds, end_id))
            mark, doc = np.array(marks[part], np.int64), docs[part]
            yield emit(
                {
                    "doc_id": doc, "mark": mark, "key": mix(mark.view(np.uint64)).view(np.int64),
                    "times": np.zeros(n, np.int64), "copies": np.ones(n, np.int64), "n_tokens": np.diff(first) + 1,
                    "n_known": in_head, "base": base, "score": scores,
                },
                SCORED,
            )
            tail = ~known
            by_text = np.lexsort((hashes[tail], owner[tail]))
            keys, texts_of = hashes[tail][by_text], owner[tail][by_text]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (texts_of[1:] != texts_of[:-1])
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(keys)))
            k, whose = keys[starts], texts_of[starts]
            zeros = np.zeros(len(k), np.int64)
            yield emit(
                {
                    "doc_id": [doc[i] for i in whose], "mark": mark[whose], "key": k, "times": times, "copies": zeros,
                    "n_tokens": zeros, "n_known": zeros, "base": zeros.astype(float), "score": zeros.astype(float),
                },
                SCORED,
            )


def score_texts(documents: DataFrame, learnt: Column, path: str) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``documents(doc_id, text)``.

    ``learnt`` says which rows counts and weights are learnt from. ``path`` is the tokenizer file
    whose vocabulary is used; its end-of-text id comes after every text.
    """
    coder = letter_runs(path)
    size, end_id = coder.size, coder.end_id
    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("mark"),
        F.coalesce(learnt, F.lit(False)).alias("learnt"), text_bytes().alias("text"),
    )
    coded = code_texts(rows, path)
    learn = coded.filter("learnt")
    words, counts = count_corpus(learn, size, end_id)
    model = fit_model(learn, counts, end_id)
    sent = documents.sparkSession.sparkContext.broadcast((model, counts))
    parts = coded.select("doc_id", "mark", "ids", "sizes").mapInArrow(lambda b: _scored(b, *sent.value, end_id), SCORED_SQL)
    joined = parts.join(words.select("key", F.col("n").alias("held")), "key", "left")
    held = F.coalesce("held", F.lit(0))
    share = float(np.log10(counts.tokens + counts.vocabulary + 1))
    rest = F.col("times") * (F.log10(held + 1) - share)
    whole = joined.groupBy("doc_id", "mark").agg(
        F.sum("copies").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(held > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + rest).alias("base"),
        F.sum("score").alias("score"),
    )
    each = whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        "doc_id",
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
