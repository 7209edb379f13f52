"""Near-duplicate classes: MinHash signatures in an inverted file over (coordinate, value) pairs.

Method. A text is the set of its distinct word shingles. Its signature has ``COORDINATES`` minima
under random linear maps. Texts with one and the same set fold into a class first, so copies cost
nothing later. Each class is posted under every coordinate-value pair. A pair of classes that
agrees in at least ``MATCHES`` coordinates must meet in one of the ``COORDINATES - MATCHES + 1``
rarest postings of each (prefix), so each class skips its longest ``MATCHES - 1`` postings. Classes
that share a posting are brought together once, and there the agreeing coordinates are counted by
merging the postings; pairs above the match threshold are confirmed on the full sets.

Chance of losing a pair at exactly 80 %: fewer than 24 of 48 agree with probability 8e-7; above
that less. Every confirmed pair is a true one.

Scale. No pair leaves a task unless it is a confirmed link that joins two parts (a spanning
forest). Classes that meet directly or through others form a neighbourhood; one whose texts
exceed ``BLOCK_BYTES`` is cut into blocks, and every two blocks meet in a task of their own, so no
task holds more than two blocks (a longer single text stands alone).

Cases. Null or empty text, or white space only: empty set, linked with nothing, component is its
own id. Fewer words than a shingle: the whole sequence is the one shingle. Rows with the same id
count as one node, linked when any of their texts are. Null id: its row comes back with a null
component unless a copy has an id. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homespan.llm.common import GOLD, emit, free_worker_cache, in_chunks, mix, sorted_groups, stored, text_bytes, word_hashes
from homespan.llm.graph import components

COORDINATES = 48
MATCHES = 24
BLOCK_BYTES = 8_000_000
CHUNK_BYTES = 400_000

_random = np.random.default_rng(20240613)
_FACTORS = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2)
_MARKS = (np.arange(1, COORDINATES + 1, dtype=np.uint64)) * GOLD

FEATURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("n_bytes", pa.int64()),
        ("signature", pa.list_(pa.int64())),
    ]
)
FEATURES_SQL = "doc_id long, n_shingles long, set_a long, set_b long, n_bytes long, signature array<long>"


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = word_hashes(texts)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * GOLD)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for i in range(size):
            rolled += words[i : i + len(rolled)] * weights[i]
        rolled = mix(rolled)
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            if hi - lo >= size:
                out.append(np.unique(rolled[lo : hi - size + 1]))
            elif hi > lo:
                whole = (words[lo:hi] * weights[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                out.append(mix(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Posting keys, one row per non-empty set: the minimum of each coordinate, marked with the coordinate."""
    flat = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    with np.errstate(over="ignore"):
        for c in range(COORDINATES):
            out[:, c] = np.minimum.reduceat(flat * _FACTORS[c] + _SHIFTS[c], begins)
        return mix(out + _MARKS)


def _features(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    free_worker_cache()
    for batch in batches:
        ids, texts = (c.to_pylist() for c in batch.columns)
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            sets = shingle_sets(texts[part], size)
            full = [s for s in sets if len(s)]
            keys = iter(signatures(full).view(np.int64) if full else ())
            with np.errstate(over="ignore"):
                marks = [(s.sum(dtype=np.uint64), mix(s + GOLD).sum(dtype=np.uint64)) for s in sets]
            yield emit(
                {
                    "doc_id": ids[part],
                    "n_shingles": [len(s) for s in sets],
                    "set_a": [int(a.view(np.int64)) for a, _ in marks],
                    "set_b": [int(b.view(np.int64)) for _, b in marks],
                    "n_bytes": [len(t) for t in texts[part]],
                    "signature": [next(keys) if len(s) else [] for s in sets],
                },
                FEATURES,
            )


def _prefix_postings(classes: DataFrame) -> DataFrame:
    """(node, key) under the rarest COORDINATES - MATCHES + 1 postings, without those that hold one node."""
    posted = classes.select("node", F.explode("signature").alias("key"))
    held = posted.withColumn("held", F.count("*").over(Window.partitionBy("key"))).filter("held > 1")
    own = held.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("held", "key"))).alias("keys"))
    kept = own.filter(F.size("keys") >= MATCHES)
    prefix = F.slice("keys", F.lit(1), F.size("keys") - (MATCHES - 1))
    return kept.select("node", F.explode(F.transform(prefix, lambda k: k["key"])).alias("key"))


def _ids_of_several_texts(features: DataFrame) -> DataFrame:
    """(doc_id, class) of the ids that stand for texts of several classes, empty texts being one class."""
    mark = F.xxhash64("set_a", "set_b", "n_shingles")
    marks = features.filter("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    several = marks.filter("low <> high").select("doc_id")
    return features.join(several, "doc_id").select("doc_id", "set_a", "set_b", "n_shingles").distinct()


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links_within(ids: list[int], texts: list[bytes], size: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of all links between the texts: count agreeing coordinates, then confirm on full sets."""
    sets: list[np.ndarray] = []
    for part in in_chunks(map(len, texts), CHUNK_BYTES):
        sets += shingle_sets(texts[part], size)
    sizes = np.array([len(s) for s in sets])
    keys, at = np.unique(signatures(sets), return_inverse=True)
    at = at.reshape(len(sets), COORDINATES)
    owners = np.argsort(at, axis=None, kind="stable") // COORDINATES
    begins = np.searchsorted(np.sort(at, axis=None), np.arange(len(keys) + 1))
    part = np.arange(len(sets))
    found = []
    for i in range(len(sets) - 1):
        merged = np.concatenate([owners[begins[k] : begins[k + 1]] for k in at[i]])
        counts = np.bincount(merged, minlength=len(sets))
        counts[: i + 1] = 0
        near = np.flatnonzero(counts >= MATCHES)
        near = near[(np.minimum(sizes[near], sizes[i]) * 100 >= percent * np.maximum(sizes[near], sizes[i]))]
        for j in near[np.argsort(-counts[near], kind="stable")]:
            if part[i] == part[j]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                part[part == part[j]] = part[i]
                found.append((ids[i], ids[j]))
    return found


def _links(batches: Iterable[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for _, rows in sorted_groups(batches, 3):
        rows = sorted({r for r in rows if r[1].split()})
        if len(rows) > 1:
            found = links_within([r[0] for r in rows], [r[1] for r in rows], size, percent)
            yield emit({"a": [f[0] for f in found], "b": [f[1] for f in found]}, LINKS)


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents(doc_id, text)``.

    Two documents are linked when their shingle sets overlap in at least ``percent`` of the union;
    ``component_id`` is the smallest doc_id reachable over links.
    """
    rows = documents.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    features = stored(rows.mapInArrow(lambda b: _features(b, shingle), FEATURES_SQL))
    copies = (
        features.filter("n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    )
    classes = stored(copies)
    postings = stored(_prefix_postings(classes.filter("node is not null")))
    first = postings.groupBy("key").agg(F.min("node").alias("a"))
    meets = components(postings.join(first, "key").select("a", F.col("node").alias("b")))
    neighbours = stored(meets.withColumnRenamed("component", "near"))
    held = rows.withColumnRenamed("doc_id", "node").join(neighbours, "node")
    weights = held.groupBy("near").agg(F.ceil(F.sum(F.length("text")) / BLOCK_BYTES).cast("int").alias("blocks"))
    placed = held.join(weights, "near").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = paired.select(
        "near", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "text"
    )
    tasks = tasks.repartition("near", "i", "j").sortWithinPartitions("near", "i", "j")
    links = tasks.mapInArrow(lambda b: _links(b, shingle, percent), "a long, b long")
    several = stored(_ids_of_several_texts(features))
    same_id = several.join(classes, ["set_a", "set_b", "n_shingles"]).select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    parts = components(links.unionByName(same_id))
    named = classes.join(parts, "node", "left").select(
        F.col("set_a").alias("class_a"),
        F.col("set_b").alias("class_b"),
        F.coalesce("component", "node").alias("linked"),
    )
    same = (F.col("set_a") == F.col("class_a")) & (F.col("set_b") == F.col("class_b")) & (F.col("n_shingles") > 0)
    by_id = several.select("doc_id").distinct().join(parts, F.col("doc_id") == F.col("node"))
    by_id = by_id.select(F.col("doc_id").alias("own_id"), F.col("component").alias("by_id"))
    out = features.drop("signature").join(named, same, "left").join(by_id, F.col("doc_id") == F.col("own_id"), "left")
    component = F.coalesce("linked", "by_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
