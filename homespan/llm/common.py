"""Helpers the operators share: tables, checkpoints, stable hashes, word arrays, grouped Arrow streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.sources.tables import materialize

GOLD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xBF58476D1CE4E5B9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return materialize(df)


def text_bytes(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lowered, cut at ASCII white space."""
    return text.lower().split()


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, dtype=np.uint64)


def power_table(n: int) -> np.ndarray:
    """Powers of the hash base, at least ``n``."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, BASE), dtype=np.uint64)])
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and where each text's words begin (one more at the end)."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    raw = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)] if texts else np.zeros(0, np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    first_word = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), first_word
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
    powers = power_table(int(sizes.max()) + 1)
    weighed = (raw[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(weighed, offsets) + sizes.astype(np.uint64) * GOLD), first_word


def in_chunks(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``most``; a larger item stands alone."""
    begin = total = end = 0
    for end, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, end)
            begin, total = end, 0
        total += size
    if total or begin < end + 1:
        yield slice(begin, end + 1)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of rows from a stream sorted by its first ``keys`` columns; only one group is held at a time."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield current, rows


_held: dict = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: one thing at a time, so that operators' caches don't add up."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def free_worker_cache() -> None:
    _held.clear()


def emit(columns: dict[str, list | np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
