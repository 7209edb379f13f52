"""Training sequences packed by lexical retrieval.

Method. Documents are dealt by their strongest terms into shards of about ``SHARD_BYTES`` of text. Each shard has a BM25
inverted index over subword ids. A window of ``length`` ids starts with a seed document (or the rest of the
document that ran over the last window); all its terms together retrieve unused neighbours, which fill the
window greedily in order of score; when none is left, the next unused document does. A document that runs
over the end is cut, and its rest opens the next window. So every sequence is full but for the end of a
shard, which is cut into sequences of powers of two, which need no padding.

Dealing. A document's strongest terms are those with the largest BM25 weight by counts over the whole table, of terms that
another document has too. Documents with the same strongest term make a bucket; a bucket larger than a shard is split
by the second term, then by the third, and what is still too large by a hash of the row, copies included. Buckets in order of their terms fill the
shards. Related documents that agree in no strongest term may still lie in different shards: a seed's neighbours are
those of its shard.

Scale. Texts are cut into ids once, which are kept in the checkpoint folder beside the counts of their terms. Counts of terms are no more than the vocabulary,
buckets no more than the vocabulary and ``BINS`` for each shard and level. One shuffle of the ids by shard; a shard is
indexed and packed in one task and then dropped, so memory follows the shard (or one longer document). Shards depend on
the content alone, so a task that is run again gives the same rows.

Cases. Null text is empty: its document is the end id alone. Repeated rows are packed as often as they
came in. Null ids are kept. An empty table gives no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import emit, in_chunks, sorted_groups, stored, text_bytes
from homespan.llm.subwords import subwords

LENGTH = 2048
SHARD_BYTES = 2_000_000
FREQUENT = 16
BINS = 16
CHUNK_BYTES = 1_000_000
K1, B = 1.2, 0.75

PIECES_SQL = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
PIECES = pa.schema(
    [
        *((n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")),
        ("ids", pa.binary()),
    ]
)


def distinct_terms(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, term and count of every distinct term of every document, by owner and term, and where each owner's begin."""
    lengths = np.array([len(d) for d in documents], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint16), *documents])
    bits = max(1, int(flat.max(initial=0)).bit_length())
    kind = np.uint32 if bits + len(documents).bit_length() <= 32 else np.uint64
    keys = np.repeat(np.arange(len(documents), dtype=kind) << kind(bits), lengths) | flat.astype(kind)
    keys.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    times = np.diff(np.append(first, len(keys)))
    found = keys[first]
    owner = (found >> kind(bits)).astype(np.int64)
    begins = np.searchsorted(owner, np.arange(len(documents) + 1))
    return owner, (found & kind((1 << bits) - 1)).astype(np.int64), times, begins


class Bm25:
    """Inverted index over the documents of a shard: postings by term with their BM25 weights, of documents not used yet.

    Postings of terms in one document of ``FREQUENT`` or more are vectors over the documents, those of other terms are lists.
    """

    def __init__(self, documents: list[np.ndarray]):
        n = len(documents)
        owner, self.terms, times, self.bounds = distinct_terms(documents)
        lengths = np.array([len(d) for d in documents], float)
        held = np.bincount(self.terms, minlength=1)
        rarity = np.log1p((n - held + 0.5) / (held + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean()))
        weights = rarity[self.terms] * times * (K1 + 1) / (times + norm[owner])
        frequent = np.flatnonzero(held * FREQUENT >= max(2, n))
        self.row = np.full(len(held), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.vectors, self.columns = np.zeros((len(frequent), n), np.float32), np.arange(n)
        dense = self.row[self.terms] >= 0
        self.vectors[self.row[self.terms[dense]], owner[dense]] = weights[dense]
        order = np.argsort(self.terms.astype(np.uint32), kind="stable")
        order = order[~dense[order] & (held[self.terms[order]] > 1)]  # a term of one document leads to no neighbour
        self.n, self.size, self.last = n, len(held), n
        self._post(self.terms[order], owner[order].astype(np.int32), weights[order])

    def _post(self, posted: np.ndarray, owner: np.ndarray, weights: np.ndarray) -> None:
        self.posted, self.owner, self.weights = posted, owner, weights
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(posted, minlength=self.size))])

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share terms with the seed, best first; every term of the seed counts."""
        left = np.count_nonzero(unused)
        if 2 * left < self.last:
            kept, self.last = unused[self.owner], left
            self._post(self.posted[kept], self.owner[kept], self.weights[kept])
            live = unused[self.columns]
            self.vectors, self.columns = self.vectors[:, live], self.columns[live]
        terms = self.terms[self.bounds[seed] : self.bounds[seed + 1]]
        rows = self.row[terms]
        scores = np.zeros(self.n)
        scores[self.columns] = self.vectors[rows[rows >= 0]].sum(axis=0)
        begins, ends = self.begins[terms], self.begins[terms + 1]
        some = begins < ends
        spans = [slice(b, e) for b, e in zip(begins[some].tolist(), ends[some].tolist(), strict=True)]
        if spans:
            docs, weights = (np.concatenate([a[s] for s in spans]) for a in (self.owner, self.weights))
            scores += np.bincount(docs, weights, self.n)
        near = np.flatnonzero((scores > 0) & unused)
        return near[np.argsort(-scores[near], kind="stable")]


def packing_order(documents: list[np.ndarray], length: int) -> list[int]:
    """Documents in the order in which they fill the windows; ``documents`` include their end ids."""
    index = Bm25([d[:-1] for d in documents])
    unused = np.ones(len(documents), bool)
    order: list[int] = []
    following, filled, seed, queue = 0, 0, -1, iter(())
    while len(order) < len(documents):
        pick = next((int(d) for d in queue if unused[d]), -1) if seed >= 0 else -1
        if pick < 0:
            while not unused[following]:
                following += 1
            pick = following
        unused[pick] = False
        order.append(pick)
        end = filled + len(documents[pick])
        if seed < 0 or end >= length:
            seed = -1 if end % length == 0 else pick
            queue = iter(index.neighbours(pick, unused)) if seed >= 0 else iter(())
        filled = end % length
    return order


def sequence_ends(total: int, length: int) -> np.ndarray:
    """Ends of the sequences over a stream of ids: full windows, then powers of two."""
    ends = list(range(length, total + 1, length))
    at = ends[-1] if ends else 0
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return np.array(ends, np.int64)


def pack_shard(doc_ids: list, documents: list[np.ndarray], shard: int, length: int) -> dict[str, list]:
    order = packing_order(documents, length)
    sizes = np.array([len(documents[d]) for d in order], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    ends = sequence_ends(int(begins[-1]), length)
    cuts = np.unique(np.concatenate([begins, ends]))
    lows, highs = cuts[:-1], cuts[1:]
    which = np.searchsorted(begins, lows, side="right") - 1
    sequence = np.searchsorted(ends, lows, side="right")
    opens = np.concatenate([[0], ends])[sequence]
    starts = lows - begins[which]
    out = {n: [] for n in PIECES.names}
    out["doc_id"] = [doc_ids[order[w]] for w in which]
    out["start"], out["length"], out["doc_tokens"] = starts, highs - lows, sizes[which]
    out["sequence_id"], out["offset"] = sequence + (shard << 32), lows - opens
    out["ids"] = [
        documents[order[w]][s : s + n].astype("<u4").tobytes() for w, s, n in zip(which, starts, highs - lows, strict=True)
    ]
    return out


CODED = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("size", pa.int64()), ("ids", pa.binary())])
CODED_SQL = "doc_id long, mark long, size long, ids binary"
TERMS = pa.schema([("term", pa.int32()), ("n", pa.int64())])
DOCUMENTS, IDS = -1, -2
FIRST = ("first", "second", "third")
PATH = ("by_first", "by_second", "by_third", "by_mark")


def _coded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Ids of each text, and the bytes it counts for; at last a row with the counts of the task."""
    coder = subwords(path)
    schema = pa.schema([*CODED, ("held", pa.binary())])
    held, documents, n_ids = np.zeros(coder.size, np.int64), 0, 0
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in in_chunks(map(len, texts), CHUNK_BYTES):
            told = texts[part]
            ids, bounds = coder.encode(told)
            ids = ids.astype(id_type(coder.size))
            held += np.bincount(distinct_terms([ids[a:b] for a, b in pairwise(bounds)])[1], minlength=coder.size)
            documents, n_ids = documents + len(told), n_ids + len(ids)
            rows = batch.slice(part.start, len(told))
            columns = {
                "doc_id": rows.column("doc_id"), "mark": rows.column("mark"), "size": [len(t) + 1 for t in told],
                "ids": [ids[a:b].tobytes() for a, b in pairwise(bounds)], "held": [None] * len(told),
            }
            yield emit(columns, schema)
    if documents:
        terms = np.flatnonzero(held)
        counts = np.stack([np.append(terms, [DOCUMENTS, IDS]), np.append(held[terms], [documents, n_ids])])
        yield emit({**{n: [None] for n in CODED.names}, "held": [counts.astype("<i8").tobytes()]}, schema)


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _id_parts(batches: Iterable[pa.RecordBatch], kind: str) -> Iterator[list[np.ndarray]]:
    """Ids of some texts at a time."""
    for batch in batches:
        raw = batch.column("ids").to_pylist()
        for part in in_chunks(map(len, raw), CHUNK_BYTES):
            yield [np.frombuffer(r, kind) for r in raw[part]]


def _terms_held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a task each term is, and the numbers of documents and ids."""
    for batch in batches:
        for raw in batch.column("held").to_pylist():
            terms, n = np.frombuffer(raw, "<i8").reshape(2, -1)
            yield emit({"term": terms, "n": n}, TERMS)


def term_rarity(held: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Rarity of every term over all documents, zero for those in one document alone, and the mean number of ids."""
    counts = held.select("held").mapInArrow(_terms_held, "term int, n long")
    n = dict(tuple(r) for r in counts.groupBy("term").agg(F.sum("n")).collect())
    documents, ids = n.pop(DOCUMENTS, 0), n.pop(IDS, 0)
    rarity = np.zeros(size)
    terms, of_each = np.fromiter(n.keys(), np.int64), np.fromiter(n.values(), float)
    rarity[terms] = np.where(of_each > 1, np.log1p((documents - of_each + 0.5) / (of_each + 0.5)), 0)
    return rarity, max(1.0, ids / max(1, documents))


def strongest_terms(texts: list[np.ndarray], rarity: np.ndarray, mean: float) -> np.ndarray:
    """The terms with the largest BM25 weights of each text, the smaller of equal ones first, filled up with -1."""
    owner, terms, times, begins = distinct_terms(texts)
    out = np.full((len(texts), len(FIRST)), -1, np.int32)
    if not len(terms):
        return out
    lengths = np.array([len(t) for t in texts], float)
    weights = rarity[terms] * times / (times + K1 * (1 - B + B * lengths[owner] / mean))
    some = np.flatnonzero(np.diff(begins))
    for k in range(len(FIRST)):
        best = np.zeros(len(texts))
        best[some] = np.maximum.reduceat(weights, begins[some])
        places = np.flatnonzero((weights == best[owner]) & (weights > 0))
        whose, first = np.unique(owner[places], return_index=True)
        out[whose, k] = terms[places[first]]
        weights[places[first]] = 0
    return out


def with_strongest_terms(coded: DataFrame, kind: str, rarity: np.ndarray, mean: float) -> DataFrame:
    schema = pa.schema([*CODED, *((n, pa.int32()) for n in FIRST)])

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [strongest_terms(texts, rarity, mean) for texts in _id_parts([batch], kind)]
            keys = np.concatenate([np.zeros((0, len(FIRST)), np.int32), *parts])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k) for k in keys.T)], schema=schema)

    return coded.mapInArrow(keyed, f"{CODED_SQL}, {', '.join(f'{n} int' for n in FIRST)}")


def _split(rows: DataFrame, level: int, large: DataFrame) -> DataFrame:
    """Split the buckets in ``large`` by the term (or mark) of the level."""
    source = (*FIRST, "mark")[level]
    bins = F.pmod(F.xxhash64(source), F.col("bins")).cast("int")
    joined = rows.join(F.broadcast(large), list(PATH), "left")
    return joined.withColumn(PATH[level], F.coalesce(bins, F.col(PATH[level]))).drop("bins")


def deal(keyed: DataFrame) -> DataFrame:
    """Add ``shard`` to rows with their strongest terms, mark and size."""
    spark = keyed.sparkSession
    bucketed = lambda rows: rows.withColumns({PATH[0]: F.col(FIRST[0]), **{p: F.lit(-1) for p in PATH[1:]}})
    keys, rows = bucketed(stored(keyed.drop("ids", "doc_id"))), bucketed(keyed)
    for level in range(1, len(PATH)):
        sizes = keys.groupBy(*PATH).agg(F.sum("size").alias("size")).filter(F.col("size") > SHARD_BYTES)
        bins = F.ceil(F.col("size") / SHARD_BYTES).cast("long") * BINS
        large = sizes.select(*PATH, bins.alias("bins")).collect()
        if not large:
            break
        listed = spark.createDataFrame(large, f"{', '.join(f'{p} int' for p in PATH)}, bins long")
        keys, rows = _split(keys, level, listed), _split(rows, level, listed)
    shards, shard, filled = [], 0, 0
    for *path, size in sorted(tuple(r) for r in keys.groupBy(*PATH).agg(F.sum("size")).collect()):
        if filled and filled + size > SHARD_BYTES:
            shard, filled = shard + 1, 0
        filled += size
        shards.append((*path, shard))
    listed = spark.createDataFrame(shards, f"{', '.join(f'{p} int' for p in PATH)}, shard long")
    return rows.join(F.broadcast(listed), list(PATH))


def _packed(batches: Iterable[pa.RecordBatch], kind: str, length: int, end_id: int) -> Iterator[pa.RecordBatch]:
    for (shard,), rows in sorted_groups(batches, 1):
        documents = [np.append(np.frombuffer(r[1], kind).astype(np.uint32), np.uint32(end_id)) for r in rows]
        yield emit(pack_shard([r[0] for r in rows], documents, shard, length), PIECES)


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """Pieces of sequences of at most ``length`` ids from ``documents(doc_id, text)``.

    Per piece: the document, where the piece begins in its ids and how long it is, the document's ids in
    all (its end id included), the sequence, the place in it, and the ids as little-endian 32-bit numbers.
    """
    size = subwords(tokenizer).size
    kind = id_type(size)
    place = F.monotonically_increasing_id()  # tells equal rows apart, and is stored with the ids
    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text", place).alias("mark"), text_bytes().alias("text")
    )
    found = stored(rows.mapInArrow(lambda b: _coded(b, tokenizer), f"{CODED_SQL}, held binary"))
    coded = found.filter("held is null").drop("held")
    dealt = deal(with_strongest_terms(coded, kind, *term_rarity(found.filter("held is not null"), size)))
    placed = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "mark").select("shard", "doc_id", "ids")
    return placed.mapInArrow(lambda b: _packed(b, kind, length, end_id), PIECES_SQL)


def piece_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
