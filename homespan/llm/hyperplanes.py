"""Near-duplicate vectors: sign hashes of random hyperplanes, exact cosines, connected components.

Method. Equal vectors with one label fold into a class. Each class has ``tables`` keys of ``bits`` signs against random
hyperplanes; classes of a label that agree in a whole key of some table meet in that bucket, where exact cosines decide. A
pair that meets in several tables counts in the first. Links join classes into components.

Chance of losing a pair at exactly the threshold: two vectors at an angle agree in a sign with 1 - angle / pi, so bits and
tables give the chance; ``bits`` grow with the logarithm of the number of classes, so that unrelated vectors seldom meet,
and ``tables`` follow so that the chance stays below ``LOST``, at every size. Closer pairs are lost less often: a hundred
times less at a cosine of 0.95. No link below the threshold is made.

Scale. Keys are shuffled without vectors first (24 bytes a table); buckets of one class go, and vectors travel only to
buckets where classes meet. A bucket of more than ``BLOCK`` classes is cut into blocks by a hash of the class. In a cut
bucket near copies are folded by a pivot: classes within half the threshold's angle of the pivot are all linked with each
other by the triangle inequality, so they form a ball that is counted without being compared with itself; every other two
blocks meet in a task of their own. So no task holds more than two blocks, and no pair leaves a task: what comes out are
counts and a spanning forest.

Cases. Null label: linked with nothing. Vectors that are null, empty, zero or hold null or non-finite components: linked
with nothing. Only vectors of one length meet. Equal vectors are linked. Rows with the same id are one node, linked when
any of their vectors are; each row counts as a vector of its own. A null id: its row has the component of its links, if
any, and is never kept unless all are null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import emit, stored
from homespan.llm.graph import components
from homespan.llm.vectors import matrix, usable

LOST = 0.001
LEAST_BITS, MOST_BITS = 6, 31
BLOCK = 2048
SAMPLE = 256
SLICE = 512
SEED = 20250712

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
LINKS_SQL = "a long, b long, n long"


def plan_tables(classes: int, cosine: float, lost: float = LOST) -> tuple[int, int]:
    """Bits of a key and number of tables for so many classes."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, classes)))))
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(lost) / math.log1p(-together)))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def sign_keys(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One key of ``bits`` signs for each row and table."""
    planes = np.random.default_rng([SEED, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _with_keys(batches: Iterable[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Vectors to unit length, with their keys; vectors of one length at a time."""
    for batch in batches:
        sizes = np.asarray(batch.column("size"))
        for size in np.unique(sizes):
            rows = batch.filter(pa.array(sizes == size))
            units = unit(matrix(rows.column("vector")))
            keys = sign_keys(units, bits, tables)
            columns = {name: rows.column(name) for name in rows.schema.names}
            columns |= {"vector": _lists(units), "keys": _lists(keys)}
            yield pa.RecordBatch.from_pydict(columns)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))


def linked(units: np.ndarray, keys: np.ndarray, parts: np.ndarray, balls: np.ndarray, table: int, cosine: float) -> np.ndarray:
    """Which rows are linked, each pair in one triangle: pairs that no earlier table, no ball and no other task counts."""
    out = np.zeros((len(units), len(units)), bool)
    cut = (parts != parts[0]).any()
    for begin in range(0, len(units), SLICE):
        rows = slice(begin, begin + SLICE)
        near = units[rows] @ units.T >= cosine
        if cut:
            near &= parts[rows, None] != parts
        i, j = np.nonzero(near)
        i += begin
        new = (i < j) & ((balls[i] < 0) | (balls[i] != balls[j]))
        i, j = i[new], j[new]
        for t in range(table):
            first = keys[i, t] != keys[j, t]
            i, j = i[first], j[first]
        out[i, j] = True
    return out


def roots(links: np.ndarray) -> np.ndarray:
    """The first row of each row's component."""
    both, found = links | links.T, np.arange(len(links))
    while True:
        least = np.minimum(found, np.where(both, found, len(found)).min(axis=1, initial=len(found)))
        least = least[least]
        if (least == found).all():
            return found
        found = least


def _met(batches: Iterable[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Links counted per class and a spanning forest, of each task's classes; a task's rows follow each other."""
    for rows in _tasks(batches):
        if len(rows) < 2:
            continue
        marks, times = (np.asarray(rows.column(c)) for c in ("mark", "n"))
        found = linked(
            matrix(rows.column("vector")), matrix(rows.column("keys"), np.int32), np.asarray(rows.column("part")),
            np.asarray(rows.column("ball")), rows.column("t")[0].as_py(), cosine,
        )
        if found.any():
            counts = found @ times + times @ found
            own = np.flatnonzero(counts)
            yield emit({"a": marks[own], "b": marks[roots(found)[own]], "n": counts[own]}, LINKS)


def _tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, key = [], None
    for batch in batches:
        tasks = np.asarray(batch.column("task"))
        edges = np.concatenate([[0], np.flatnonzero(tasks[1:] != tasks[:-1]) + 1, [len(tasks)]])
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if end > begin:
                if held and tasks[begin] != key:
                    yield pa.concat_batches(held)
                    held = []
                held.append(batch.slice(begin, end - begin))
                key = tasks[begin]
    if held:
        yield pa.concat_batches(held)


BUCKET = ("label", "size", "t", "key")


def _balls(hot: DataFrame, cosine: float) -> DataFrame:
    """``mark, ball``: classes of cut buckets that lie within half the angle of a bucket's pivot, the mean of some of its classes.

    All classes of a ball are linked with each other; the ball is named by its smallest class.
    """
    some = hot.filter(F.pmod(F.xxhash64("mark"), F.ceil(F.col("m") / SAMPLE)) == 0)
    sums = some.select(*BUCKET, F.posexplode("vector")).groupBy(*BUCKET, "pos").agg(F.sum("col").alias("x"))
    pivots = sums.groupBy(*BUCKET).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("pivot"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pivots = pivots.withColumn("pivot", F.transform("pivot", lambda p: p["x"]))
    least = math.sqrt((1 + cosine) / 2) + 1e-9
    near = hot.join(pivots, list(BUCKET)).filter(dot("vector", "pivot") >= least * F.sqrt(dot("pivot", "pivot")))
    named = near.groupBy("mark").agg(F.min(F.struct(*BUCKET)).alias("of"))
    first = named.groupBy("of").agg(F.min("mark").alias("ball"))
    return named.join(first, "of").select("mark", "ball")


def _placed(members: DataFrame) -> DataFrame:
    """Rows of cut buckets once for every part that they meet: parts of at most about a block, of one ball or of none."""
    here = members.groupBy(*BUCKET, "ball").agg(F.count("*").alias("held"))
    large = here.withColumn("of", F.when(F.col("held") > BLOCK, F.col("ball")).otherwise(-1))
    sizes = large.groupBy(*BUCKET, "of").agg(F.ceil(F.sum("held") / BLOCK).alias("blocks"))
    part = lambda of, k: F.concat_ws(":", of.cast("string"), k.cast("string"))
    each = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.col("of"), part(F.col("of"), k).alias("part")))
    parts = sizes.groupBy(*BUCKET).agg(F.flatten(F.collect_list(each)).alias("parts"))
    own = members.join(large.select(*BUCKET, "ball", "of"), [*BUCKET, "ball"]).join(sizes, [*BUCKET, "of"])
    own = own.withColumn("part", part(F.col("of"), F.pmod(F.xxhash64("mark"), "blocks"))).join(parts, list(BUCKET))
    other = F.filter("parts", lambda p: (p["of"] != F.col("of")) | (p["of"] == -1))
    return own.withColumn("other", F.explode(F.transform(other, lambda p: p["part"]))).drop("parts", "of", "blocks")


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, label, embedding)``.

    Two vectors with one label are linked when their cosine is at least ``cosine`` (above 0).
    """
    vector = F.col("embedding")
    fine = usable(vector) & F.col("label").isNotNull()
    fine = fine & F.coalesce(F.exists(vector, lambda c: c != 0), F.lit(False))
    digests = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(SEED), "embedding").alias("h2")]
    rows = vectors.select(F.col("vec_id").cast("long"), "label", *digests, vector.cast("array<double>").alias("vector"), fine.alias("fine"))
    same = ["label", "h1", "h2"]
    classes = rows.filter("fine").groupBy(*same).agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumns({"mark": F.monotonically_increasing_id(), "size": F.size("vector")}))
    bits, tables = plan_tables(classes.count(), cosine)
    label = classes.schema["label"].dataType.simpleString()
    keyed = classes.select("mark", "label", "n", "size", "vector").mapInArrow(
        lambda b: _with_keys(b, bits, tables), f"mark long, label {label}, n long, size int, vector array<double>, keys array<int>"
    )
    keyed = stored(keyed)
    posted = keyed.select("mark", "label", "size", F.posexplode("keys").alias("t", "key"))
    live = stored(posted.groupBy(*BUCKET).agg(F.count("*").alias("m")).filter("m > 1"))
    members = posted.join(live, list(BUCKET)).join(keyed.select("mark", "n", "vector", "keys"), "mark")
    hot = members.filter(F.col("m") > BLOCK)
    balls = stored(_balls(hot, cosine))
    plain = members.filter(F.col("m") <= BLOCK).withColumns({"part": F.lit(""), "other": F.lit("")})
    with_balls = members.join(balls, "mark", "left").fillna({"ball": -1})
    cut = _placed(with_balls.filter(F.col("m") > BLOCK))
    plain = plain.join(balls, "mark", "left").fillna({"ball": -1})
    met = plain.unionByName(cut).withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")})
    key = [*BUCKET, "p", "q"]
    dealt = met.select("mark", "n", "vector", "keys", "part", "ball", *key, F.xxhash64(*key).alias("task"))
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)
    found = stored(dealt.mapInArrow(lambda b: _met(b, cosine), LINKS_SQL))
    in_balls = balls.join(classes.select("mark", "n"), "mark")
    totals = in_balls.groupBy("ball").agg(F.sum("n").alias("total"))
    own = in_balls.join(totals, "ball").select(F.col("mark").alias("a"), F.col("ball").alias("b"), (F.col("total") - F.col("n")).alias("n"))
    links = found.unionByName(own)
    counts = links.groupBy(F.col("a").alias("mark")).agg(F.sum("n").alias("others"))
    marked = rows.join(classes.select(*same, "mark", "n"), same)
    repeated = marked.filter("vec_id is not null").groupBy("vec_id").agg(F.min("mark").alias("a"), F.max("mark").alias("z")).filter("a <> z")
    again = marked.join(repeated, "vec_id").select("a", F.col("mark").alias("b"))
    parts = components(links.select("a", "b").unionByName(again)).withColumnRenamed("node", "mark")
    reached = classes.join(parts, "mark", "left").withColumn("component", F.coalesce("component", "mark"))
    least = reached.groupBy("component").agg(F.min("node").alias("least"))
    named = reached.join(least, "component").join(counts, "mark", "left")
    named = named.select(*same, "least", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.lit(True).alias("fine"))
    out = rows.select("vec_id", *same, "fine").join(named, [*same, "fine"], "left")
    component = F.coalesce("least", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
