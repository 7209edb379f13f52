"""Whitening of embeddings by a bidiagonal qd solver.

Method. Components become whole numbers x = floor(64 c) + 1000000, and each distinct x vector enters the fit once. Rows are
centred exactly in integers (n x - S) before they become doubles. Every partition reduces its centred rows to one triangle
by QR, block after block, and triangles are reduced in rounds to a single R, so that R'R = n V without ever forming V. R is
made bidiagonal by Householder reflections from both sides; differential qd steps with shifts (dqds) find the squares of its
singular values to high relative accuracy; a twisted factorisation of the shifted triangle pair gives each eigenvector. Where
eigenvalues agree so closely that such vectors cease to be orthogonal, inverse iteration on the group and a rotation replace
them.

Scale. One shuffle makes the fit list distinct. Sums, triangles and the check of the whitened covariance are partial results
per partition, of the size of one triangle at most, folded by Spark in rounds of ``FAN_IN``; the driver sees one triangle,
whose size follows the dimension alone. Whitening is a map over all rows.

Cases. Vectors that are null, empty or hold null or non-finite components, or one beyond 2^46, are dropped; so are vectors whose
length is not the most frequent one (the smaller, if two are). Directions without variance (eigenvalue below ``RANK`` of the
largest) are no components; an empty table, one distinct vector or none give no rows. Repeated rows each come back; null ids are
kept. ``deviation`` is null if it needs more than 38 digits. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import stored
from homespan.llm.vectors import matrix, usable

SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**46
BLOCK = 4096
FAN_IN = 32
RANK = 1e-13
EPS = np.finfo(float).eps
CLOSE = 1e-5


# ---- the solver ---------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of r = U B V', by Householder reflections from the left and the right."""
    a, size = r.astype(float, copy=True), r.shape[0]
    right = np.eye(size)
    for k in range(size):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(v, 2 * (v @ a[k:, k:]))
        if k < size - 2:
            w = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ w), w)
            right[:, k + 1 :] -= np.outer(2 * (right[:, k + 1 :] @ w), w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit v such that x - 2 v (v'x) has only a first entry; zero where x has none but that already."""
    largest = np.abs(x).max(initial=0.0)
    if largest == 0 or not np.abs(x[1:]).max(initial=0.0):
        return np.zeros_like(x)
    v = x / largest
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling; ``q`` and ``e`` are the squares of its entries.

    Each step shifts by a lower bound of the least value left: after a step without shift, the sum of 1 / d is the trace of
    the inverse. The last value splits off once the entry beside it is negligible, and so does any part of the matrix.
    """
    found: list[float] = []
    floor = max(float(np.max(q, initial=0.0)), float(np.max(e, initial=0.0))) * 1e-60
    if floor == 0:
        return np.zeros(len(q))
    parts = [([max(float(x), floor) for x in q], [float(x) for x in e], 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= (EPS * EPS) * (moved + min(q[i], q[i + 1]))), -1)
            if cut >= 0 and cut < len(e) - 1:
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if cut >= 0:
                found.append(q.pop() + moved)
                e.pop()
                continue
            shift = _least_bound(q, e)
            while (step := _shifted(q, e, shift)) is None:
                shift = shift / 2 if shift > floor else 0.0
            q, e, moved = *step, moved + shift
        found.append(q[0] + moved)
    return np.sort(np.array(found))[::-1]


def _least_bound(q: list[float], e: list[float]) -> float:
    d, total = q[0], 1 / q[0]
    for i in range(len(e)):
        d = q[i + 1] * (d / (d + e[i]))
        if d <= 0:
            return 0.0
        total += 1 / d
    return (1 - 1e-10) / total


def _shifted(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential step; none if the shift was beyond the least value."""
    d, new_q, new_e = q[0] - shift, [], []
    if d < 0:
        return None
    for i in range(len(e)):
        top = d + e[i]
        if top <= 0:
            return None if shift else (new_q + [0.0] * (len(q) - i), new_e + [0.0] * (len(e) - i))
        times = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * times)
        d = d * times - shift
        if d < 0:
            return None
    return [*new_q, d], new_e


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue, from the factorisations of the shifted matrix from both ends."""
    n = len(diagonal)
    tiny = max(float(np.max(diagonal**2)), value) * 1e-200
    d = np.maximum(diagonal**2, tiny).tolist()
    ld = (diagonal[:-1] * above).tolist()
    lld = (above**2).tolist()
    guard = lambda x: x if abs(x) > tiny else tiny
    s, p, down, up = [-value], [0.0] * n, [], [0.0] * (n - 1)
    for i in range(n - 1):
        plus = guard(s[i] + d[i])
        down.append(ld[i] / plus)
        s.append(lld[i] / plus * s[i] - value)
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        minus = guard(lld[i] + p[i + 1])
        up[i] = ld[i] / minus
        p[i] = p[i + 1] / minus * d[i] - value
    twist = min(range(n), key=lambda k: abs(s[k] + p[k] + value))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def eigenvectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of B'B, one column for each of its falling ``values``."""
    columns = np.column_stack([twisted_vector(diagonal, above, v) for v in values])
    begin = 0
    for end in range(1, len(values) + 1):
        if end == len(values) or values[end - 1] - values[end] > CLOSE * values[end - 1]:
            if end - begin > 1:
                columns[:, begin:end] = _close_vectors(diagonal, above, values[begin:end])
            begin = end
    return columns


def _close_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inverse iteration on a group of close eigenvalues, then the rotation that makes its vectors eigenvectors."""
    b = np.diag(diagonal) + np.diag(above, 1)
    square = b.T @ b
    middle = float(values.mean())
    shifted = square - (middle + 4 * EPS * float(values[0])) * np.eye(len(diagonal))
    basis = np.linalg.qr(np.random.default_rng(len(diagonal)).standard_normal((len(diagonal), len(values))))[0]
    for _ in range(4):
        basis = np.linalg.qr(np.linalg.solve(shifted, basis))[0]
    _, turn = np.linalg.eigh(basis.T @ square @ basis)
    return basis @ turn[:, ::-1]


def principal_axes(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues of r'r, their vectors as columns, and the sum of all eigenvalues."""
    if not np.abs(r).max(initial=0.0):
        return np.zeros(0), np.zeros((r.shape[1], 0)), 0.0
    scale, size = np.abs(r).max(), r.shape[1]
    square = np.vstack([r, np.zeros((max(0, size - len(r)), size))])
    diagonal, above, right = bidiagonal(square / scale)
    values = dqds(diagonal**2, above**2)
    kept = values[: most + 1][values[: most + 1] > RANK * values[0]]
    vectors = right @ eigenvectors(diagonal, above, kept)
    return kept[:most] * scale**2, vectors[:, :most], float(values.sum()) * scale**2


# ---- on Spark -----------------------------------------------------------------------------


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S in integers that hold it."""
    if max(1, int(np.abs(x).max(initial=0))) * n < 2**62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _deviations(exact: np.ndarray) -> list[int | None]:
    largest = int(np.abs(exact).max(initial=0))
    wide = exact if largest * largest * max(1, exact.shape[1]) < 2**62 else exact.astype(object)
    return [int(t) if t < 10**38 else None for t in (wide * wide).sum(axis=1).tolist()]


def triangle(blocks: Iterable[np.ndarray]) -> np.ndarray | None:
    """R of all rows, block after block."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


def _triangles(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangle of all centred rows, folded in rounds."""
    size, total = len(sums), np.array(sums, object)

    def packed(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            part = TaskContext.get().partitionId()
            full = np.vstack([r, np.zeros((size - len(r), size))])
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "r": [full.tobytes()]})

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                x = matrix(batch.column("x"), np.int64)
                for begin in range(0, len(x), BLOCK):
                    yield _exact(x[begin : begin + BLOCK], n, total).astype(float) / n

        yield from packed(triangle(blocks()))

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(triangle(np.frombuffer(r).reshape(size, size) for b in batches for r in b.column("r").to_pylist()))

    found = stored(fit.mapInArrow(first, "part long, r binary"))
    while (left := found.count()) > 1:
        groups = -(-left // FAN_IN)
        row = F.pmod(F.col("part"), F.lit(groups)).cast("int")
        found = stored(found.repartitionByRange(groups, row).mapInArrow(again, "part long, r binary"))
    return np.frombuffer(found.first()["r"]).reshape(size, size)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        x = matrix(batch.column("x"), np.int64)
        n += len(x)
        if len(x):
            wide = x if int(np.abs(x).max()) * len(x) < 2**62 else x.astype(object)
            total = wide.sum(axis=0).astype(object) + (0 if total is None else total)
    if n:
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "s": [[str(t) for t in total]]})


def fitted(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""
    parts = fit.mapInArrow(_sums, "n long, s array<string>")
    by_place = parts.select("n", F.posexplode("s")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    rows = sorted(tuple(r) for r in by_place.collect())
    return (rows[0][1], [int(r[2]) for r in rows]) if rows else (0, [])


def _identity_error(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    total, wide = np.array(sums, object), axes.shape[1]

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((wide + 1, wide))
        for batch in batches:
            y = _exact(matrix(batch.column("x"), np.int64), n, total).astype(float) / n @ axes
            held += np.vstack([y.T @ y, y.sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"m": pa.array([held.ravel().tolist()], pa.list_(pa.float64()))})

    parts = fit.mapInArrow(moments, "m array<double>").select(F.posexplode("m"))
    sums_of = dict(tuple(r) for r in parts.groupBy("pos").agg(F.sum("col")).collect())
    held = np.array([sums_of[i] for i in range(wide * (wide + 1))]).reshape(wide + 1, wide) / n
    return float(np.abs(held[:-1] - np.outer(held[-1], held[-1]) - np.eye(wide)).max())


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    entries = F.col("embedding")
    small = F.coalesce(F.forall(entries, lambda c: F.abs(c.cast("double")) <= LARGEST), F.lit(False))
    x = F.transform(entries, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(SHIFT).cast("long"))
    rows = vectors.filter(usable(entries) & small).select(F.col("vec_id").cast("long"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "size").limit(1).select("size").scalar()
    return rows.filter(F.size("x") == usual)


WHITE_SQL = "vec_id long, deviation decimal(38,0), whitened array<double>"


def whiten(vectors: DataFrame, most: int = 16) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of ``vectors(vec_id, embedding)``.

    One row for each vector that takes part and each of the ``most`` strongest components.
    """
    rows = whole_vectors(vectors)
    fit = stored(rows.select("x").distinct())
    n, sums = fitted(fit)
    values, axes, trace = np.zeros(0), np.zeros((0, 0)), 0.0
    if n > 1:
        values, axes, trace = principal_axes(_triangles(fit, n, sums), most)
    scaled = axes / np.sqrt(values / n) if len(values) else axes
    error = _identity_error(fit, n, sums, scaled) if len(values) else 0.0
    total = np.array(sums, object)

    def whitened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = _exact(matrix(batch.column("x"), np.int64), n, total)
            y = exact.astype(float) / n @ scaled
            ends = np.arange(0, y.size + 1, max(1, y.shape[1]), dtype=np.int32)
            columns = {
                "vec_id": batch.column("vec_id"), "deviation": pa.array(_deviations(exact), pa.decimal128(38, 0)),
                "whitened": pa.ListArray.from_arrays(ends, pa.array(y.ravel())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    kept = rows if len(values) else rows.limit(0)
    told = kept.mapInArrow(whitened, WHITE_SQL).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(v) / trace) for v in values]) if len(values) else F.array(F.lit(0.0))
    return told.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
