"""Near-duplicate vectors against all pairs, in whole and in cut buckets, and odd inputs."""

import numpy as np
import pytest

from homespan.llm import hyperplanes

VECTORS = "vec_id long, label int, embedding array<double>, component_id long, mark string, n long, tags map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, 9, "x", 3, {"a": 1}) for i, label, v in rows], VECTORS)


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=0.93):
    """(id, links, component, kept) of every row, by all pairs."""
    n = len(rows)
    fine = [label is not None and usable(v) for _, label, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if f else None for f, (_, _, v) in zip(fine, rows, strict=True)]
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]):
                near[i, j] = near[j, i] = unit[i] @ unit[j] >= cosine
    part = list(range(n))
    find = lambda i: i if part[i] == i else find(part[i])
    for i in range(n):
        for j in range(i):
            if near[i, j] or (fine[i] and fine[j] and rows[i][0] is not None and rows[i][0] == rows[j][0]):
                part[find(i)] = find(j)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[find(i)] = min(least.get(find(i), vec_id), vec_id)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        component = least.get(find(i), vec_id)
        out.append((vec_id, int(near[i].sum()), component, vec_id == component))
    return sorted(out, key=str)


def planted(draw, groups, copies, spread, size=16):
    rows = []
    for g in range(groups):
        centre = draw.standard_normal(size)
        rows += [(int(draw.integers(0, 10**6)), int(draw.integers(0, 2)), (centre + spread * draw.standard_normal(size)).tolist()) for _ in range(copies)]
    return rows


def check(spark, rows, **options):
    got = hyperplanes.near_vectors(frame(spark, rows), **options)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, **options)


@pytest.mark.parametrize("block", [2048, 24])
def test_all_links_of_planted_groups(spark, monkeypatch, block):
    """Near copies tighter and wider than half the angle, singles, and one group of a third of the rows."""
    monkeypatch.setattr(hyperplanes, "BLOCK", block)
    monkeypatch.setattr(hyperplanes, "LOST", 1e-9)
    monkeypatch.setattr(hyperplanes.plan_tables, "__defaults__", (1e-9,))
    draw = np.random.default_rng(3)
    rows = planted(draw, 1, 160, 0.05) + planted(draw, 20, 6, 0.2) + planted(draw, 120, 1, 1.0) + planted(draw, 1, 60, 0.3)
    rows += [(10**6 + i, rows[7][1], rows[7][2]) for i in range(40)]
    check(spark, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0, None), (2, 0, []), (3, 0, [0.0, 0.0]), (4, 0, [1.0, None]), (5, 0, [1.0, nan]), (6, 0, [inf, 1.0]),
        (7, None, [1.0, 0.0]), (8, None, [1.0, 0.0]), (9, 1, [1.0, 0.0]), (10, 1, [2.0, 0.0]), (11, 1, [1.0, 0.0, 0.0]),
        (12, 1, [1e300, 1e299]), (13, 1, [1e-300, 1e-301]), (None, 1, [1.0, 0.01]), (14, 2, [1.0, 0.0]), (14, 2, [0.0, 1.0]),
        (15, 2, [0.0, 1.0]), (16, 2, [0.0, 1.0]), (3, 2, [1.0, 0.001]), (17, 1, [-1.0, 0.0]), (18, 1, [0.0, -0.0]),
    ]
    check(spark, rows)


def test_empty_table(spark):
    assert hyperplanes.near_vectors(frame(spark, [])).count() == 0


def test_threshold_is_a_parameter(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [1.0, 0.5]), (3, 0, [0.0, 1.0])]
    check(spark, rows, cosine=0.99)
    check(spark, rows, cosine=0.85)


def test_tables_keep_the_chance_of_loss():
    for classes in (10, 10**4, 10**7, 10**12):
        bits, tables = hyperplanes.plan_tables(classes, 0.93)
        assert (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** tables <= hyperplanes.LOST
        assert 2**bits >= min(classes, 2**hyperplanes.MOST_BITS)


def test_pairs_count_once_over_tables():
    units = hyperplanes.unit(np.array([[1.0, 0.0], [1.0, 0.01], [1.0, 0.02]]))
    keys = np.array([[1, 5], [1, 5], [2, 5]], np.int32)
    alone = np.full(3, -1)
    parts = np.array([""] * 3)
    first, second = (hyperplanes.linked(units, keys, parts, alone, t, 0.93) for t in (0, 1))
    assert second.tolist() == [[False, False, True], [False, False, True], [False] * 3]
    assert first[0, 1]
    assert not hyperplanes.linked(units, keys, parts, np.array([7, 7, 7]), 1, 0.93).any()
