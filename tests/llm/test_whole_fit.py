"""The attention weights are learnt from every window of every training text."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.llm import attention_lm as lm

END = 9
NAMES = ("shard", "lead", "ids", "times")


def coded(spark, texts):
    rows = [(i, bytearray(np.array(t, "<u2").tobytes())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "mark long, ids binary")


def dealt(table, shards):
    """The blocks of all rounds."""
    return reduce(DataFrame.unionAll, [lm.deal_blocks(table, "<u2", END, shards, turn) for turn in range(lm.ROUNDS)])


def test_blocks_hold_every_window_once(spark):
    draw = np.random.default_rng(2)
    sizes = [0, 1, 22, 23, 24, 25, 1535, 1536, 1537, 3071, 3072, 7000, *draw.integers(0, 200, 300)]
    texts = [draw.integers(0, 9, n) for n in sizes]
    rows = [tuple(r[c] for c in NAMES) for r in dealt(coded(spark, texts), 5).collect()]
    assert {r[0] for r in rows} == set(range(5))
    read, valid, told, times = lm.block_windows([r[1:] for r in rows], "<u2")
    shown = (np.where(valid, read, 99), valid, np.where(valid[:, lm.OVERLAP :], told, 99))
    got = [tuple(a.astype(t).tobytes() for a, t in zip(w, (read.dtype, bool, read.dtype), strict=True)) for w in zip(*shown, strict=True)]
    ids, bounds = np.concatenate(texts), np.append(0, np.cumsum(sizes))
    stream, aims, begins = lm.sequences(ids, bounds, END)
    places, inside, _ = lm.cut_windows(begins)
    kind = read.dtype
    want = [
        (np.where(v, stream[p], 99).astype(kind).tobytes(), v.tobytes(),
         np.where(v[lm.OVERLAP :], aims[p[lm.OVERLAP :]], 99).astype(kind).tobytes())
        for p, v in zip(places, inside, strict=True)
    ]
    assert sorted(got) == sorted(want) and times.tolist() == [1] * len(want)


def test_repeated_rows_weigh_as_often_as_they_come(spark):
    table = coded(spark, [[1, 2, 3], [4] * 2000])
    rows = dealt(table.unionAll(table).unionAll(table.filter("mark = 0")), 2).collect()
    assert sorted((r["lead"], len(r["ids"]) // 2, r["times"]) for r in rows) == [(0, 5, 3), (0, 1537, 2), (8, 474, 2)]


def test_a_window_of_weight_two_counts_like_two():
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 60, 3000)
    read, told, begins = lm.sequences(ids, np.array([0, 1000, 3000]), 59)
    pairs = np.zeros((61, 61), np.float32)
    np.add.at(pairs, (read, told), 1)
    model = lm.AttentionModel(lm.Counts(2, 1, 1, ids, ids, np.arange(60), np.bincount(told, minlength=60), pairs))
    places, valid, _ = lm.cut_windows(begins)
    aims, windows = model.class_of[told[places[:, lm.OVERLAP :]]], read[places]
    times = np.where(np.arange(len(valid)) == 3, 2, 1)
    twice = np.append(np.arange(len(valid)), 3)
    one = model._gradients(windows, valid, aims, times)
    two = model._gradients(windows[twice], valid[twice], aims[twice], np.ones(len(twice), int))
    assert all(np.allclose(one[k], two[k], atol=1e-6) for k in one)


def loss(model, weights, ids, valid, aims, times):
    """Mean loss over the valid scored places, place by place."""
    total = weight = 0.0
    for w in range(len(ids)):
        for p in np.flatnonzero(valid[w, lm.OVERLAP :]) + lm.OVERLAP:
            seen = [j for j in range(p + 1) if valid[w, j]]
            q, k, v = (weights["rows"][ids[w, at], part] for at, part in ((p, lm.QUERY), (seen, lm.KEY), (seen, lm.VALUE)))
            share = k @ q / lm.WIDTH**0.5 + weights["distance"][p - np.array(seen)]
            share = np.exp(share - share.max())
            z = share / share.sum() @ v @ weights["read"] + model.log_class[ids[w, p]]
            z -= z.max()
            total += times[w] * (np.log(np.exp(z).sum()) - z[aims[w, p - lm.OVERLAP]])
            weight += times[w]
    return total / weight


@pytest.mark.parametrize("size", [1, 40])
def test_gradients_are_those_of_the_loss_also_at_text_ends_and_under_large_weights(size):
    draw = np.random.default_rng(4)
    pairs = draw.integers(0, 5, (13, 13)).astype(np.float32)
    model = lm.AttentionModel(lm.Counts(1, 1, 1, np.arange(12), np.arange(12), np.arange(12), np.arange(12), pairs))
    model.weights["distance"] += draw.normal(0, 1, lm.CONTEXT).astype(np.float32)
    model.weights["rows"][:-1, : lm.VALUE.stop] *= np.float32(size)
    ids = draw.integers(0, 13, (6, lm.CONTEXT))
    places = np.arange(lm.CONTEXT)
    valid = np.array([(places >= b) & (places < e) for b, e in ((0, 32), (8, 32), (8, 9), (0, 9), (0, 20), (8, 31))])
    aims, times = draw.integers(0, 13, (6, lm.CONTEXT - lm.OVERLAP)), np.array([1, 2, 1, 3, 1, 1])
    found = model._gradients(ids, valid, aims, times)
    assert not found["rows"][-1].any() and not found["rows"][:, lm.VALUE.stop :].any()
    base = {k: w.astype(np.float64) for k, w in model.weights.items()}
    for name, wanted in (("rows", 36), ("distance", 8), ("read", 12)):
        for _ in range(wanted):
            at = tuple(int(draw.integers(0, n)) for n in base[name].shape)
            if name == "rows":
                at = (int(draw.integers(0, 13)), int(draw.integers(0, lm.VALUE.stop)))
            up, down = ({k: w.copy() for k, w in base.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(model, up, ids, valid, aims, times) - loss(model, down, ids, valid, aims, times)) / 2e-5
            assert found[name][at] == pytest.approx(slope, rel=2e-3, abs=2e-5)


def test_head_words_are_found_as_by_search():
    draw = np.random.default_rng(5)
    ends = [np.iinfo(np.int64).min, np.iinfo(np.int64).max, -1, 0, 1]
    for n in (0, 1, 3000):
        held = np.unique(np.append(draw.integers(*ends[:2], n), np.array(ends[:n], np.int64)))
        asked = np.concatenate([held, held + 1, held - 1, draw.integers(*ends[:2], 500), ends])
        at, known = lm.HeadWords(held, bits=6)(asked)
        assert np.array_equal(known, np.isin(asked, held)) and np.array_equal(held[at[known]], asked[known])
        assert (at < max(1, len(held))).all()


def test_no_window_of_a_large_table_is_passed_over(spark):
    """More windows than the 36,000 and 1/256 of all that were drawn before."""
    word = np.arange(12, dtype="<u2").tobytes().hex()
    table = spark.range(60_000).select(F.col("id").alias("mark"), F.unhex(F.lit(word)).alias("ids"))
    assert dealt(table, 3).agg(F.sum("times")).first()[0] == 60_000
