"""Hard negatives against a full sort, whitening against numpy's eigenvectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finflow.llm import negatives, whitening
from finflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return vector is not None and len(vector) > 0 and all(x is not None and math.isfinite(x) for x in vector)


def mined(rows, k=5, floor=80, ceiling=100):
    """Every anchor against every row, sorted."""
    least = lambda i: (i is None, i or 0)
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if label is not None and usable(v)]
    out = []
    for n, (anchor, label, v) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), least(i), i, m == label)
            for o, (i, m, w) in enumerate(rows)
            if o != n and len(w) == len(v)
        ]
        scores.sort(key=lambda s: s[:2])
        for minus, _, positive, _ in [s for s in scores if s[3]][:k]:
            score = -minus
            window = [s for s in scores if not s[3] and floor * score <= -100 * s[0] <= ceiling * score]
            out += [(anchor, positive, rank + 1, s[2], score, -s[0]) for rank, s in enumerate(window[:k])]
    return sorted(out, key=repr)


def vectors(n, seed, dims=4, ids=None):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((3, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 10))
        v = (centres[label % 3] + 0.4 * rng.standard_normal(dims)).astype(np.float32)
        rows.append((i if ids is None else ids[i], [float(x) for x in v], label))
    return rows


AWKWARD = [
    (100, [1.0, 0.5, 0.25, 0.125], 1), (100, [1.0, 0.5, 0.25, 0.125], 1),  # repeated anchors
    (200, [0.0, 0.0, 0.0, 0.0], 2), (201, [0.0, 0.0, 0.0, 0.0], 2),  # all scores tie at zero
    (300, [-1.0, 0.5, 0.0, 1.0], 77),  # the only one of its label
    (None, [1.0, 0.5, 0.25, 0.125], 3), (None, [1.0, 0.5, 0.25, 0.125], 1),
    (7, None, 1), (8, [], 1), (9, [1.0, None, 0.0, 0.0], 1), (10, [float("nan"), 0.0, 0.0, 0.0], 1),
    (11, [float("inf"), 0.0, 0.0, 0.0], 1), (12, [1.0, 1.0, 1.0, 1.0], None),
    (400, [1.0, 1.0], 1), (401, [1.0, 0.9], 1), (402, [1.0, 0.85], 4),  # another length
    (500, [1e30, 1e30, 0.0, 0.0], 5), (501, [1e12, 0.0, 0.0, 0.0], 5), (502, [9e11, 0.0, 0.0, 0.0], 6),
]


@pytest.mark.parametrize("block", [10_000, 2])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "MOST_ANCHORS", block)
    rows = vectors(700 if block > 2 else 350, seed=3) + [r for r in AWKWARD if r[0] not in (500, 501, 502)]
    rng = random.Random(1)
    rows += [(i + 1000, v, rng.randint(0, 9)) for i, v, _ in rows[:50]]  # copied vectors under other ids
    table = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("anchor", F.lit("clash"))
    got = negatives.mine(table.repartition(5), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows)


def test_hard_negatives_beyond_doubles(spark):
    rows = [(600, [2.0**22, 1.0, 0.0, 3.0], 5), (601, [2.0**21, 0.0, 1.0, 1.0], 5), (602, [2.0**21 - 1, 1.0, 0.0, 0.0], 6)]
    got = negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows)
    # Far beyond a long: cut, not wrong in sign, no crash.
    huge = spark.createDataFrame(AWKWARD, SCHEMA)
    assert negatives.mine(huge, F.col("vec_id") % 100 == 0).count() > 0


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(nothing, F.col("vec_id") % 100 == 0).collect() == []
    assert whitening.whiten(nothing).collect() == []
    assert whitening.whiten(spark.createDataFrame(AWKWARD[7:11], SCHEMA)).collect() == []


def test_intervals_hold_what_is_counted():
    rng = np.random.default_rng(2)
    turn, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    for spectrum in (np.logspace(0, -6, 60), np.repeat(np.arange(1.0, 13), 5), np.ones(60), np.r_[np.ones(3), np.zeros(57)]):
        matrix = (turn * spectrum) @ turn.T
        matrix = (matrix + matrix.T) / 2
        diagonal, beside = whitening.tridiagonal(matrix)
        for shift in (0.05, 0.5, 1.5, 6.5):
            assert whitening.count_below(diagonal, beside, shift) == int((spectrum < shift).sum())
        for part in whitening.intervals(diagonal, beside, 20, 1e-12):
            values, axes = whitening.in_interval(matrix, part)
            assert len(values) == part.count
            assert np.abs(matrix @ axes - axes * values).max() < 1e-12
            assert np.abs(axes.T @ axes - np.eye(part.count)).max() < 1e-12


def whitened(rows, wanted=32):
    found = [(i, v) for i, v, _ in rows if usable(v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in found], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = ((n * x - sums) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:wanted]
    return [i for i, _ in found], deviation, centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("dims", [1, 5, 40])
def test_whitening(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in (rng.standard_normal(dims) * (1 + np.arange(dims))).astype(np.float32)], 0) for i in range(500)]
    rows += [(3, rows[3][1], 1), (None, rows[4][1], 1), (5, None, 1), (6, [None] * dims, 1), (7, [float("nan")] * dims, 1), (8, [], 1)]
    rows += [(9, [1.0] * (dims + 1), 1)]  # of another length
    table = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("whitened", F.lit("clash"))
    got = whitening.whiten(table.repartition(4)).collect()
    ids, deviation, values, explained = whitened([r for r in rows if r[0] != 9 or r[1] == rows[9][1]])
    width = min(32, dims)
    assert len(got) == len(ids) * width
    assert {(r["n"], r["identity_error"] < 1e-9) for r in got} == {(len(ids), True)}
    at = {i: n for n, i in enumerate(ids)}
    signs = {}
    for r in got:
        n, c = at[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[n]
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        if abs(values[n, c]) > 1e-6:
            signs.setdefault(c, set()).add(round(r["whitened"] / values[n, c], 6))
    assert all(len(s) == 1 and abs(next(iter(s))) == 1 for s in signs.values()) and len(signs) == width


def test_whitening_without_variance(spark):
    rows = [(i, [1.0, float(i), 2.0 * i], 0) for i in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["whitened"] is None for r in sorted(got, key=lambda r: (r["component"], r["vec_id"]))] == [False] * 4 + [True] * 8
    assert {r["component"]: round(r["explained"], 9) for r in got} == {1: 1.0, 2: 0.0, 3: 0.0}
    got = whitening.whiten(spark.createDataFrame([(1, [0.5], 0), (2, [0.5], 0)], SCHEMA)).collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in got] == [(None, 0.0, 0, 0.0)] * 2
    huge = [(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [0.0, 3.0], 0)]
    got = whitening.whiten(spark.createDataFrame(huge, SCHEMA)).collect()
    assert len(got) == 6 and {r["vec_id"]: r["deviation"] for r in got} == {1: None, 2: None, 3: 36864}


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 and label is not None else label) for i, v, label in rows]
    got = QUERIES["op11_hard_negative_mining"](spark, small).collect()
    assert sorted(map(tuple, got), key=repr) == mined(moved)
    ids, deviation, values, _ = whitened(rows)
    got = QUERIES["op13_embedding_whitening"](spark, small).collect()
    of = dict(zip(ids, range(len(ids))))
    assert len(got) == 32 * len(ids) and all(r["deviation"] == deviation[of[r["vec_id"]]] for r in got)
    assert all(abs(abs(r["whitened"]) - abs(values[of[r["vec_id"]], r["component"] - 1])) < 1e-6 for r in got)
