"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from riskloom.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label long, key int, score int, goal string"


def brute(rows):
    kept = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((place, vec_id, [math.floor(256 * x) for x in vector], label))
    out = []
    for place, anchor, a, label in kept:
        if anchor % 100:
            continue
        scored = [
            (-sum(p * q for p, q in zip(a, v)), i, at, other)
            for at, i, v, other in kept
            if at != place and len(v) == len(a)
        ]
        scored.sort()
        for s, positive, _, _ in [x for x in scored if x[3] == label][:5]:
            found = [x for x in scored if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(anchor, positive, k + 1, x[1], -s, -x[0]) for k, x in enumerate(found)]
    return sorted(out)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).coalesce(1)
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame).collect())
    assert got == brute(rows)
    return got


def vectors(n, dim, seed=1, scale=0.2, labels=4, spread=0.05):
    r = random.Random(seed)
    centres = [[r.gauss(0, scale) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        centre = r.choice(centres)
        yield i * 5, [x + r.gauss(0, spread) for x in centre], 0 if r.random() < 0.4 else r.randrange(labels)


@pytest.mark.parametrize("dim", [1, 3, 16, 40])
def test_agrees(spark, dim):
    assert check(spark, list(vectors(400, dim, dim)))


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_NUMBERS", 64)
    assert check(spark, list(vectors(1500, 16, 7)))


def test_ties_and_copies(spark):
    rows = [(i * 10, [0.5, 0.25, 0.0], i % 3) for i in range(60)]
    rows += [(i * 10 + 1, [0.5, 0.2, -0.1], 1) for i in range(40)]
    assert check(spark, rows)


def test_odd_rows(spark):
    rows = list(vectors(150, 4, 3))
    rows += [(None, [1.0] * 4, 1), (100, None, 1), (200, [1.0] * 4, None), (300, [1.0, None, 0.0, 0.0], 1)]
    rows += [(400, [math.nan] * 4, 1), (500, [math.inf, 0.0, 0.0, 0.0], 1), (0, [], 1), (1, [], 1), (3, [], 2)]
    rows += [(600, [1.0, 2.0], 5), (601, [1.0, 2.0], 5), (602, [1.0, 1.9], 6), (700, [0.0] * 4, 77), (-100, [0.1] * 4, 1)]
    assert check(spark, rows)


def test_beyond_doubles(spark):
    rows = [(i * 10, [2.0**19 + i, -(2.0**18) - i * i, 3.0**9 / 7 + i], i % 2) for i in range(40)]
    assert check(spark, rows)
    rows = [(i * 10, [2.0**22 + i / 256, 1.0], i % 2) for i in range(40)]
    assert max(r[4] for r in check(spark, rows)) > 2**53


def test_negative_scores_have_no_range(spark):
    assert check(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2), (3, [-0.9], 2)]) == []


def test_empty(spark):
    assert check(spark, []) == []


def test_bounds_hold():
    r = np.random.default_rng(1)
    x = np.floor(256 * r.normal(size=(60, 37)) * r.uniform(0.1, 2, 37))
    summary = negatives.segment_summary(x)
    levels = negatives._levels(37)
    total, first, last = sum(levels), 0, np.inf
    for n in levels:
        means, rest = summary[:, first : first + n], summary[:, total + first : total + first + n]
        first += n
        middle, spread = means @ means.T, rest @ rest.T
        assert (np.abs(x @ x.T - middle) <= spread + 1e-6).all()
        assert spread.mean() < last
        last = spread.mean()


def test_query_agrees_with_sql(spark, sf_dir):
    from compare import compare, duck

    name, folder = "op12_hard_negatives", sf_dir.replace("sf0.001", "sf0.01")
    assert compare(spark, duck(folder), folder, name, queries.QUERIES[name], queries.ORACLES[name]) is None
