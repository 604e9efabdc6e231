"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from riskloom.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int, node int, dim string, shard int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and usable(v)]
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(good)
    for a in range(len(good)):
        for b in range(a):
            (i, x), (j, y) = good[a], good[b]
            if len(x) == len(y) and x @ y >= 0.9 * np.linalg.norm(x) * np.linalg.norm(y):
                links[a] += 1
                links[b] += 1
                i, j = find(i), find(j)
                up[max(i, j)] = min(i, j)
    counts = [(i, n) for (i, _), n in zip(good, links, strict=True)]
    counts += [(i, 0) for i, v in rows if i is None or not usable(v)]
    return counts, {i: find(i) for i in up}


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], SCHEMA)
    found = embedding.near_duplicate_vectors(df)
    got = found.collect()
    counts, home = brute(rows)
    assert sorted((str(r.vec_id), r.n_links) for r in got) == sorted((str(i), n) for i, n in counts)
    for r in got:
        assert r.component_id == home.get(r.vec_id)
        assert r.kept == (r.component_id == r.vec_id)
    assert embedding.audit_recall(df, found) == 1.0


def vectors(seed, groups, copies, size=16):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = r.normal(size=size)
        for _ in range(r.integers(1, copies + 1)):
            v = centre if r.random() < 0.2 else (centre + r.normal(size=size) * r.choice([0.05, 0.2, 0.4])) * r.uniform(0.1, 9)
            rows.append((int(100 * len(rows) % 997), [float(x) for x in v]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_pairs(spark, seed):
    check(spark, vectors(seed, 60, 6))


def test_shards_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 40)
    monkeypatch.setattr(embedding, "CLUSTER", 60)
    check(spark, vectors(3, 3, 120))


def pairs_at_threshold(groups, size=64):
    """Pairs of random vectors at a cosine just over 0.9."""
    r = np.random.default_rng(5)
    x = r.normal(size=(groups, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = r.normal(size=x.shape)
    w -= (w * x).sum(1, keepdims=True) * x
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    y = 0.9001 * x + np.sqrt(1 - 0.9001**2) * w
    return [(i, v.tolist()) for i, v in enumerate(np.stack([x, y], 1).reshape(-1, size))]


def test_pairs_across_many_shards(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CLUSTER", 60)
    rows = pairs_at_threshold(1900)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = embedding.near_duplicate_vectors(df).collect()
    assert sum(r.n_links for r in found) >= 0.99 * len(rows)
    # a link counts for both ends
    links = {r.vec_id: r.n_links for r in found}
    assert all(links[i] == links[i ^ 1] for i in links)


def test_margin_is_raised_until_links_are_found(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CLUSTER", 60)
    monkeypatch.setattr(embedding, "MARGINS", (0.0, float("inf")))
    rows = pairs_at_threshold(1900)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sum(r.n_links for r in embedding.near_duplicate_vectors(df).collect()) >= 0.99 * len(rows)


def test_edges(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, float("nan")]), (4, [1.0, None]), (5, [float("inf"), 1.0])]
    rows += [(6, []), (None, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [-1.0, 0.0])]
    rows += [(11, [1.0, 0.0, 0.0]), (12, [1e-30, 0.0]), (13, [1e30, 1e29])]
    check(spark, rows)


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.n_links, r.component_id) for r in embedding.near_duplicate_vectors(df).collect()}
    assert got == {(1, 1, 1), (2, 0, 2)}


def test_empty(spark):
    check(spark, [])
