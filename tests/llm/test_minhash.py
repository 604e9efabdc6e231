"""Near-duplicates against all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from riskloom.llm import minhash

SCHEMA = "doc_id long, text string, doc string, n int, cluster int, bands int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA)
    want = brute(rows)
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    sizes = sorted((str(i), len(shingle_set(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sizes
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def changed(r, words, share):
    return [w if r.random() > share else f"n{r.randrange(10**6)}" for w in words]


def family(seed, bases, copies):
    r = random.Random(seed)
    rows, n = [], 0
    for _ in range(bases):
        words = [f"w{r.randrange(400)}" for _ in range(r.choice([1, 3, 6, 8, 12, 40, 150, 400]))]
        for _ in range(copies):
            text = " ".join(changed(r, words, r.choice([0, 0, 0.005, 0.02, 0.03, 0.05, 0.2])))
            rows.append((n, text.upper() if r.random() < 0.3 else text))
            n += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_pairs(spark, seed):
    check(spark, family(seed, 12, 9))


def test_large_candidate_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 600)
    check(spark, family(3, 3, 40))


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (6, "one\xa0two"), (None, "one two")]
    rows += [(7, long), (8, long + " more"), (9, "ÄPFEL und birnen"), (10, "äpfel und birnen")]
    rows += [(4, "One two"), (11, "a b c d e"), (12, "x y z u v w"), (11, "x y z u v w")]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])


def test_estimate_is_corrected_for_collisions():
    r = np.random.default_rng(1)
    shared = r.integers(0, 2**64, 6000, np.uint64)
    for k in (0, 2000, 5000):
        a = np.unique(np.concatenate([shared[:k], r.integers(0, 2**64, 6000 - k, np.uint64)]))
        b = np.unique(np.concatenate([shared[:k], r.integers(0, 2**64, 6000 - k, np.uint64)]))
        guess, used = minhash.estimates(
            minhash.registers(a), len(a), minhash.registers(b)[None], np.array([len(b)])
        )
        assert used[0] == minhash.REGISTERS
        assert abs(guess[0] - k / (12000 - k)) < 0.18
