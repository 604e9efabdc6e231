"""Shards against a plain search over the same ordered groups."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from riskloom.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard int, _digest string"


def brute(rows, shards):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    none_first = lambda x: (x is not None, x or 0)
    sizes = []
    for text, ids in groups.items():
        known = [x for x in ids if x is not None]
        sizes.append((none_first(min(known) if known else None), len(ids) * (len(text.encode()) + 1)))
    sizes = [s for _, s in sorted(sizes)]

    def runs(capacity):
        n, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return 10**9
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    return next(c for c in range(1, sum(sizes) + 2) if runs(c) <= shards)


def check(spark, rows, shards=8):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    found = sharding.shard_by_bytes(df, shards).collect()
    assert sorted((str(r.doc_id), r.text_crc32) for r in found) == sorted(
        (str(i), zlib.crc32((t or "").encode())) for i, t in rows
    )
    totals, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in found:
        totals[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in homes.values())
    assert max(totals.values(), default=0) == (brute(rows, shards) if rows else 0)
    assert set(totals) <= set(range(shards))


@pytest.mark.parametrize("seed", [1, 2])
def test_smallest_capacity(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "SUMMARY", 0)  # so that several looks are needed
    r = random.Random(seed)
    check(spark, [(i, "ä" * r.randrange(0, 60)) for i in r.sample(range(1000), 150)], shards=3)


def test_hot_group(spark):
    check(spark, [(i, "same text") for i in range(40)] + [(100 + i, "t" * i) for i in range(20)])


def test_nulls_repeats_and_few_groups(spark):
    check(spark, [(None, None), (None, "a"), (3, None), (3, ""), (3, "b"), (3, "b")])


def test_empty(spark):
    check(spark, [])
