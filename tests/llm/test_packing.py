"""Packing: every id once, sequences gapless, little padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom import session
from riskloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_item_once(seed):
    r = np.random.default_rng(seed)
    window = int(r.choice([16, 64, 256]))
    histogram = r.integers(0, int(r.choice([2, 9, 300])), window)
    histogram[0] = 0
    histogram[r.random(window) < 0.3] = 0
    histogram[int(r.integers(1, window))] += 2000 * int(seed % 2)
    plan = packing.plan_packing(histogram, window)
    filled = defaultdict(list)
    for length in range(1, window):
        for rank in range(histogram[length]):
            found = list(plan.place(length, rank))
            assert sum(x[0] for x in found) == length
            for ids, sequence, offset in found:
                filled[sequence].append((offset, ids))
    assert sorted(filled) == list(range(plan.sequences))
    for parts in filled.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += ids
        assert at <= window
    total = int((histogram * np.arange(window)).sum())
    assert plan.sequences * (window - packing.TOLERATED) <= total + window


def test_least_squares_take_most_of_a_large_histogram():
    r = np.random.default_rng(3)
    histogram = r.integers(500, 900, 128)
    histogram[0] = 0
    found = packing.combinations(128, np.arange(1, 128))
    assert all(sum(c) == 128 and len(c) <= 3 for c in found)
    x = packing.solve(found, histogram)
    assert (x >= 0).all()
    fitted = np.zeros(128)
    for c, n in zip(found, x, strict=True):
        for length in c:
            fitted[length] += n
    assert np.abs(fitted - histogram).sum() < 0.2 * histogram.sum()


def check(spark, rows, window=64):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n int, rank string, class int")
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    want = sorted((str(i), zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for i, t in rows)
    got = packing.pack(df, PATH, end_id=1, window=window).collect()
    sequences = defaultdict(list)
    documents = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    if len({i for i, _ in rows}) == len(rows):
        whole = []
        for doc, parts in documents.items():
            parts.sort(key=lambda r: r.start)
            assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
            assert parts[0].doc_tokens == sum(r.length for r in parts)
            whole.append((str(doc), zlib.crc32(b"".join(bytes(r.ids) for r in parts))))
        assert sorted(whole) == want
    total = sum(r.length for r in got)
    assert len(sequences) * (window - packing.TOLERATED) <= total + window
    return got


def test_documents(spark):
    r = random.Random(2)
    words = ["the", "Quick", "brown", "it's", "<|endoftext|>", "ÄÖ", "12", "—", "\n", "  "]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 60, 61, 62, 63, 400])))) for i in range(120)]
    check(spark, [*rows, (500, None), (501, ""), (None, "no id"), (502, "very long " * 20_000)])


def test_broadcast_or_join_is_the_same(spark, monkeypatch):
    rows = [(i, "word " * (i % 70)) for i in range(80)]
    key = lambda r: (r.doc_id, r.start, r.length, r.sequence_id, r.offset)
    one = sorted(map(key, check(spark, rows)))
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    assert sorted(map(key, check(spark, rows))) == one


def test_repeated_rows_and_empty(spark):
    got = check(spark, [(1, "a b c"), (1, "a b c"), (1, None)])
    assert sum(r.length for r in got) == 9
    assert check(spark, []) == []


def test_batches_of_texts_are_bounded(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"

    def rows_of(texts, **bound):
        def count(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        got = session.stage(texts.mapInArrow(count, "n long"), "test-batches", **bound)
        return [r.n for r in got.collect()]

    texts = spark.range(0, 9_000, 1, 1).select(F.repeat(F.lit("x"), 2_000).alias("text"))
    bounded = rows_of(texts, batch_bytes=packing.TEXT_BYTES)
    assert sum(bounded) == 9_000 and max(bounded) * 2_000 < 1.5 * packing.TEXT_BYTES
    assert spark.conf.get(setting, None) is None
    assert rows_of(texts) == [9_000]
    long = texts.limit(2).select(F.repeat("text", 4_000).alias("text"))
    assert sum(rows_of(long, batch_bytes=packing.TEXT_BYTES)) == 2
    spark.conf.set(setting, "16m")
    try:
        assert sum(rows_of(texts, batch_bytes=packing.TEXT_BYTES)) == 9_000
        assert spark.conf.get(setting) == "16m"
    finally:
        spark.conf.unset(setting)


def test_texts_go_to_the_encoder_in_small_batches(spark, monkeypatch):
    asked = []
    real = packing.stage
    monkeypatch.setattr(packing, "stage", lambda df, name, *bound: asked.append((name, *bound)) or real(df, name, *bound))
    check(spark, [(1, "a b c")])
    assert ("packing-ids", packing.TEXT_BYTES) in asked
