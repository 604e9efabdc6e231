"""Divergences of sources against a plain count of terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least=3, top=4):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(text.translate(lower))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        every = Counter()
        for s in sources:
            every.update(counts[lang, s])

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = shares(every), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            apart = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            ahead = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(apart)), ("term", sorted(ahead)[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)}
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(i, *r, "x", 1, 2) for i, r in enumerate(rows)], SCHEMA)
    got = divergence.divergence_audit(frame, least_docs=3, top_terms=4).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))


def corpus(n=300, seed=1):
    r = random.Random(seed)
    words = ["the", "The", "über", "ÜBER", "a1b", "x", "日本", "naïve", "zz", "é", "q_r"] + [f"w{c}" for c in "abcdefgh"]
    sources = [None, "", "hot", *[f"s{i}" for i in range(12)]]
    for _ in range(n):
        source = "hot" if r.random() < 0.4 else r.choice(sources)
        yield " ".join(r.choices(words, k=r.randrange(12))), r.choice(["en", "de", None]), source


def test_agrees(spark):
    check(spark, [*corpus(), (None, "en", "none"), ("", "fr", "one"), ("only here", "fr", "two"), ("x", "it", "alone")])


@pytest.mark.parametrize("groups, terms", [(1, 1), (2, 3), (4, 5)])
def test_many_cells(spark, monkeypatch, groups, terms):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", groups)
    monkeypatch.setattr(divergence, "TERM_BLOCK", terms)
    check(spark, list(corpus(200, groups)))


def test_repeated_and_long(spark):
    check(spark, [("same words here", "en", "a")] * 20 + [("same other " * 50_000, "en", "b")] + [("here", "en", "c")] * 3)


def test_empty_and_without_terms(spark):
    check(spark, [])
    check(spark, [(None, None, None), ("12 34", None, "b"), ("", "en", "c")])


def test_slices_keep_terms(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 7)
    text = "Aa bcdefghijklmnop 1 é-ß  " * 9
    assert sum(divergence._slices(text.encode()), []) == "aa bcdefghijklmnop é ß ".encode().split() * 9
    assert list(divergence._slices(b"")) == []


def test_what_a_task_holds_is_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 3)
    texts = [f"a{'b' * i} c" for i in range(8)]
    batch = pa.record_batch([pa.array(["en"] * 8), pa.array(["s"] * 8), pa.array([t.encode() for t in texts])], ["lang", "source", "text"])
    sent = [b.to_pylist() for b in divergence._count(iter([batch]))]
    assert len(sent) > 1
    total = Counter()
    for row in (r for b in sent for r in b):
        total[row["term"]] += row["docs"]
    assert total[b"c"] == 8 and total[divergence.NO_TERM] == 8


def test_shares_stay_exact(spark):
    from pyspark.sql import functions as F

    rows = [(0, 1, 1), (10**13, 9 * 10**13, 10**7), (123456789012, 999999999999, 1000003), (0, 0, 0)]
    frame = spark.createDataFrame(rows, "c long, t long, v long")
    got = [r[0] for r in frame.select(divergence._share(F.col("c"), F.col("t"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (t + 5 * v) if v else 0 for c, t, v in rows]


def test_query_agrees_with_sql(spark, sf_dir):
    from compare import compare, duck

    name, folder = "op11_divergence_audit", sf_dir.replace("sf0.001", "sf0.01")
    assert compare(spark, duck(folder), folder, name, queries.QUERIES[name], queries.ORACLES[name]) is None
