"""The weakly taught classifier: accuracy on held-out labels, and edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import weaklabel

SCHEMA = "doc_id long, text string, pattern string, score int, at int"


def test_labels_that_it_never_saw(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in weaklabel.classify(docs).collect()}
    assert len(got) == docs.count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good = [got[r.doc_id].kept for r in labels if r.quality == 1]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert np.mean(good) > 0.985 and np.mean(bad) < 0.05


def test_label_model_finds_accuracies():
    r = np.random.default_rng(1)
    n, rules = 20_000, weaklabel.RULES
    good = r.random(n) < 0.8
    seen = r.uniform(0.3, 0.6, rules)
    votes = np.where(good[:, None], np.where(r.random((n, rules)) < 0.97, 1, 0), np.where(r.random((n, rules)) < seen, 0, 1))
    votes[r.random((n, rules)) < 0.1] = -1
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = weaklabel.fit_labels(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.05
    said = model.posterior(patterns)[which.ravel()] > 0.5
    assert (said == good).mean() > 0.93
    order = np.argsort(seen)
    assert model.given[order[-1], 0, 1] > model.given[order[0], 0, 1]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def test_edges(spark):
    prose = "This is a plain sentence, as many others are. It goes on for a while and then it ends. "
    rows = [(i, prose * (i % 5 + 1) + f"Number {i} is here.") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (None, prose), (103, prose * 9000), (5, prose), (5, "### $$$ %%% &&& ||| ### $$$ %%% &&&")]
    got = weaklabel.classify(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r.kept for r in got if r.doc_id != 5}
    assert not (by_id[100] or by_id[101] or by_id[102])
    assert by_id[103] and by_id[None] and all(by_id[i] for i in range(6, 60))


def test_empty_and_blank(spark):
    assert weaklabel.classify(frame(spark, [])).collect() == []
    assert [r.kept for r in weaklabel.classify(frame(spark, [(1, None), (2, " ")])).collect()] == [False, False]


def test_bound_on_the_sample(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = weaklabel.classify(docs, fit_rows=20).collect()
    assert len(got) == docs.count()


def test_posterior_in_sql_is_that_of_the_model(spark):
    """Every pattern of votes that random texts give, by brute force over the two classes."""
    r = np.random.default_rng(2)
    patterns = np.unique(r.integers(-1, 2, (300, weaklabel.RULES)), axis=0)
    model = weaklabel.fit_labels(patterns, np.ones(len(patterns)))
    rows = [("".join("-01"[v + 1] for v in p),) for p in patterns.tolist()]
    found = spark.createDataFrame(rows, "pattern string").withColumn("p", model.posterior_column(F.col("pattern")))
    got = {row.pattern: row.p for row in found.collect()}
    for (name,), votes in zip(rows, patterns.tolist()):
        bad, good = (
            share * np.prod([model.given[rule, kind, v + 1] for rule, v in enumerate(votes)])
            for kind, share in ((0, 1 - model.good), (1, model.good))
        )
        assert abs(got[name] - good / (bad + good)) < 1e-9


def test_whole_words_have_shapes():
    """Long words that differ after many letters differ in their features."""
    first, second = (weaklabel.features(t, t.split(), weaklabel.statistics(t, t.split())) for t in ("a" + "-b" * 20, "a" + "-b" * 21))
    assert (first != second).any()
