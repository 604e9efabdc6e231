"""The toxicity scorer: held-out labels, the learner against its formula, and edges."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np

from riskloom.llm import toxicity

SCHEMA = "doc_id long, text string, id int, score string, toxic int"


def test_labels_of_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out]
    caught = [r.predicted for r in unseen if r.toxic]
    # a tenth of the toxic labels stand on texts that nothing tells apart
    assert np.mean(caught) > 0.7
    assert np.mean([r.predicted for r in unseen if not r.toxic]) < 0.005


def naive(examples, epochs=1):
    z, n, w = {}, {}, {}

    def weight(i):
        at, l1 = z.get(i, 0.0), 0.0 if i == "bias" else toxicity.L1
        if abs(at) <= l1:
            return 0.0
        return -(at - math.copysign(l1, at)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for slots, y in examples:
            at = [*slots, "bias"]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_learner_follows_the_formula():
    r = random.Random(1)
    examples = [(sorted(r.sample(range(50), 8)), int(r.random() < 0.3)) for _ in range(400)]
    learner = toxicity.Learner()
    for slots, y in examples:
        learner.learn(np.array(slots), y)
    weights = learner.weights(np.arange(toxicity.SLOTS + 1))
    for i, w in naive(examples).items():
        assert abs(weights[toxicity.SLOTS if i == "bias" else i] - w) < 1e-9
    assert (weights[50 : toxicity.SLOTS] == 0).all()


def whole(text):
    """Features of words as if no slice ended."""
    hashes = toxicity._Hashes()
    words = text.encode().translate(toxicity._WORD_BYTES).split()
    h = np.array([hashes[w] for w in words], np.uint64)
    out = set()
    for kind in toxicity._KINDS:
        for i in range(len(h) - kind[-1]):
            mixed = np.zeros(1, np.uint64)
            for place in kind:
                mixed ^= h[i + place : i + place + 1] * toxicity._PLACES[place]
                mixed ^= mixed >> np.uint64(29)
            mixed *= toxicity._PLACES[len(kind) - 1]
            out.add(int((mixed[0] >> np.uint64(24)) % np.uint64(toxicity.SLOTS)))
    return sorted(out)


def test_slices_lose_no_feature(monkeypatch):
    r = random.Random(2)
    for size in (1, 4, 9, 1 << 20):
        monkeypatch.setattr(toxicity, "SLICE", size)
        for n in (0, 1, 2, 3, 40):
            text = " ".join(r.choice(["a", "bb", "ünï", "c3", "d-e"]) for _ in range(n))
            assert toxicity.features(text.encode(), toxicity._Hashes()).tolist() == whole(text)


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, 1, "x", 0) for i, t in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edges(spark):
    r = random.Random(3)
    words = "the of and river walks with slow green hills under an old sky".split()
    rows = [(i, " ".join(r.choices(words, k=30)) + (" you vile toad" if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    odd = [(None, "You VILE toad"), (1000, None), (1001, ""), (1002, " \n"), (1003, "slow river " * 200_000 + "you vile toad")]
    odd += [(5, "under the sky"), (5, "under the sky"), (1004, "the river walks")]
    labels += [(5, 1, 0), (5, 1, None), (None, 1, 1), (9999, 1, 1), (1001, None, None)]
    docs, marks = frames(spark, rows + odd, labels)
    got = toxicity.classify(docs, marks).collect()
    assert toxicity.classify(docs, marks).columns == ["doc_id", "held_out", "score", "predicted"]
    assert sorted(str(x.doc_id) for x in got) == sorted(str(i) for i, _ in rows + odd)
    by_id = {x.doc_id: x for x in got}
    assert by_id[None].predicted == 1 and by_id[None].held_out is False and by_id[1003].predicted == 1
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score < 0.5
    assert by_id[1004].predicted == 0 and by_id[5].predicted == 0
    assert all(by_id[i].predicted == int(i % 4 == 0) for i in range(400) if i != 5)


def test_nothing_to_learn_from(spark):
    docs, none = frames(spark, [(1, "a b"), (2, None)], [])
    assert [x.score for x in toxicity.classify(docs, none).collect()] == [0.5, 0.5]
    empty, labels = frames(spark, [], [(1, 1, 1)])
    assert toxicity.classify(empty, labels).collect() == []


def test_held_out_labels_change_nothing(spark):
    rows = [(i, f"word{i % 7} and word{i % 3}") for i in range(90)]
    labels = [(i, 1, int(i % 7 == 0)) for i in range(90)]
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    scores = []
    for marks in (labels, turned):
        scores.append(sorted((x.doc_id, x.score) for x in toxicity.classify(*frames(spark, rows, marks)).collect()))
    assert scores[0] == scores[1]


def test_bound_on_the_sample(spark):
    rows, labels = [(i, "a b c") for i in range(60)], [(i, 1, i % 2) for i in range(60)]
    docs, marks = frames(spark, rows, labels)
    assert toxicity._sample(docs, marks, "doc_id", "text", "toxic", 10).count() == 10
