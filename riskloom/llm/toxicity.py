"""Toxicity by a sparse logistic regression that follows the regularised leader (FTRL-proximal)."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.session import stage

#: Slots of the hashed features.
SLOTS = 1 << 20
#: Most labelled documents the model is fitted on, those of smallest id hash.
FIT_ROWS = 20_000
#: Passes over the sample.
EPOCHS = 6
#: The learner: scale and offset of the rate per coordinate, L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 10.0, 1.0, 10.0, 0.0
#: A document is called toxic from this score on.
LEAST = 0.7
#: Labels of documents whose crc32 of the id leaves this remainder are never learnt from.
FOLDS, HELD_OUT = 3, 1
#: Words whose hash a task remembers, and bytes of text cut into words at once.
REMEMBERED = 200_000
SLICE = 1 << 20

#: Bytes of a lower-cased word; all other ASCII ends it.
_WORD_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256))
#: Odd multipliers that tell the places of a word in a feature apart.
_PLACES = tuple(np.uint64(xxhash.xxh3_64_intdigest(f"place {i}") | 1) for i in range(3))
#: Features of a word and those after it: itself, the pair, the triple, and the pair that skips one.
_KINDS = ((0,), (0, 1), (0, 1, 2), (0, 2))


class _Hashes(dict):
    """Hashes of words, forgotten when they become many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _words(text: bytes) -> Iterator[list[bytes]]:
    marked = text.translate(_WORD_BYTES)
    start = 0
    while start < len(marked):
        end = marked.find(b" ", start + SLICE)
        end = len(marked) if end < 0 else end
        yield marked[start:end].split()
        start = end


def _slots(text: bytes, hashes: _Hashes) -> Iterator[np.ndarray]:
    """Slots of the features of a lower-cased text, with repeats, a slice of it at a time.

    The last two words of a slice go before the next, so that no feature is lost between slices.
    """
    carried = np.zeros(0, np.uint64)
    for words in _words(text):
        new = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        seen = np.concatenate([carried, new])
        for kind in _KINDS:
            reach = kind[-1]
            # features that lie within the words carried over were given before
            first = max(0, len(carried) - reach)
            n = len(seen) - reach - first
            if n <= 0:
                continue
            mixed = np.zeros(n, np.uint64)
            for place in kind:
                mixed ^= seen[first + place : first + place + n] * _PLACES[place]
                mixed ^= mixed >> np.uint64(29)
            mixed *= _PLACES[len(kind) - 1]
            yield ((mixed >> np.uint64(24)) % np.uint64(SLOTS)).astype(np.int64)
        carried = seen[-2:]


def features(text: bytes, hashes: _Hashes) -> np.ndarray:
    """Distinct slots of a lower-cased text, ascending."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *map(np.unique, _slots(text, hashes))]))


def _lowered(batch: pa.RecordBatch, at: int) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(batch.column(at), "")).cast(pa.binary())


class Learner:
    """Weights of the slots and of the bias, the last entry, from sums of gradients per coordinate."""

    def __init__(self):
        self.sums = np.zeros((2, SLOTS + 1))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.sums[0, at], self.sums[1, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - np.where(at == SLOTS, 0.0, L1), 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots: np.ndarray, toxic: int) -> None:
        at = np.append(slots, SLOTS)
        w = self.weights(at)
        gradient = probability(w.sum()) - toxic
        n = self.sums[1, at]
        rate = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.sums[0, at] += gradient - rate * w
        self.sums[1, at] = n + gradient * gradient


def probability(margin: float) -> float:
    return 1 / (1 + math.exp(-margin)) if margin >= 0 else 1 - 1 / (1 + math.exp(margin))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, fit_rows: int
) -> DataFrame:
    """Features of at most ``fit_rows`` labelled documents, stored: ``toxic, slots``."""
    key = F.col(id_column)
    known = labels.filter(key.isNotNull() & F.col(label_column).isNotNull() & ~held_out(key))
    known = known.groupBy(key.alias("id")).agg(F.max((F.col(label_column) > 0).cast("int")).alias("toxic"))
    rows = docs.select(key.alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # labels without a document take no place in the sample
    known = known.join(rows.select("id"), "id", "left_semi").withColumn("place", F.xxhash64("id"))
    chosen = stage(known.orderBy("place", "id").limit(fit_rows), "toxicity-sample")
    # at most fit_rows rows of two numbers; of rows with one id a single text is taken
    named = rows.join(F.broadcast(chosen), "id")
    single = named.groupBy("place", "id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            found, first, held = [], 0, 0
            for i, text in enumerate(_lowered(batch, 1)):
                found.append(features(text.as_py(), hashes).astype(np.int32))
                held += len(found[-1])
                if held < SLOTS and i + 1 < batch.num_rows:
                    continue
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                slots = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(found)), slots], ["toxic", "slots"])
                found, first, held = [], i + 1, 0

    described = single.select("toxic", "text").mapInArrow(describe, "toxic int, slots array<int>")
    return stage(described, "toxicity-features")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots with a weight, their weights, and the bias.

    The stored sample streams through one task, pass after pass, in the order of its files, which
    hashes dealt; ``fit_rows`` bounds it.
    Without usable labels there are no weights and the bias is 0.
    """
    sample = _sample(docs, labels, id_column, text_column, label_column, fit_rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner()
        for batch in batches:
            for toxic, slots in zip(batch.column(0).to_pylist(), batch.column(1)):
                learner.learn(slots.values.to_numpy(), toxic)
        weights = learner.weights(np.arange(SLOTS + 1))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["slot", "weight"])

    passes = functools.reduce(DataFrame.union, [sample] * EPOCHS).coalesce(1)
    # as many rows as slots have a weight
    found = passes.mapInArrow(learn, "slot long, weight double").toPandas()
    bias = found.loc[found["slot"] == SLOTS, "weight"].sum()
    found = found[found["slot"] < SLOTS]
    return found["slot"].to_numpy(), found["weight"].to_numpy(), float(bias)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Score every whole text for toxicity.

    A text's features are its distinct words, pairs and triples of words and pairs that skip a
    word, hashed to slots.  FTRL-proximal gives every slot its own rate, and its L1 penalty leaves
    few slots a weight; those are sent to all tasks, at most 2**20.  The model is learnt from at
    most ``fit_rows`` labelled documents outside the held-out fold, those of smallest id hash, and
    sees nothing but their texts.

    Returns ``id_column, held_out, score, predicted``, one row per input row.  Null and empty texts
    score by the bias alone; very long ones are read in slices.  A document with a null id is never
    learnt from and not held out; of rows that share an id one text is learnt from, and a document
    with several labels is toxic if one says so; null labels are none.  Without labels every score
    is 0.5.  An empty table gives no rows; other columns are left out, whatever their names.
    """
    used, weights, bias = fit(docs, labels, id_column, text_column, label_column, fit_rows)
    # bounded by SLOTS, and by the L1 penalty far smaller
    model = docs.sparkSession.sparkContext.broadcast((used, weights, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, bias = model.value
        table = np.zeros(SLOTS)
        table[used] = weights
        matters = table != 0
        hashes = _Hashes()
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(_lowered(batch, batch.num_columns - 1)):
                met = [slots[matters[slots]] for slots in _slots(text.as_py(), hashes)]
                once = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
                scores[i] = probability(bias + table[once].sum())
            columns = [*[batch.column(k) for k in range(batch.num_columns - 1)], pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "score"])

    key = F.col(id_column)
    rows = docs.select(key.alias("id"), held_out(key).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"id {kind}, held_out boolean, score double")
    return scored.select(
        F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= LEAST).cast("int").alias("predicted")
    )
