"""A quality classifier from weak labels: labelling rules, their accuracies, a hashed scorer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import TEXT_BYTES, stage

#: Buckets of the hashed features.
BUCKETS = 384
#: Most documents the scorer is fitted on, those of smallest id hash; everything else is over all.
FIT_ROWS = 20_000
#: Tasks that share the sample in the fit, steps of the fit at most, and its ridge per text.
FIT_PARTS = 8
NEWTON = 12
RIDGE = 1e-4
#: Weight of the prior on the rules' votes, as a share of all texts.
PRIOR = 0.05
#: Rounds of expectation-maximisation.
ROUNDS = 100
#: A text is rejected when the scorer gives its being good less than this.
LEAST = 0.5
#: Ends of the steps into which a statistic is cut for its hashed feature.
STEPS = (0.0, 0.005, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)

#: What may stand around a plain word.
PUNCTUATION = ".,;:!?'\"()[]-"

_SYMBOLS = re.compile(r"[#*$%&|<>{}~^=_\\]")
_LETTERS = re.compile(r"[^\W\d_]")
_DIGITS = re.compile(r"\d+")
_LOWER = re.compile(r"[a-zß-öø-ÿ]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


@dataclass
class Statistics:
    words: int
    symbols: float
    uppercase: float
    repeated: float
    distinct: float
    dup_lines: float
    exclaimed: float
    length: float
    ended: float
    plain: float
    lettered: float
    shouted: float
    commonest: float


def statistics(text: str, words: list[str]) -> Statistics:
    """Shares over the whole text that the labelling rules and features read."""
    n = max(len(words), 1)
    letters = max(len(_LETTERS.findall(text)), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    upper = sum(map(len, _UPPER.findall(text)))
    return Statistics(
        words=len(words),
        symbols=len(_SYMBOLS.findall(text)) / max(len(text), 1),
        uppercase=upper / letters,
        repeated=again / n,
        distinct=len(set(words)) / n,
        dup_lines=1 - len(set(lines)) / max(len(lines), 1),
        exclaimed=(text.count("!") + text.count("?")) / n,
        length=sum(map(len, words)) / n,
        ended=sum(map(text.count, (". ", ".\n", "! ", "? "))) / n,
        plain=sum(w.strip(PUNCTUATION).isalpha() for w in words) / n,
        lettered=(letters + sum(map(text.count, " \n.,"))) / max(len(text), 1),
        shouted=sum(len(w) > 2 and w.isupper() for w in words) / n,
        commonest=max(Counter(words).values(), default=0) / n,
    )


def votes(s: Statistics) -> list[int]:
    """One vote per labelling rule: 1 good, 0 bad, -1 none.  The rules overlap on purpose."""

    def rule(bad: bool, good: bool) -> int:
        return 0 if bad else 1 if good else -1

    return [
        rule(s.symbols > 0.05, s.symbols < 0.01),
        rule(s.uppercase > 0.4, s.uppercase < 0.15),
        rule(s.repeated > 0.3, s.repeated < 0.1),
        rule(s.words > 30 and s.distinct < 0.25 * min(1, 400 / s.words), s.distinct > 0.4),
        rule(s.dup_lines > 0.4, s.dup_lines < 0.2),
        rule(s.exclaimed > 0.4, s.exclaimed < 0.15),
        rule(s.length > 14 or s.length < 2, 3 <= s.length <= 10),
        rule(s.words > 60 and s.ended < 0.005, s.ended > 0.02),
        rule(s.plain < 0.6, s.plain > 0.85),
        rule(s.lettered < 0.8, s.lettered > 0.9),
        rule(s.shouted > 0.3, s.shouted < 0.1),
        rule(s.words > 30 and s.commonest > 0.3, s.words > 30 and s.commonest < 0.15),
    ]


RULES = 12


def features(text: str, words: list[str], s: Statistics) -> np.ndarray:
    """Hashed bag of word shapes and stepped statistics, of unit length per kind.

    A shape keeps a word's classes of characters, not its letters, so the scorer reads how a text
    is written.  Signs from the hash keep colliding features apart on average.
    """
    shaped = _DIGITS.sub("9", _UPPER.sub("A", _LOWER.sub("a", text)))
    counts: dict[str, int] = {}
    for w in shaped.split():
        counts[w] = counts.get(w, 0) + 1
    if s.repeated:
        counts["<again>"] = round(s.repeated * len(words))
    out = np.zeros(BUCKETS)
    total = sum(counts.values())
    for shape, n in counts.items():
        h = xxhash.xxh3_64_intdigest(shape)
        out[h % BUCKETS] += n / total if h >> 63 else -n / total
    steps = [s.symbols, s.uppercase, s.repeated, s.distinct, s.dup_lines, min(s.exclaimed, 1.0)]
    for i, x in enumerate(steps):
        at = int(np.searchsorted(STEPS, x, side="right"))
        h = xxhash.xxh3_64_intdigest(f"<{i}:{at}>")
        out[h % BUCKETS] += 1.0 if h >> 63 else -1.0
    return out


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document its votes, as one short string, and its sparse features; stored."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, blank, at, values = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                words = text.split()
                blank.append(not words)
                found = statistics(text, words)
                patterns.append("".join("-01"[v + 1] for v in votes(found)))
                dense = features(text, words, found)
                there = np.flatnonzero(dense)
                at.append(there.astype(np.int32))
                values.append(dense[there])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(patterns, pa.string()),
                    pa.array(blank, pa.bool_()),
                    pa.array(at, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                ["_row", "pattern", "blank", "at", "value"],
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("_row"), F.col(text_column).cast("string").alias("_text")
    )
    return stage(
        rows.mapInArrow(
            describe, "_row long, pattern string, blank boolean, at array<int>, value array<double>"
        ),
        "weak-features",
        TEXT_BYTES,
    )


@dataclass
class LabelModel:
    """Share of good texts and, per rule, how its votes fall on good and on bad texts."""

    good: float
    given: np.ndarray  # rule, class (bad, good), vote (none, bad, good)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that texts with these votes are good, the rules being independent."""
        log = np.log([1 - self.good, self.good])[None, :].repeat(len(patterns), 0)
        for rule in range(patterns.shape[1]):
            log += np.log(self.given[rule][:, patterns[:, rule] + 1]).T
        top = log - log.max(axis=1, keepdims=True)
        return np.exp(top[:, 1]) / np.exp(top).sum(axis=1)

    def posterior_column(self, pattern: Column) -> Column:
        """The same from a column of votes written as ``-01``: log odds of three votes per rule."""
        odds = np.log(self.given[:, 1] / self.given[:, 0])
        margin = F.lit(float(np.log(self.good / (1 - self.good))))
        for rule, (none, bad, good) in enumerate(odds.tolist()):
            vote = F.substring(pattern, rule + 1, 1)
            margin = margin + F.when(vote == "1", good).when(vote == "0", bad).otherwise(none)
        return 1 / (1 + F.exp(-margin))


def fit_labels(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation-maximisation over the distinct vote patterns and how many texts have each.

    It starts from the number of bad votes: texts with none are likely good, with two or more bad.
    A prior of ``PRIOR`` of all texts holds that a rule's bad votes seldom fall on good texts, and
    that a bad text gets any vote from a rule that looks for another fault; without it the classes
    could drift to whatever splits the votes best.
    """
    bad = (patterns == 0).sum(axis=1)
    p = np.where(bad == 0, 0.95, np.where(bad == 1, 0.5, 0.05))
    prior = PRIOR * max(counts.sum(), 1) * np.array([[0.3, 0.3, 0.4], [0.18, 0.01, 0.81]])
    model = None
    for _ in range(ROUNDS):
        weight = np.stack([(1 - p) * counts, p * counts])
        given = np.repeat(prior[None], patterns.shape[1], axis=0)
        for rule in range(patterns.shape[1]):
            for vote in (-1, 0, 1):
                given[rule, :, vote + 1] += weight[:, patterns[:, rule] == vote].sum(axis=1)
        given /= given.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        model = LabelModel(float(share), given)
        p = model.posterior(patterns)
    return model


def fit_scorer(labelled: DataFrame, fit_rows: int) -> tuple[list[float], float]:
    """Weights and intercept of a ridge logistic regression to the posteriors of a bounded sample.

    Newton's method: each step sums gradient and curvature (the square of ``BUCKETS`` numbers) per
    task and solves for the next weights.
    """
    texts = labelled.filter("not blank")
    sample = texts.orderBy(F.xxhash64("_row"), "pattern").limit(fit_rows)
    sample = stage(sample.select("at", "value", "weak_label").repartition(FIT_PARTS), "weak-sample")
    size = BUCKETS + 1
    weights = np.zeros(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, curvature, n = np.zeros(size), np.zeros((size, size)), 0
        for batch in batches:
            at, value, label = batch.columns
            rows = np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy()))
            x = np.zeros((batch.num_rows, size))
            x[rows, at.flatten().to_numpy()] = value.flatten().to_numpy()
            x[:, -1] = 1
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient += x.T @ (p - label.to_numpy())
            curvature += (x * (p * (1 - p))[:, None]).T @ x
            n += batch.num_rows
        yield pa.RecordBatch.from_pydict(
            {"n": [n], "gradient": [gradient], "curvature": [curvature.ravel()]}
        )

    for _ in range(NEWTON):
        parts = sample.mapInArrow(sums, "n long, gradient array<double>, curvature array<double>")
        parts = parts.toArrow()
        n = sum(parts.column("n").to_pylist())
        if not n:
            break
        gradient = np.sum([x.values.to_numpy() for x in parts.column("gradient")], axis=0)
        curvature = np.sum([x.values.to_numpy() for x in parts.column("curvature")], axis=0)
        ridge = np.full(size, RIDGE * n)
        ridge[-1] = 1e-9 * n
        step = np.linalg.solve(curvature.reshape(size, size) + np.diag(ridge + 1e-9), gradient + ridge * weights)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return [float(x) for x in weights[:-1]], float(weights[-1])


def classify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Score every document with a linear model taught by weak labels.

    Rules vote on each whole text.  The table of distinct vote patterns (at most three to the
    number of rules) counts all documents, and expectation-maximisation over it estimates each
    rule's accuracy and each pattern's posterior.  A logistic regression over hashed features is
    fitted to these posteriors on at most ``fit_rows`` documents, those with the smallest hash of
    their id, and scores all.

    Returns ``id_column, weak_label, score, kept``: the posterior that the votes give, the scorer's
    probability of being good, and whether it is ``LEAST`` or more; one row per input row, repeated
    rows included.  Texts without a word (null, empty, blank) score 0 and go.  Null ids are scored
    like others.  An empty table gives no rows; where all posteriors agree the scorer is constant.
    Other columns are left out.
    """
    found = described(docs, id_column, text_column)
    counted = found.groupBy("pattern").count().orderBy("pattern").collect()
    names = [r[0] for r in counted]
    if not names:  # an empty table: any model gives its no rows
        names, counted = ["-" * RULES], [("-" * RULES, 0)]
    patterns = np.array([["-01".index(c) - 1 for c in name] for name in names])
    model = fit_labels(patterns, np.array([r[1] for r in counted], float))
    labelled = found.withColumn("weak_label", model.posterior_column(F.col("pattern")))
    weights, intercept = fit_scorer(labelled, fit_rows)
    table = F.lit(weights)
    margin = F.aggregate(
        F.zip_with("at", "value", lambda i, v: F.get(table, i) * v), F.lit(intercept), lambda a, b: a + b
    )
    score = F.when(F.col("blank"), 0.0).otherwise(1 / (1 + F.exp(-margin)))
    return labelled.select(
        F.col("_row").alias(id_column), "weak_label", score.alias("score"), (score >= LEAST).alias("kept")
    )
