"""Boosted trees with class weights, per-round curves and stopping on validation AUC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.operators.evaluation import roc_auc, score_curve
from riskloom.operators.quality import class_weight
from riskloom.operators.trees import (
    NODE_SCHEMA,
    Block,
    Gradients,
    PackedTrees,
    Tree,
    TreeSettings,
    bin_ends,
    binned,
    drawn,
    grow,
    node_rows,
    walk_by_joins,
)
from riskloom.session import stage

# Gaps of AUC between the splits that part the verdicts.
SLIGHT_GAP = 0.02
WIDE_GAP = 0.05


@dataclass(frozen=True)
class BoostSettings:
    """``key`` names single rows for the draw of each round; without it a row's values do.

    ``min_gain`` is the least gain of a split (gamma), ``min_weight`` the least hessian of a side.
    ``feature_share`` of the features is drawn per tree.
    """

    features: tuple[str, ...]
    label: str
    split: str = "split"
    train: str = "train"
    valid: str = "val"
    output: str = "fraud_probability"
    key: str | None = None
    # The training parameters, from here to ``bins``.
    max_rounds: int = 500
    patience: int = 30
    depth: int = 8
    step: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_weight: float = 5.0
    min_gain: float = 0.1
    l2: float = 1.0
    bins: int = 256
    seed: int = 42
    rounds: str = "last"


#: Rounds after which margins are stored anew and scored; until then tasks add the trees since.
STORE_EVERY = 4
#: Rows that are dealt to tasks together, and rows that a task works on at once.
DEALT_ROWS, BLOCK_ROWS = 1 << 13, 1 << 16
#: Most rows of a task, of a range of margins, and those that set the ranges.
TASK_ROWS, RANGE_ROWS, CUT_ROWS = 1 << 20, 1 << 19, 20_000
#: Stored rows: whether of the train split, keys, labels, bins of (features, rows), margins.
Stored = tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
CURVE_SCHEMA = "round int, train_auc double, val_auc double, train_loss double, val_loss double, objective double"


# --- curves ----------------------------------------------------------------------------------


def grouped_curve(df: DataFrame, label: str, margin: str, split: str, round_: str) -> DataFrame:
    """Rows ``(round, train_auc, val_auc, train_loss, val_loss)`` from margins per round.

    ``df`` holds a row per (row, round) with split 'train' or 'val'; a margin m stands for the
    probability ``1 / (1 + exp(-2m))``.  Log-loss and AUC read the same distinct-margin counts.
    """
    groups = [split, round_]
    curve = score_curve(df, label, margin, groups)
    probability = 1 / (1 + F.exp(-2 * F.col("threshold")))
    clipped = F.when(probability < 1e-15, 1e-15).when(probability > 1 - 1e-15, 1 - 1e-15)
    clipped = clipped.otherwise(probability)
    loss = -(F.col("pos") * F.ln(clipped) + F.col("neg") * F.ln(1 - clipped))
    losses = curve.groupBy(*groups).agg(
        (F.sum(loss) / F.sum(F.col("pos") + F.col("neg"))).alias("loss")
    )
    both = roc_auc(curve, groups).join(losses, groups)

    def at(part: str, name: str) -> Column:
        return F.max(F.when(F.col(split) == part, F.col(name)))

    return both.groupBy(F.col(round_).alias("round")).agg(
        at("train", "auc").alias("train_auc"),
        at("val", "auc").alias("val_auc"),
        at("train", "loss").alias("train_loss"),
        at("val", "loss").alias("val_loss"),
    )


def early_stop(curve: DataFrame, patience: int, metric: str = "val_auc") -> DataFrame:
    """One row ``(best_round, best_score, stop_round, stopped)``.

    Training stops at the first round that is ``patience`` rounds past the last strict
    improvement.  The curve has a row per round, so one window over it is small.
    """
    by_round = Window.orderBy("round")
    earlier = F.max(metric).over(by_round.rowsBetween(Window.unboundedPreceding, -1))
    improved = F.coalesce(F.col(metric) > earlier, F.lit(True))
    marked = curve.withColumn("_improved", F.when(improved, F.col("round")))
    upto = by_round.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_best", F.max("_improved").over(upto))
    marked = marked.withColumn("_over", F.col("round") - F.col("_best") >= patience)
    end = marked.agg(
        F.coalesce(F.min(F.when(F.col("_over"), F.col("round"))), F.max("round")).alias("r")
    ).scalar()
    used = marked.where(F.col("round") <= end)
    return used.agg(
        F.max("_best").alias("best_round"),
        F.max(F.when(F.col("_improved").isNotNull(), F.col(metric))).alias("best_score"),
        F.max("round").alias("stop_round"),
        F.max("_over").alias("stopped"),
    )


def overfit_gap(curve: DataFrame, stop: DataFrame) -> DataFrame:
    """Train minus validation AUC at the best round, and what it means."""
    best = stop.select("best_round").scalar()
    gap = F.col("train_auc") - F.col("val_auc")
    verdict = (
        F.when(gap < SLIGHT_GAP, "not overfitting")
        .when(gap < WIDE_GAP, "slight overfitting")
        .otherwise("overfitting")
    )
    return curve.where(F.col("round") == best).select(
        F.col("round").alias("best_round"), gap.alias("gap"), verdict.alias("verdict")
    )


# --- scores of rounds ------------------------------------------------------------------------


def _counted(margin: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct margins in order, with their positives and negatives."""
    order = np.argsort(margin, kind="stable")
    margin = margin[order]
    first = np.flatnonzero(np.r_[True, margin[1:] != margin[:-1]][: len(margin)])
    if not len(first):
        return margin, pos, neg
    return margin[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)


def _won(pos: np.ndarray, neg: np.ndarray, below: int) -> int:
    """Twice the pairs won, a tie counting one half, among rows in order with so many below."""
    before = np.cumsum(neg) - neg + below
    top = float(pos.sum()) * 2.0 * float(before[-1] + neg[-1] if len(neg) else 0)
    if top < 2.0**62:
        return int((pos * (2 * before + neg)).sum())
    return sum(int(p) * (2 * int(b) + int(n)) for p, b, n in zip(pos, before, neg))


def _tally(margin: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[int, int, int, float, float]:
    """Of distinct margins in order: positives, negatives, twice the pairs won, and their summed losses."""
    # -log p of the positives and of the negatives, without passing through p
    negative, positive = (float((n * np.logaddexp(0, s * margin)).sum()) for n, s in ((neg, 1), (pos, -1)))
    return int(pos.sum()), int(neg.sum()), _won(pos, neg, 0), negative, positive


def _cuts(rows: RDD, gradients: Gradients, ranges: dict[bool, int], total: int) -> dict[tuple[int, bool], np.ndarray]:
    """Margins that part each round's rows of a split into so many ranges of about the same size.

    They come from every so-manieth row of a block; a range's size hangs on them, no result does.
    """
    rounds = range(len(gradients.trees))
    if max(ranges.values()) == 1:
        return {(number, train): np.empty(0) for number in rounds for train in ranges}
    step = max(1, total // max(CUT_ROWS, 64 * max(ranges.values())))

    def some(stored: Iterator[Stored]) -> Iterator[tuple[bool, np.ndarray]]:
        for train, _, _, bins, margin in stored:
            yield train, np.stack(list(gradients.margins(margin[::step], np.ascontiguousarray(bins[:, ::step]))))

    found, out = rows.mapPartitions(some).collect(), {}
    for train, parts in ranges.items():
        met = [m for t, m in found if t == train]
        known = np.sort(np.concatenate(met, axis=1), axis=1) if met else np.empty((len(rounds), 0))
        at = [i * known.shape[1] // parts for i in range(1, parts)] if known.shape[1] else []
        out |= {(number, train): np.unique(known[number, at]) for number in rounds}
    return out


def round_scores(rows: RDD, gradients: Gradients, sizes: dict[bool, int]) -> list[dict[str, float]]:
    """AUC and log-loss of both splits after each of the trees, exactly, in one pass.

    ``sizes`` are the rows of the train and the validation split.  Distinct margins are dealt by
    ranges; a range counts the pairs won inside it, and the driver adds those between ranges from a
    row per range.
    """
    ranges = {train: max(1, -(-n // RANGE_ROWS)) for train, n in sizes.items()}
    cuts = _cuts(rows, gradients, ranges, sum(sizes.values()))
    starts = np.cumsum([0, *(len(c) + 1 for c in cuts.values())])
    first = {k: int(n) for k, n in zip(cuts, starts)}

    def dealt(stored: Iterator[Stored]) -> Iterator[tuple[int, tuple]]:
        for train, _, label, bins, margin in stored:
            for number, after in enumerate(gradients.margins(margin, bins)):
                counted = _counted(after, label.astype(np.int32), 1 - label.astype(np.int32))
                ends = [0, *np.searchsorted(counted[0], cuts[number, train], side="right"), len(counted[0])]
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if a < b:
                        yield first[number, train] + i, tuple(x[a:b] for x in counted)

    def tallied(parts: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
        met: dict[int, list[tuple]] = {}
        for key, counted in parts:
            met.setdefault(key, []).append(counted)
        for key, some in met.items():
            margin, pos, neg = (np.concatenate(x) for x in zip(*some))
            yield key, *_tally(*_counted(margin, pos.astype(np.int64), neg.astype(np.int64)))

    found = dict((r[0], r[1:]) for r in rows.mapPartitions(dealt).partitionBy(int(starts[-1]), int).mapPartitions(tallied).collect())
    out = []
    for number in range(len(gradients.trees)):
        line = {}
        for train, name in ((True, "train"), (False, "val")):
            pos = neg = won = 0
            loss = [0.0, 0.0]
            start = first[number, train]
            for r in (found[i] for i in range(start, start + len(cuts[number, train]) + 1) if i in found):
                won += r[2] + 2 * r[0] * neg
                pos, neg = pos + r[0], neg + r[1]
                loss = [loss[0] + r[3], loss[1] + r[4]]
            line[f"{name}_auc"] = won / (2 * pos * neg) if pos and neg else None
            line[f"{name}_loss"] = sum(loss) / (pos + neg) if pos + neg else None
            if train:
                total = neg + gradients.weight * pos
                line["objective"] = (loss[0] + gradients.weight * loss[1]) / total if total else None
        out.append(line)
    return out


# --- the estimator ---------------------------------------------------------------------------


class BoostedTrees(Estimator):
    """Fits on the rows of the train split and stops by AUC on the validation split.

    Every tree is grown once, on the gradients of the margins so far.  A row's margin is kept beside
    its bins, in blocks of rows that executors persist; rounds are scored some at a time, the last
    of them at the earliest round that can be the end, and the loop ends with the round that is
    ``patience`` rounds past the last improvement.  Rows and features are drawn per tree by hashes,
    sums are whole numbers, so the same rows give the same trees in any layout.
    Nulls and NaN are values of their own, with a direction learnt per split.  Rows of the two
    splits without a label take no part.
    """

    def __init__(self, settings: BoostSettings):
        super().__init__()
        self.settings = settings

    def _prepared(self, df: DataFrame) -> tuple[RDD, list[np.ndarray], float, dict[bool, int]]:
        """Blocks of stored rows at margin 0; the bins' ends; the positives' weight; rows per split."""
        s = self.settings
        parts = df.where(F.col(s.split).isin(s.train, s.valid) & F.col(s.label).isNotNull())
        values = [F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f"_x{i}") for i, f in enumerate(s.features)]
        names = [f"_x{i}" for i in range(len(values))]
        label = (F.col(s.label).cast("double") == 1).cast("int").alias("_label")
        train = (F.col(s.split) == s.train).alias("_train")
        key = F.xxhash64(s.key) if s.key else F.xxhash64(*s.features, s.label)
        data = stage(parts.select(key.alias("_key"), train, label, *values), "boost-values")
        fitted = data.where("_train")
        weight = class_weight(fitted, "_label").first()["value"]
        if not weight:
            raise ValueError("the train split needs rows of both classes")
        ends = bin_ends(fitted.select(*names), names, s.bins)
        sizes = {True: 0, False: 0} | {r["_train"]: r["count"] for r in data.groupBy("_train").count().collect()}
        missing, columns = s.bins, len(names)

        def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, DEALT_ROWS):
                    some = batch.slice(start, DEALT_ROWS)
                    bins, of_train = binned(some, names, ends, missing), some.column("_train").to_numpy(zero_copy_only=False)
                    key, label = some.column("_key").to_numpy(), some.column("_label").to_numpy().astype(np.int8)
                    for part in (True, False):
                        at = np.flatnonzero(of_train == part)
                        packed = (key[at], label[at], bins[:, at])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part]), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], _DEALT
                        )

        def to_stored(rows: Iterator) -> Iterator[Stored]:
            held: dict[bool, list[tuple]] = {True: [], False: []}

            def whole(part: bool) -> Stored:
                key, label, bins = (np.concatenate(x, axis=-1) for x in zip(*held.pop(part)))
                held[part] = []
                return part, key, label, bins, np.zeros(len(key))

            for r in rows:
                label = np.frombuffer(r["_label"], np.int8)
                bins = np.frombuffer(r["_bins"], np.int16).reshape(columns, -1)
                held[r["_train"]].append((np.frombuffer(r["_key"], np.int64), label, bins))
                if sum(len(x[0]) for x in held[r["_train"]]) >= BLOCK_ROWS:
                    yield whole(r["_train"])
            for part in [k for k, x in held.items() if x]:
                yield whole(part)

        rows = sum(sizes.values())
        cores = df.sparkSession.sparkContext.defaultParallelism
        tasks = max(-(-rows // TASK_ROWS), min(cores, -(-rows // DEALT_ROWS)))
        packed = data.mapInArrow(to_bins, _DEALT_SCHEMA).where("length(_key) > 0").repartition(tasks)
        return packed.rdd.mapPartitions(to_stored), ends, weight, sizes

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        s = self.settings
        data, ends, weight, sizes = self._prepared(df)
        shape = TreeSettings(s.depth, s.step, s.l2, s.min_gain, s.min_weight)
        drawn_features = max(1, int(s.feature_share * len(s.features)))
        since, nodes, curve, kept = [], [], [], [data.persist(StorageLevel.MEMORY_AND_DISK)]
        best_round, best_score = 0, None
        try:
            for number in range(s.max_rounds):
                rng = np.random.default_rng([s.seed, number])
                features = sorted(int(i) for i in rng.choice(len(s.features), drawn_features, replace=False))
                before = Gradients(since, weight, s.bins)
                tree = _grown(kept[-1], before, features, (number, s.seed, s.row_share), shape)
                since = [*since, tree]
                nodes += node_rows(tree, number, ends)
                # scored only where the rounds since could be the last ones or are many
                if number + 1 < s.max_rounds and number - best_round < s.patience and len(since) < STORE_EVERY:
                    continue
                after = Gradients(since, weight, s.bins)
                for scores in round_scores(kept[-1], after, sizes):
                    curve.append({"round": len(curve), **scores})
                    # a missing score, as of a validation split without one of the classes, never improves
                    if best_score is None or (scores["val_auc"] or 0.0) > best_score:
                        best_round, best_score = len(curve) - 1, scores["val_auc"] or 0.0
                if number - best_round >= s.patience:
                    break
                kept, since = [*kept, _with_margins(kept[-1], after).persist(StorageLevel.MEMORY_AND_DISK)], []
                # the last but one has been read for the last, which is there by now
                for rows in kept[:-2]:
                    rows.unpersist()
                kept = kept[-2:]
        finally:
            for rows in kept:
                rows.unpersist()
        rounds = len(curve) if s.rounds == "last" else best_round + 1
        spark = df.sparkSession
        # a row per round and per node: both bounded by the settings
        names = [f.split()[0] for f in CURVE_SCHEMA.split(", ")]
        rows = spark.createDataFrame([tuple(r[n] for n in names) for r in curve], CURVE_SCHEMA)
        table = spark.createDataFrame([n for n in nodes if n[0] < rounds], NODE_SCHEMA)
        return BoostedTreesModel(s, stage(table, "boost-nodes"), weight, rounds, best_round, stage(rows, "curve"))


_DEALT = ["_train", "_key", "_label", "_bins"]
_DEALT_SCHEMA = "_train boolean, _key binary, _label binary, _bins binary"


def _grown(
    rows: RDD, gradients: Gradients, features: Sequence[int], draw: tuple[int, int, float], shape: TreeSettings
) -> Tree:
    """The next tree; what its levels read, the drawn rows and features, is kept meanwhile."""

    def taken(stored: Iterator[Stored]) -> Iterator[Block]:
        for train, key, label, bins, margin in stored:
            some = np.flatnonzero(drawn(key, *draw)) if train else ()
            if len(some):
                label, bins = label[some], np.ascontiguousarray(bins[:, some])
                g, h = gradients.whole(gradients.margin(margin[some], bins), label)
                yield bins[list(features)], g, h

    blocks = rows.mapPartitions(taken).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return grow(blocks, features, gradients.missing, shape)
    finally:
        blocks.unpersist()


def _with_margins(rows: RDD, gradients: Gradients) -> RDD:
    """The stored rows with the trees since added to their margins."""

    def add(stored: Iterator[Stored]) -> Iterator[Stored]:
        for *about, bins, margin in stored:
            yield *about, bins, gradients.margin(margin, bins)

    return rows.mapPartitions(add)


class BoostedTreesModel(Model):
    """Scores rows by the node table; a null or NaN feature goes where its split sends them."""

    def __init__(
        self,
        settings: BoostSettings,
        nodes: DataFrame,
        weight: float,
        rounds: int,
        best_round: int,
        curve: DataFrame | None,
    ):
        super().__init__()
        self.settings = settings
        self.nodes = nodes
        self.weight = weight
        self.rounds = rounds
        self.best_round = best_round
        self.curve = curve
        self._packed = None

    def packed(self):
        """The trees as a broadcast; their node count is bounded by the settings."""
        if self._packed is None:
            trees = PackedTrees(self.nodes.toPandas(), self.rounds)
            self._packed = self.nodes.sparkSession.sparkContext.broadcast(trees)
        return self._packed

    def margin(self) -> Column:
        trees = self.packed()

        @F.pandas_udf("double")
        def walked(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(trees.value.margin(rows.to_numpy(dtype=float)))

        return walked(F.struct(*[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.settings.features)]))

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != self.settings.output]
        probability = 1 / (1 + F.exp(-self.margin()))
        return df.select(*kept, probability.alias(self.settings.output))

    def transform_by_joins(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """``key`` and the probability by walking the node table in joins, level by level."""
        walked = walk_by_joins(df, self.nodes, key, self.settings.features, self.settings.depth, F.col("value"))
        return walked.select(*key, (1 / (1 + F.exp(-F.col("total")))).alias(self.settings.output))

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        about = {**asdict(self.settings), "features": list(self.settings.features)}
        about = {k: v for k, v in about.items() if v is not None}
        about |= {
            "weight": self.weight,
            "rounds_used": self.rounds,
            "best_round": self.best_round,
            "has_curve": self.curve is not None,
        }
        spark.createDataFrame([about]).coalesce(1).write.mode("overwrite").json(f"{path}/about")
        if self.curve is not None:
            self.curve.write.mode("overwrite").parquet(f"{path}/curve")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTreesModel:
        about = spark.read.json(f"{path}/about").first().asDict()
        weight, rounds, best = (about.pop(k) for k in ("weight", "rounds_used", "best_round"))
        # a model without a curve is stored without one
        curve = spark.read.schema(CURVE_SCHEMA).parquet(f"{path}/curve") if about.pop("has_curve") else None
        settings = BoostSettings(**{**about, "features": tuple(about["features"])})
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
        return BoostedTreesModel(settings, nodes, weight, rounds, best, curve)
