"""Isolation forest (Liu, Ting and Zhou, 2008) as an estimator.

Spark draws the sample and deals its rows to the trees; each tree grows in its own task from at
most ``tree_rows`` rows.  The grown forest is bounded by ``trees * 2 * tree_rows`` nodes, so
scoring broadcasts it and walks all rows of an Arrow batch at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.operators.ordering import exact_quantiles, sample_n
from riskloom.operators.trees import walk_by_joins
from riskloom.session import stage

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size bigint, depth int"
)
LEAF = -1
BATCH = 8192
ADMIT_PARTS = 1_000_000


@dataclass(frozen=True)
class ForestSettings:
    features: tuple[str, ...]
    key: str
    output: str = "if_anomaly_score"
    trees: int = 100
    sample_rows: int = 100_000
    tree_rows: int = 256
    contamination: float = 0.01
    seed: int = 42


def mean_search_depth(n: np.ndarray | int) -> np.ndarray:
    """Average depth of an unsuccessful search in a binary tree of n rows: c(n)."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _filled(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]


def _grow(rows: np.ndarray, depth_limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes of one tree; the children of node i are 2i+1 and 2i+2."""
    nodes, waiting = [], [(0, 0, rows)]
    while waiting:
        node, depth, part = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth == depth_limit or len(varying) == 0:
            nodes.append((node, LEAF, None, LEAF, LEAF, len(part), depth))
            continue
        feature = int(rng.choice(varying))
        threshold = rng.uniform(low[feature], high[feature])
        if threshold >= high[feature]:
            threshold = low[feature]
        goes_left = part[:, feature] <= threshold
        left, right = 2 * node + 1, 2 * node + 2
        nodes.append((node, feature, float(threshold), left, right, len(part), depth))
        waiting += [(left, depth + 1, part[goes_left]), (right, depth + 1, part[~goes_left])]
    return nodes


def _tree_builder(features: Sequence[str], depth_limit: int, seed: int):
    features = list(features)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        values = rows.sort_values("place")[features].to_numpy(dtype=float)
        grown = _grow(values, depth_limit, np.random.default_rng([seed, tree]))
        names = ["node", "feature", "threshold", "left", "right", "size", "depth"]
        table = pd.DataFrame(grown, columns=names)
        table.insert(0, "tree", tree)
        return table

    return build


class PackedForest:
    """All trees as complete binary trees of equal depth, in flat arrays.

    A leaf above the bottom sends every row left until the bottom, so a walk takes the same
    number of steps in every tree and needs no child pointers.
    """

    def __init__(self, nodes: pd.DataFrame, trees: int, depth: int):
        inner = 2**depth - 1
        self.depth = depth
        self.feature = np.zeros((trees, max(inner, 1)), dtype=np.int64)
        self.threshold = np.full((trees, max(inner, 1)), np.inf)
        self.length = np.zeros((trees, inner + 1))
        for row in nodes.itertuples():
            if row.feature != LEAF:
                self.feature[row.tree, row.node] = row.feature
                self.threshold[row.tree, row.node] = row.threshold
            else:
                bottom = row.node
                for _ in range(depth - row.depth):
                    bottom = 2 * bottom + 1
                length = row.depth + float(mean_search_depth(row.size))
                self.length[row.tree, bottom - inner] = length

    def mean_length(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for start in range(0, len(rows), BATCH):
            part = np.ascontiguousarray(rows[start : start + BATCH].T)
            n = part.shape[1]
            flat, at = part.ravel(), np.arange(n)
            total = np.zeros(n)
            for feature, threshold, length in zip(self.feature, self.threshold, self.length):
                node = np.zeros(n, dtype=np.int64)
                for _ in range(self.depth):
                    right = flat[feature[node] * n + at] > threshold[node]
                    node = 2 * node + 1 + right
                total += length[node - (2**self.depth - 1)]
            out[start : start + n] = total / len(self.feature)
        return out


class IsolationForest(Estimator):
    def __init__(self, settings: ForestSettings):
        super().__init__()
        self.settings = settings

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        s = self.settings
        sample = sample_n(df.select(s.key, *_filled(s.features)), s.key, s.sample_rows, s.seed)
        sample = stage(sample, "forest-sample")
        rows = sample.count()
        if rows == 0:
            raise ValueError("no rows to fit a forest on")
        tree_rows = min(s.tree_rows, rows)
        depth = max(1, math.ceil(math.log2(max(tree_rows, 2))))
        place = F.xxhash64(F.col(s.key), F.col("tree"), F.lit(s.seed))
        dealt = sample.repartition(s.key).withColumn(
            "tree", F.explode(F.sequence(F.lit(0), F.lit(s.trees - 1)))
        )
        dealt = dealt.withColumn("place", place)
        if rows > 2 * tree_rows:
            # let about twice the needed rows through before ranking
            admitted = math.ceil(ADMIT_PARTS * 2 * tree_rows / rows)
            dealt = dealt.where(F.pmod(F.col("place"), F.lit(ADMIT_PARTS)) < admitted)
        # few rows but much work per tree: an explicit partition count is not coalesced
        workers = min(s.trees, 2 * df.sparkSession.sparkContext.defaultParallelism)
        dealt = dealt.repartition(workers, "tree")
        order = Window.partitionBy("tree").orderBy("place", s.key)
        dealt = dealt.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= tree_rows)
        builder = _tree_builder(s.features, depth, s.seed)
        nodes = stage(
            dealt.select("tree", "place", *s.features).groupBy("tree").applyInPandas(builder, NODE_SCHEMA),
            "forest",
        )
        model = IsolationForestModel(s, nodes, tree_rows, depth, offset=0.0)
        scored = model.transform(sample)
        cut = exact_quantiles(scored, {s.output: [s.contamination]})
        model.offset = cut[s.output][0]
        return model


class IsolationForestModel(Model):
    """Scores rows; negative means abnormal, lower means more so."""

    def __init__(
        self, settings: ForestSettings, nodes: DataFrame, tree_rows: int, depth: int, offset: float
    ):
        super().__init__()
        self.settings = settings
        self.nodes = nodes
        self.tree_rows = tree_rows
        self.depth = depth
        self.offset = offset
        self._packed = None

    def packed(self):
        """The forest as a broadcast; its node count is bounded by the settings."""
        if self._packed is None:
            forest = PackedForest(self.nodes.toPandas(), self.settings.trees, self.depth)
            self._packed = self.nodes.sparkSession.sparkContext.broadcast(forest)
        return self._packed

    def score(self) -> Column:
        forest, full = self.packed(), float(mean_search_depth(self.tree_rows))

        @F.pandas_udf("double")
        def raw(rows: pd.DataFrame) -> pd.Series:
            length = forest.value.mean_length(rows.to_numpy(dtype=float))
            return pd.Series(-np.exp2(-length / full) if full > 0 else np.full(len(rows), -0.5))

        return raw(F.struct(*_filled(self.settings.features))) - F.lit(self.offset)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.settings.output, self.score())

    def transform_by_joins(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """``key`` and the score by walking the node table in joins, level by level."""
        n = F.col("size")
        search = 2 * (F.ln(n - 1) + float(np.euler_gamma)) - 2 * (n - 1) / n
        length = F.col("depth") + F.when(n > 2, search).when(n == 2, 1.0).otherwise(0.0)
        value = F.when(F.col("feature") == LEAF, length)
        walked = walk_by_joins(df, self.nodes, key, self.settings.features, self.depth, value, missing=0.0)
        full = float(mean_search_depth(self.tree_rows))
        mean = F.col("total") / self.settings.trees
        raw = -F.pow(F.lit(2.0), -mean / full) if full > 0 else F.lit(-0.5)
        return walked.select(*key, (raw - F.lit(self.offset)).alias(self.settings.output))

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        about = {**asdict(self.settings), "features": list(self.settings.features)}
        about |= {"tree_rows_used": self.tree_rows, "depth": self.depth, "offset": self.offset}
        spark.createDataFrame([about]).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForestModel:
        about = spark.read.json(f"{path}/about").first().asDict()
        tree_rows, depth, offset = (about.pop(k) for k in ("tree_rows_used", "depth", "offset"))
        settings = ForestSettings(**{**about, "features": tuple(about["features"])})
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
        return IsolationForestModel(settings, nodes, tree_rows, depth, offset)
