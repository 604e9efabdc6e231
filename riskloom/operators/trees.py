"""Second-order regression trees (Chen and Guestrin, 2016) grown level by level from histograms.

Rows stay where they are: each task sums gradients per node, feature and bin of its own rows, and
the driver takes the best split of each node from the sums, whose size the settings bound.  Sums
are whole numbers, so a tree is the same under any partitioning and after any retry.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, functions as F

NODE_SCHEMA = (
    "tree int, node int, depth int, feature int, threshold double, missing_left boolean, "
    "left int, right int, gain double, hessian double, value double"
)
LEAF = -1
#: Gradients and hessians are summed in whole parts of this size.
PARTS = 1 << 20
#: Most rows whose values set the bins' ends; below, all rows do.
BIN_ROWS = 100_000
#: Most tasks whose sums the driver adds up itself; those of more meet per feature before.
SUMS_AT_ONCE = 16
#: Bins of (features, rows), gradients and hessians of some rows.
Block = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class TreeSettings:
    depth: int = 8
    step: float = 0.05
    l2: float = 1.0
    min_gain: float = 0.1
    min_hessian: float = 5.0


# --- bins ------------------------------------------------------------------------------------


def bin_ends(df: DataFrame, features: Sequence[str], bins: int, rows: int = BIN_ROWS) -> list[np.ndarray]:
    """Upper ends of at most ``bins`` bins per feature, from quantiles of its values.

    A value is in the first bin whose end it does not pass.  Above ``rows`` rows the quantiles are
    those of the rows whose hash lies below a share, so they do not depend on the partitioning.
    """
    total = df.count()
    if total > rows:
        share = int(rows / total * (1 << 32))
        df = df.where(F.pmod(F.xxhash64(*features), F.lit(1 << 32)) < share)
    shares = np.array([*[i / bins for i in range(1, bins)], 1.0])

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(f).drop_null().to_numpy().astype(float) for f in features]
            columns = [pa.array(range(len(features)), pa.int32()), pa.array([x.tobytes() for x in values], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "part"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for feature, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                met.setdefault(feature, []).append(np.frombuffer(part.as_buffer(), float))
        found = [percentiles(np.concatenate(parts), shares).tobytes() for parts in met.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(met), pa.int32()), pa.array(found, pa.binary())], ["feature", "ends"])

    # a feature's values, at most ``rows`` or so, meet in one task
    tasks = min(len(features), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.select(*features).mapInArrow(known, "feature int, part binary").repartition(tasks, "feature")
    found = {r["feature"]: np.frombuffer(r["ends"]) for r in parts.mapInArrow(cut, "feature int, ends binary").collect()}
    ends = []
    for i in range(len(features)):
        values = np.unique(found[i] if len(found.get(i, ())) else [np.inf])
        values[-1] = np.inf  # rows outside the sample may lie above its largest value
        ends.append(values)
    return ends


def percentiles(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The values at the shares of their order, between two by their distance; of none, none."""
    if not len(values):
        return values
    values, at = np.sort(values), (len(values) - 1) * shares
    low, high = np.floor(at).astype(np.int64), np.ceil(at).astype(np.int64)
    one, two = values[low], values[high]
    with np.errstate(invalid="ignore"):
        return np.where(one == two, one, (high - at) * one + (at - low) * two)


def binned(batch: pa.RecordBatch, features: Sequence[str], ends: list[np.ndarray], missing: int) -> np.ndarray:
    """Bin of each feature and row; ``missing`` for nulls and NaN."""
    out = np.empty((len(features), batch.num_rows), np.int16)
    for i, (f, end) in enumerate(zip(features, ends)):
        values = batch.column(f).to_numpy(zero_copy_only=False).astype(float, copy=False)
        out[i] = np.where(np.isnan(values), missing, np.searchsorted(end, values, side="left"))
    return out


# --- one tree --------------------------------------------------------------------------------


class Tree:
    """A complete binary tree of a depth; the children of node i are 2i+1 and 2i+2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.full(size, LEAF, np.int32)
        self.bin = np.zeros(size, np.int16)
        self.missing_left = np.zeros(size, bool)
        self.gain = np.zeros(size)
        self.hessian = np.zeros(size)
        self.value = np.zeros(size)

    def route(
        self, bins: np.ndarray, missing: int, levels: int | None = None, slots: Sequence[int] | None = None
    ) -> np.ndarray:
        """The node each row reaches within so many levels, by the bins of (features, rows).

        ``slots`` are the features that ``bins`` holds, in order; without it, all.
        """
        feature, rows = np.maximum(self.feature, 0).astype(np.int64), bins.shape[1]
        if slots is not None:
            held = np.zeros(max(slots) + 1, np.int64)
            held[list(slots)] = np.arange(len(slots))
            feature = held[feature]
        nodes, inner = np.arange(len(feature)), self.feature != LEAF
        # right and left child of node i at 2i and 2i+1; a leaf stays
        child = np.stack([np.where(inner, 2 * nodes + 2, nodes), np.where(inner, 2 * nodes + 1, nodes)], 1).ravel()
        first, flat, at = feature * rows, bins.reshape(-1), np.arange(rows)
        unknown = bool(rows) and int(bins.max(initial=0)) >= missing
        node = np.zeros(rows, np.int64)
        for level in range(self.depth if levels is None else levels):
            if not inner[2**level - 1 : 2 ** (level + 1) - 1].any():
                break
            value = flat.take(first.take(node) + at)
            left = value <= self.bin.take(node)
            if unknown:
                left = np.where(value == missing, self.missing_left.take(node), left)
            node = child.take(2 * node + left)
        return node


@dataclass
class Gradients:
    """What a task needs to turn stored rows into gradients: the trees not yet in their margins."""

    trees: list[Tree]
    weight: float
    missing: int

    def margins(self, stored: np.ndarray, bins: np.ndarray) -> Iterator[np.ndarray]:
        """The margins after each of the trees."""
        for tree in self.trees:
            stored = stored + tree.value.take(tree.route(bins, self.missing))
            yield stored

    def margin(self, stored: np.ndarray, bins: np.ndarray) -> np.ndarray:
        for stored in self.margins(stored, bins):
            pass
        return stored

    def whole(self, margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and hessian of the weighted log-loss, in whole parts."""
        p = 1 / (1 + np.exp(-margin))
        w = np.where(label == 1, self.weight, 1.0) * PARTS
        return np.rint(w * (p - label)), np.rint(w * p * (1 - p))


def drawn(key: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Whether each row takes part in a round, by its key alone."""
    if share >= 1:
        return np.ones(len(key), bool)
    mixed = key.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + round_ * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed ^ (mixed >> np.uint64(31))) < np.uint64(int(share * (2**64 - 1)))


def _summed(
    blocks: Iterator[Block], tree: Tree, level: int, asked: Sequence[int], features: Sequence[int], missing: int
) -> np.ndarray | None:
    """Sums of a task's rows in the asked nodes of a level: feature, gradients and hessians, node and bin."""
    width, first = missing + 1, 2**level - 1
    place = np.full(2 * first + 1, -1, np.int64)
    place[list(asked)] = np.arange(len(asked)) * width
    sums = None
    for bins, g, h in blocks:
        if sums is None:
            sums = np.zeros((len(features), 2, len(asked) * width), np.int64)
        start, some = np.zeros(len(g), np.int64), None
        if level:
            start = place.take(tree.route(bins, missing, level, features))
            some = np.flatnonzero(start >= 0)
            start, g, h = start.take(some), g.take(some), h.take(some)
        for i in range(len(features)):
            slot = start + (bins[i] if some is None else bins[i].take(some))
            for k, x in enumerate((g, h)):  # sums of a block of whole numbers are exact in doubles
                sums[i, k] += np.bincount(slot, x, len(asked) * width).astype(np.int64)
    return sums


def _added(rows: RDD, summed: Callable[[Iterator[Block]], np.ndarray | None], features: int) -> np.ndarray | None:
    """The sums of all tasks; those of many tasks meet per feature, so the driver never gets more than a few."""

    def whole(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        sums = summed(blocks)
        return iter(() if sums is None else (sums,))

    parts = rows.mapPartitions(whole)
    if rows.getNumPartitions() <= SUMS_AT_ONCE:
        total = None
        for sums in parts.collect():
            total = sums if total is None else total + sums
        return total
    found = dict(parts.flatMap(enumerate).reduceByKey(np.add, features).collect())
    return np.stack([found[i] for i in range(features)]) if found else None


def _gains(g: np.ndarray, h: np.ndarray, settings: TreeSettings, missing_left: bool) -> tuple[np.ndarray, ...]:
    """Gain of each split of sums of (feature, bin), and the sums of its sides; unfit splits gain -inf."""
    total_g, total_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    left_g = np.cumsum(g[:, :-1], axis=1) + (g[:, -1:] if missing_left else 0)
    left_h = np.cumsum(h[:, :-1], axis=1) + (h[:, -1:] if missing_left else 0)
    right_g, right_h = total_g - left_g, total_h - left_h

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a / PARTS) ** 2 / (b / PARTS + settings.l2)

    gain = score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)
    fits = np.minimum(left_h, right_h) >= settings.min_hessian * PARTS
    return np.where(fits, gain, -np.inf), left_g, left_h, right_g, right_h


def best_splits(g: np.ndarray, h: np.ndarray, settings: TreeSettings) -> tuple | None:
    """The best split of a node's whole sums per (feature, bin), the last bin being the missing rows:
    ``feature, gain, bin, missing_left`` and the gradients and hessians of the left and the right.

    A split's gain is ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)``; it must reach ``min_gain``, and
    both sides' hessian ``min_hessian``.  Missing rows go to the side that gains more, to the left
    if it makes no difference; of equal splits the first feature's lowest bin is taken.
    """
    if g.shape[1] < 2:
        return None
    sides = {missing_left: _gains(g, h, settings, missing_left) for missing_left in (True, False)}
    tops = {k: v[0].max(axis=1) for k, v in sides.items()}
    feature = int(np.argmax(np.maximum(tops[True], tops[False])))
    missing_left = bool(tops[True][feature] >= tops[False][feature])
    gain, *sums = sides[missing_left]
    at = int(np.argmax(gain[feature]))
    if gain[feature, at] < settings.min_gain:
        return None
    return feature, float(gain[feature, at]), at, missing_left, *(int(x[feature, at]) for x in sums)


def best_split(g: np.ndarray, h: np.ndarray, settings: TreeSettings) -> tuple | None:
    """:func:`best_splits` of a single feature, without its number."""
    found = best_splits(g[None], h[None], settings)
    return found and found[1:]


def grow(rows: RDD, features: Sequence[int], missing: int, settings: TreeSettings) -> Tree:
    """One tree from blocks of the bins of ``features`` with their gradients: a job per level.

    A task holds ``2**depth * features * (bins + 1)`` pairs of sums at most, and so does the driver.
    Of two children only the one with the smaller hessian is summed; the other is what its parent
    leaves.  Nodes whose hessian cannot make two sides are leaves without being summed.
    """
    tree = Tree(settings.depth)
    width, sums = missing + 1, {}

    def leaf(g: int, h: int) -> float:
        return -settings.step * (g / PARTS) / (h / PARTS + settings.l2)

    asked, others = [0], {}  # nodes to sum, and by each its sibling if that is open
    for level in range(settings.depth):
        if not asked:
            break

        def summed(blocks: Iterator[Block], level: int = level, asked: list[int] = asked) -> np.ndarray | None:
            return _summed(blocks, tree, level, asked, features, missing)

        found = _added(rows, summed, len(features))
        if found is None:
            break
        found = found.reshape(len(features), 2, len(asked), width)
        parents, sums = sums, {n: found[:, :, i] for i, n in enumerate(asked)}
        sums |= {other: parents[(n - 1) // 2] - sums[n] for n, other in others.items()}
        if level == 0:
            g, h = (int(x) for x in sums[0][0].sum(axis=1))
            tree.value[0], tree.hessian[0] = leaf(g, h), h / PARTS
        asked, others = [], {}
        for node, both in sorted(sums.items()):
            best = best_splits(both[:, 0], both[:, 1], settings) if both[0].any() else None
            if best is None:
                continue
            at, tree.gain[node], tree.bin[node], tree.missing_left[node], *sides = best
            tree.feature[node] = features[at]
            children = sorted((2 * node + 1, 2 * node + 2), key=lambda n: sides[2 * (n % 2 == 0) + 1])
            for child in children:
                g, h = sides[2 * (child % 2 == 0) :][:2]
                tree.value[child], tree.hessian[child] = leaf(g, h), h / PARTS
            # the smaller is open only if the larger is
            if sides[2 * (children[1] % 2 == 0) + 1] >= 2 * settings.min_hessian * PARTS:
                asked.append(children[0])
                others[children[0]] = children[1]
    return tree


def node_rows(tree: Tree, number: int, ends: list[np.ndarray]) -> list[tuple]:
    """Rows of ``NODE_SCHEMA``; a split of all known values against the missing has threshold inf."""
    rows, waiting = [], [(0, 0)]
    while waiting:
        node, depth = waiting.pop()
        feature = int(tree.feature[node])
        common = (number, node, depth, feature)
        if feature == LEAF:
            rows.append((*common, None, None, LEAF, LEAF, None, float(tree.hessian[node]), float(tree.value[node])))
            continue
        threshold = float(ends[feature][tree.bin[node]])
        left, right = 2 * node + 1, 2 * node + 2
        inner = (threshold, bool(tree.missing_left[node]), left, right, float(tree.gain[node]))
        rows.append((*common, *inner, float(tree.hessian[node]), float(tree.value[node])))
        waiting += [(right, depth + 1), (left, depth + 1)]
    return rows


# --- scoring ---------------------------------------------------------------------------------


class PackedTrees:
    """The node table in flat arrays, walked for all rows of a batch at once."""

    def __init__(self, nodes: pd.DataFrame, trees: int):
        self.depth = int(nodes["depth"].max()) if len(nodes) else 0
        shape = (trees, 2 ** (self.depth + 1) - 1)
        self.feature = np.full(shape, LEAF, np.int32)
        self.threshold, self.value = np.zeros(shape), np.zeros(shape)
        self.missing_left = np.zeros(shape, bool)
        at = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        self.feature[at], self.value[at] = nodes["feature"], nodes["value"]
        self.threshold[at] = nodes["threshold"].fillna(0.0)
        self.missing_left[at] = nodes["missing_left"].eq(True)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Sums of the leaves' values; rows are (rows, features)."""
        columns, (count, _) = np.ascontiguousarray(rows.T), rows.shape
        total, at, flat = np.zeros(count), np.arange(count), columns.reshape(-1)
        missing = np.isnan(columns).reshape(-1)
        missing = missing if missing.any() else None
        nodes = np.arange(self.feature.shape[1])
        for feature, threshold, missing_left, value in zip(self.feature, self.threshold, self.missing_left, self.value):
            inner = feature != LEAF
            # right and left child of node i at 2i and 2i+1; a leaf stays
            child = np.stack([np.where(inner, 2 * nodes + 2, nodes), np.where(inner, 2 * nodes + 1, nodes)], 1).ravel()
            first, node = np.maximum(feature, 0).astype(np.int64) * count, np.zeros(count, np.int64)
            for level in range(self.depth):
                if not inner[2**level - 1 : 2 ** (level + 1) - 1].any():
                    break
                place = first.take(node) + at
                left = flat.take(place) <= threshold.take(node)
                if missing is not None:
                    left = np.where(missing.take(place), missing_left.take(node), left)
                node = child.take(2 * node + left)
            total += value.take(node)
        return total


def walk_by_joins(
    df: DataFrame,
    nodes: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    depth: int,
    value: Column,
    missing: float | None = None,
) -> DataFrame:
    """Sum over all trees of ``value`` at the leaf each row reaches: ``key, total``.

    A second way to score a node table, in joins only: a row stands once per tree at the root and
    moves one level down with each join.  ``nodes`` is bounded by the settings of the model it comes
    from, so it is broadcast.  ``missing`` replaces null features where a model has no direction
    for them.  ``key`` must name single rows; a null key names a row as well.

    The joined rows are as many as trees times rows, so what they evaluate is little: a leaf's children
    are itself, and where splits have a direction for missing values, a row's values stand there twice,
    with NaN, above any threshold, and with -inf, below, for those that are missing.
    """
    known = [F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features]
    directed = "missing_left" in nodes.columns and missing is None
    stands = (math.nan, -math.inf) if directed else (missing,)
    # before the rows are multiplied
    rows = df.select(*key, F.array(*[F.coalesce(x, F.lit(m)) for m in stands for x in known]).alias("_values"))
    numbers = F.lit([r["tree"] for r in nodes.where("node = 0").select("tree").orderBy("tree").collect()])
    state = rows.select(*key, "_values", F.explode(numbers).alias("tree"), F.lit(0).alias("node"))
    inner, place = F.col("feature") != LEAF, F.col("feature")
    if directed:
        place = place + F.when(F.col("missing_left"), len(features)).otherwise(0)
    # no null but in the keys: else the joins look for nulls in what they compute
    below = {f"_{side}": F.coalesce(F.when(inner, F.col(side)), F.col("node"), F.lit(0)) for side in ("left", "right")}
    at = {"_place": F.when(inner, place).otherwise(0), "_threshold": F.coalesce("threshold", F.lit(0.0))}
    table = nodes.select("tree", "node", *[x.alias(n) for n, x in {**at, **below}.items()])
    for _ in range(depth):
        here = state.join(F.broadcast(table), ["tree", "node"])
        goes_left = F.get("_values", F.col("_place")) <= F.col("_threshold")
        down = F.when(goes_left, F.col("_left")).otherwise(F.col("_right"))
        state = here.select(*key, "_values", "tree", down.alias("node"))
    leaves = state.join(F.broadcast(nodes.select("tree", "node", value.alias("_value"))), ["tree", "node"])
    return leaves.groupBy(*key).agg(F.sum("_value").alias("total"))
