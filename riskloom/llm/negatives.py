"""Hard negatives of anchors, found through bounds from summaries of vector segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.prefix import partitions
from riskloom.operators.lookup import lookup
from riskloom.session import stage

#: Anchors are the rows whose id is divisible by this.
ANCHOR_STEP = 100
#: Positives of an anchor, and negatives of a positive.
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this many hundredths of the positive's, and not above it.
LEAST_PERCENT = 80
#: Components are counted in whole parts of this size.
PARTS = 256
#: Segments of a vector per level of its summary; a vector shorter than a level skips it.
LEVELS = (1, 4, 16)
#: Numbers in a block of anchors, and rows of a tile that is bounded and scored at once.
ANCHOR_NUMBERS = 1 << 18
TILE = 1024
#: Cells per task.
CELLS = 3
#: Above this share of a tile's pairs that passed a level, the tile is scored whole.
DENSE = 0.05
#: Doubles hold every whole number below this.
EXACT = float(1 << 53)
#: What rounding can add to a bound, relative to the product of the vectors' lengths.
SLACK = 1e-9

_FIELDS = "dim int, block int, cell int, is_row boolean, key long, vec_id long, label long, parts array<double>, summary array<double>, goals array<long>"
_FOUND = "anchor long, anchor_id long, goal int, key long, vec_id long, score long"


def segment_summary(x: np.ndarray) -> np.ndarray:
    """Per row, level and segment the scaled mean, then per row, level and segment the deviation.

    With a segment's values as its mean and the rest, ``<x, y>`` over it lies within ``m * mx * my``
    plus or minus ``dx * dy``, where d is the length of the rest; means are scaled by the root of m.
    """
    means, deviations = [], []
    for n in _levels(x.shape[1]):
        for part in np.array_split(x, n, axis=1):
            mean = part.mean(axis=1)
            means.append(mean * np.sqrt(part.shape[1]))
            deviations.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack([*means, *deviations], axis=1) if means else np.zeros((len(x), 0))


def _levels(dim: int) -> list[int]:
    return [n for n in LEVELS if n <= dim]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64, copy=False)


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the last column, the vector, by its whole parts and their summary."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            some = batch.filter(pa.array(dims == dim))
            parts = np.floor(_matrix(some.column("vector"), int(dim)) * PARTS)
            columns = [*some.columns[:-1], _lists(parts), _lists(segment_summary(parts))]
            yield pa.RecordBatch.from_arrays(columns, [*some.schema.names[:-1], "parts", "summary"])


class _Block:
    """A block of anchors and the best rows met for each of their goals.

    Without given scores an anchor has one goal, its nearest rows of the same label; with them it
    has a goal per positive, the best rows of other labels within the positive's range.
    """

    def __init__(self, table: pa.Table, negatives: bool, kept: int):
        dim = table["dim"][0].as_py()
        self.dim, self.negatives, self.kept = dim, negatives, kept
        self.key, self.ids, self.label = (table[c].to_numpy() for c in ("key", "vec_id", "label"))
        self.x = _matrix(table["parts"].combine_chunks(), dim)
        self.summary = _matrix(table["summary"].combine_chunks(), 2 * sum(_levels(dim)))
        self.length = np.sqrt((self.x * self.x).sum(axis=1))
        n = len(self.x)
        if negatives:
            goals = table["goals"].to_pylist()
            self.goals = max(map(len, goals))
            filled = [[*g, *[-1] * (self.goals - len(g))] for g in goals]  # nothing scores within a negative
            self.high = np.array(filled, dtype=np.int64).reshape(n, self.goals)
            hundreds, rest = np.divmod(self.high, 100)
            least = self.high - hundreds * (100 - LEAST_PERCENT) - rest * (100 - LEAST_PERCENT) // 100
            # the range of a score below 0 is empty
            low = np.where(least > self.high, np.iinfo(np.int64).max, least)
        else:
            self.goals = 1
            self.high = np.full((n, 1), np.iinfo(np.int64).max)
            low = np.full((n, 1), np.iinfo(np.int64).min)
        # rows below the worst of a goal's kept rows cannot matter; equal ones may
        self.floor = low
        self.most = np.abs(self.x).max(initial=0.0)
        self.best = np.zeros((0, 5), np.int64)  # anchor, goal, score, id, key

    def take(self, batch: pa.Table) -> None:
        x = _matrix(batch["parts"].combine_chunks(), self.dim)
        summary = _matrix(batch["summary"].combine_chunks(), 2 * sum(_levels(self.dim)))
        key, ids, label = (batch[c].to_numpy() for c in ("key", "vec_id", "label"))
        for start in range(0, len(x), TILE):
            at = slice(start, start + TILE)
            self._tile(x[at], summary[at], key[at], ids[at], label[at])

    def _tile(self, x, summary, key, ids, label) -> None:
        same = self.label[:, None] == label
        open_ = ~same if self.negatives else same & (self.key[:, None] != key)
        low = self.floor.min(axis=1).astype(np.float64)
        high = self.high.max(axis=1).astype(np.float64)
        length = np.sqrt((x * x).sum(axis=1))
        sparse = None
        first, levels = 0, _levels(self.dim)
        for n in levels:
            means, rest = slice(first, first + n), slice(sum(levels) + first, sum(levels) + first + n)
            first += n
            if sparse is None:
                middle = self.summary[:, means] @ summary[:, means].T
                spread = self.summary[:, rest] @ summary[:, rest].T
                spread += SLACK * np.outer(self.length, length) + 0.5
                open_ &= (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
                if np.count_nonzero(open_) <= DENSE * open_.size:
                    sparse = np.nonzero(open_)
            else:
                rows, columns = sparse
                middle = np.einsum("ij,ij->i", self.summary[rows, means], summary[columns, means])
                spread = np.einsum("ij,ij->i", self.summary[rows, rest], summary[columns, rest])
                spread += SLACK * self.length[rows] * length[columns] + 0.5
                left = (middle + spread >= low[rows]) & (middle - spread <= high[rows])
                sparse = rows[left], columns[left]
        whole = sparse is None
        rows, columns = np.nonzero(open_) if whole else sparse
        if not len(rows):
            return
        score = self._scores(x, whole, rows, columns)
        for goal in range(self.goals):
            left = (score >= self.floor[rows, goal]) & (score <= self.high[rows, goal])
            if not left.any():
                continue
            a, c = rows[left], columns[left]
            met = np.stack([a, np.full(len(a), goal), score[left], ids[c], key[c]], axis=1)
            self._keep(met, goal)

    def _keep(self, met: np.ndarray, goal: int) -> None:
        mine = self.best[:, 1] == goal
        both = np.concatenate([self.best[mine], met])
        both = both[np.lexsort((both[:, 4], both[:, 3], -both[:, 2], both[:, 0]))]
        starts = np.flatnonzero(np.r_[True, both[1:, 0] != both[:-1, 0]])
        sizes = np.diff(np.r_[starts, len(both)])
        place = np.arange(len(both)) - np.repeat(starts, sizes)
        kept = both[place < self.kept]
        last = both[place == self.kept - 1]
        self.floor[last[:, 0], goal] = last[:, 2]
        self.best = np.concatenate([self.best[~mine], kept])

    def _scores(self, x: np.ndarray, whole: bool, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Whole inner products of the pairs: by doubles where these are exact, else by whole numbers."""
        if self.most * np.abs(x).max(initial=0.0) * self.dim < EXACT:
            if whole:
                return (self.x @ x.T)[rows, columns].astype(np.int64)
            return np.einsum("ij,ij->i", self.x[rows], x[columns]).astype(np.int64)
        left, right = ([[int(v) for v in row] for row in m] for m in (self.x, x))
        return np.array([sum(p * q for p, q in zip(left[i], right[j])) for i, j in zip(rows, columns)], dtype=np.int64)

    def found(self) -> pa.RecordBatch:
        a, goal, score, ids, key = self.best.T
        columns = [pa.array(self.key[a]), pa.array(self.ids[a]), pa.array(goal.astype(np.int32)), pa.array(key), pa.array(ids), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "anchor_id", "goal", "key", "vec_id", "score"])


def _mined(batches: Iterator[pa.RecordBatch], negatives: bool, kept: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, anchors before the rows they meet: one block is held, rows stream by."""
    cell, anchors, block = None, [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        names = np.stack([table[c].to_numpy() for c in ("dim", "block", "cell")], axis=1)
        is_row = table["is_row"].to_numpy(zero_copy_only=False)
        marks = np.column_stack([names, is_row])
        cuts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1), True])
        for start, end in zip(cuts, cuts[1:]):
            part, here = table.slice(start, end - start), tuple(names[start])
            if here != cell:
                if block is not None:
                    yield block.found()
                cell, anchors, block = here, [], None
            if not is_row[start]:
                anchors.append(part)
                continue
            if block is None and anchors:
                block = _Block(pa.concat_tables(anchors), negatives, kept)
                anchors = []
            if block is not None:
                block.take(part)
    if block is not None:
        yield block.found()


def _met(rows: DataFrame, anchors: DataFrame, blocks: DataFrame, negatives: bool, kept: int) -> DataFrame:
    """The best ``kept`` rows per anchor and goal, over all cells of (anchor block, share of the rows).

    A cell's rows stream past its anchors, so it may hold any number of them, and there are about
    as many cells as tasks; rows are copied once per block of anchors.
    """
    parts = partitions(rows)
    cells = F.ceil(F.lit(CELLS * parts) / F.col("blocks")).cast("int")
    # a row per length of vectors, broadcast only if counted to be few; lengths without anchors go
    rows = lookup(rows, blocks, ["dim"], ["blocks"])
    anchors = lookup(anchors, blocks, ["dim"], ["blocks"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    sent = rows.select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64(F.col("key") + 1), cells).cast("int").alias("cell"),
        F.lit(True).alias("is_row"),
        *["key", "vec_id", "label", "parts", "summary"],
        F.lit(None).cast("array<long>").alias("goals"),
    ).union(
        anchors.select(
            "dim",
            "block",
            F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"),
            F.lit(False),
            *["key", "vec_id", "label", "parts", "summary", "goals"],
        )
    )
    order = ["dim", "block", "cell"]
    dealt = sent.repartition(parts, *order).sortWithinPartitions(*order, "is_row")
    found = dealt.mapInArrow(lambda batches: _mined(batches, negatives, kept), _FOUND)
    best = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= kept)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def hard_negatives(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """The hardest negatives of every anchor and positive, exactly.

    A component x counts as ``floor(256 * x)``, a score is the whole inner product, and higher
    scores come first, ties by smaller id.  Anchors are the rows whose id is divisible by
    ``ANCHOR_STEP``; an anchor's positives are its first ``POSITIVES`` other rows of the same label,
    and a positive's negatives the first ``NEGATIVES`` rows of other labels that score from
    ``LEAST_PERCENT`` hundredths of the positive's score up to it.

    Each vector is stored with means and deviations of its segments at several levels.  They bound
    a score from both sides; a pair goes on to finer segments, and at last to its exact score, only
    while its bounds meet the range asked for, whose lower end rises as rows are found.  First all
    anchors look for positives, then, with the scores known, for negatives.

    Rows with a null id, label or vector and those with a null or non-finite component take no
    part.  Vectors of different lengths are not compared; empty ones score 0.  Rows with a repeated
    id are rows of their own: each is an anchor if its id makes it one, and ranks among equals in
    stored order.  Scores of 2**63 and more fail.  An empty table gives no rows; other columns are
    left out, whatever their names.  Returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.
    """
    raw = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    usable = raw.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector")))
    keyed = usable.select(
        F.monotonically_increasing_id().alias("key"),
        "vec_id",
        "label",
        F.size("vector").alias("dim"),
        "vector",
    )
    schema = "key long, vec_id long, label long, dim int, parts array<double>, summary array<double>"
    rows = stage(keyed.mapInArrow(_summarise, schema), "negatives-vectors")
    anchors = rows.filter(F.col("vec_id") % ANCHOR_STEP == 0)
    blocks = anchors.groupBy("dim").agg(F.count("key").alias("n"))
    blocks = blocks.select("dim", F.ceil(F.col("n") * F.greatest("dim", F.lit(1)) / ANCHOR_NUMBERS).cast("int").alias("blocks"))
    blocks = stage(blocks, "negatives-blocks")
    positives = stage(
        _met(rows, anchors.withColumn("goals", F.lit(None).cast("array<long>")), blocks, False, POSITIVES),
        "negatives-positives",
    )
    goals = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score")))["score"].alias("goals"))
    asking = anchors.join(goals, anchors["key"] == goals["anchor"]).drop("anchor")
    negatives = _met(rows, asking, blocks, True, NEGATIVES)
    named = positives.select(
        "anchor", (F.col("rank") - 1).alias("goal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return negatives.join(named, ["anchor", "goal"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
