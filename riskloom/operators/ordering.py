"""Order-dependent operators without a single-task sort: positions, splits, quantiles, prefix sums."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.session import stage

DIRECT_ROWS = 5_000
MOST_BINS = 32_768
FEW_RANGES = 8
PIVOTS = 32
ROW_BITS = 33
#: Size of the quantile sketches, tasks' groups in which they first meet, and most values to read.
SKETCH_K = 16_384
SKETCH_GROUPS = 64
SKETCH_VALUES = 200_000


# --- positions -------------------------------------------------------------------------------


def _ranges(df: DataFrame, *in_order: Column | str) -> DataFrame:
    """Rows in as many ranges of the order as the session has shuffle partitions, numbered.

    The count is the cluster's setting, not the data's, so the keys that Spark samples stay some
    dozens per bound however large the table is.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *in_order).sortWithinPartitions(*in_order)
    return dealt.withColumn("_part", F.spark_partition_id())


def global_position(df: DataFrame, order_by: Sequence[str], out: str = "pos") -> DataFrame:
    """Dense 0-based position in the order of ``order_by``, unique together, nulls last.

    Rows are range partitioned (a composite unique key splits evenly however many rows share
    its first part), sorted within partitions and written once; the position is the row's index
    in its partition plus the row counts of the partitions before it.
    """
    in_order = [F.col(c).asc_nulls_last() for c in order_by]
    local = F.monotonically_increasing_id()
    index = local.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    ordered = stage(_ranges(df, *in_order).withColumn("_index", index), "ordered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    starts = ordered.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        ordered.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_index"))
        .drop("_part", "_index", "_start")
    )


def head_n(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of :func:`global_position`, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


# --- exact selection -------------------------------------------------------------------------


def _literal(value: object, kind: T.DataType) -> Column:
    """A literal of the column's own type; a plain literal would carry a time zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value)


@dataclass
class _Target:
    """Search for the value at 0-based ``rank`` among the ``rows`` rows of a range of ``column``."""

    column: str
    kind: T.DataType
    rank: int
    rows: int
    low: object
    high: object
    above_low: bool = False
    below_high: bool = False
    by_bins: bool = True
    value: object = None
    done: bool = False

    def range(self) -> tuple:
        return self.column, self.low, self.high, self.above_low, self.below_high

    def inside(self) -> Column:
        column = F.col(self.column)
        low, high = _literal(self.low, self.kind), _literal(self.high, self.kind)
        over = column > low if self.above_low else column >= low
        return over & (column < high if self.below_high else column <= high)

    def bin(self, bins: int) -> Column:
        """Index of an equal-width bin of the range; it never falls as the value grows."""
        x = _number(F.col(self.column), self.kind)
        low = _number(_literal(self.low, self.kind), self.kind)
        high = _number(_literal(self.high, self.kind), self.kind)
        place = F.floor(F.try_divide(x - low, high - low) * bins)
        place = F.when(place >= bins, bins - 1).otherwise(place)
        return F.coalesce(place, F.lit(0)).cast("int")

    def narrow(self, below: int, rows: int, low: object, high: object) -> None:
        """Keep one bin; values bunched in one bin are next split by pivots."""
        self.by_bins = 2 * rows <= self.rows
        self.rank, self.rows, self.low, self.high = self.rank - below, rows, low, high
        self.above_low = self.below_high = False
        if low == high:
            self.value, self.done = low, True


def _number(value: Column, kind: T.DataType) -> Column | None:
    """A double that never falls as the value grows, or None for types without one."""
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        days = F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double")
        if isinstance(kind, T.DateType):
            return days
        # fields of the local time, which no time zone can reorder
        return days * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    return None


def _histograms(df: DataFrame, targets: list[_Target]) -> dict[tuple, list]:
    """Exact (count, min, max) per bin of every distinct open range, from one aggregation."""
    ranges = list({t.range(): t for t in targets}.values())
    bins = MOST_BINS // len(ranges) if len(ranges) > FEW_RANGES else MOST_BINS // FEW_RANGES
    cells = F.array(
        *[
            F.when(
                t.inside(),
                F.struct(F.lit(i).alias("range"), t.bin(bins).alias("bin"), F.col(t.column).alias("x")),
            )
            for i, t in enumerate(ranges)
        ]
    )
    counted = (
        df.select(F.explode(cells).alias("_cell"))
        .where(F.col("_cell").isNotNull())
        .select("_cell.*")
        .groupBy("range", "bin")
        .agg(F.count("*").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    found: dict[tuple, list] = {t.range(): [] for t in ranges}
    # at most MOST_BINS rows
    for row in sorted(counted.collect(), key=lambda r: (r["range"], r["bin"])):
        found[ranges[row["range"]].range()].append((row["rows"], row["low"], row["high"]))
    return found


def _narrow_by_bins(df: DataFrame, targets: list[_Target]) -> None:
    found = _histograms(df, targets)
    for target in targets:
        below = 0
        for rows, low, high in found[target.range()]:
            if target.rank < below + rows:
                target.narrow(below, rows, low, high)
                break
            below += rows


def _narrow_by_pivots(df: DataFrame, target: _Target) -> None:
    """For types without a number, or values too close for one: pivots picked by hash."""
    column, kind, inside = F.col(target.column), target.kind, target.inside()
    picks = [
        F.min_by(column, F.when(inside, F.xxhash64(column, F.lit(seed)))).alias(f"p{seed}")
        for seed in range(PIVOTS)
    ]
    pivots = sorted(set(df.where(inside).agg(*picks).first()))
    counts = []
    for i, value in enumerate(pivots):
        pivot = _literal(value, kind)
        counts += [F.count_if(column < pivot).alias(f"b{i}"), F.count_if(column == pivot).alias(f"e{i}")]
    counts = df.where(inside).agg(*counts).first()
    start, end = 0, target.rows
    for value, below, equal in zip(pivots, counts[::2], counts[1::2]):
        if below + equal <= target.rank:
            target.low, target.above_low, start = value, True, below + equal
        elif below <= target.rank:
            target.value, target.done = value, True
        elif below < end:
            target.high, target.below_high, end = value, True, below
    target.rank, target.rows = target.rank - start, end - start
    target.by_bins = _number(column, kind) is not None


def _read_few(df: DataFrame, targets: list[_Target]) -> None:
    """Finish ranges that hold few rows, with one read per column."""
    for column in {t.column for t in targets}:
        mine = [t for t in targets if t.column == column]
        inside = mine[0].inside()
        for target in mine[1:]:
            inside = inside | target.inside()
        # bounded by the rows allowed per range
        values = sorted(row[0] for row in df.where(inside).select(column).collect())
        for target in mine:
            before = bisect_right if target.above_low else bisect_left
            target.value, target.done = values[before(values, target.low) + target.rank], True


def extents(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Non-null rows, minimum and maximum of every column, and all rows as ``*``, in one job."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
    row = df.agg(*parts, F.count("*").alias("all")).first()
    found = {c: tuple(row[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}
    return {**found, "*": (row["all"], None, None)}


def sketched_extents(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, tuple], DataFrame]:
    """Extents of the columns and a stored row of their sketches, from one pass."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    group, parts, wholes, known = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"), [], [], {}
    for i, c in enumerate(columns):
        parts += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
        wholes += [F.sum(f"n{i}").alias(f"n{i}"), F.min(f"l{i}").alias(f"l{i}"), F.max(f"h{i}").alias(f"h{i}")]
        number = _number(F.col(c), kinds[c])
        if number is not None:
            parts.append(F.kll_sketch_agg_double(number, F.lit(SKETCH_K)).alias(f"s{i}"))
            wholes.append(F.kll_merge_agg_double(f"s{i}", F.lit(SKETCH_K)).alias(f"s{i}"))
    every = df.groupBy(group).agg(*parts, F.count("*").alias("all"))
    row = stage(every.agg(*wholes, F.sum("all").alias("all")), "extents")
    found = row.select(*[x for x in row.columns if x[0] != "s"]).first()
    for i, c in enumerate(columns):
        known[c] = (found[f"n{i}"] or 0, found[f"l{i}"], found[f"h{i}"])
    known["*"] = (found["all"] or 0, None, None)
    return known, row.select(*[F.col(f"s{i}").alias(c) for i, c in enumerate(columns) if f"s{i}" in row.columns])


# --- sketches that seed the selection --------------------------------------------------------


def rank_error() -> float:
    """Share of the rows by which a sketch's rank may be off, with a margin of three."""
    return 3 * 2.296 / SKETCH_K**0.9021


@dataclass
class _Bracket:
    """A range of numbers that should hold the ranks of some targets of one column."""

    targets: list[_Target]
    low: float
    high: float
    share: float = 1.0
    below: int = 0

    def number(self) -> Column:
        return _number(F.col(self.targets[0].column), self.targets[0].kind)

    def inside(self) -> Column:
        return self.number().between(F.lit(self.low), F.lit(self.high))


def _quantiles(sketch: DataFrame, wanted: Sequence[tuple[str, Sequence[float]]]) -> list[list[float]]:
    """Values of sketched columns at shares of their rows; reads no table."""
    found = sketch.select(
        *[
            F.kll_sketch_get_quantile_double(c, F.array(*[F.lit(float(x)) for x in at])).alias(f"q{i}")
            for i, (c, at) in enumerate(wanted)
        ]
    )
    return [list(x) for x in found.first()]


def _around(targets: list[_Target], rows: int, error: float) -> list[float]:
    """Shares that enclose the targets' ranks among so many rows."""
    ranks = [t.rank for t in targets]
    return [min(max((min(ranks) - 1) / rows - error, 0.0), 1.0), min(max((max(ranks) + 2) / rows + error, 0.0), 1.0)]


def _bracketed(targets: list[_Target], sketch: DataFrame, error: float) -> list[_Bracket]:
    """A bracket per run of targets of a column whose ranks lie within the sketch's error."""
    runs: list[list[_Target]] = []
    for target in sorted(targets, key=lambda t: (t.column, t.rank)):
        last = runs[-1] if runs else None
        if last and last[-1].column == target.column and target.rank - last[-1].rank <= 2 * error * target.rows:
            last.append(target)
        else:
            runs.append([target])
    shares = [_around(run, run[0].rows, error) for run in runs]
    ends = _quantiles(sketch, [(run[0].column, x) for run, x in zip(runs, shares)])
    # an end that stands for no rows outside must also hold the smallest and largest value
    return [
        _Bracket(run, -math.inf if x[0] == 0.0 else low, math.inf if x[1] == 1.0 else high, x[1] - x[0])
        for run, x, (low, high) in zip(runs, shares, ends)
    ]


def _narrowed(df: DataFrame, brackets: list[_Bracket], error: float) -> list[_Bracket]:
    """Brackets of brackets: one pass counts the rows below each and sketches those inside."""
    names = [f"b{i}" for i in range(len(brackets))]
    inside = df.select(
        *[F.when(b.inside(), b.number()).alias(n) for n, b in zip(names, brackets)],
        *[(b.number() < b.low).alias(f"{n}_below") for n, b in zip(names, brackets)],
    )
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    parts = inside.groupBy(group).agg(
        *[F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names],
        *[F.count(n).alias(f"{n}_rows") for n in names],
        *[F.count_if(f"{n}_below").alias(f"{n}_below") for n in names],
    )
    merged = stage(
        parts.agg(
            *[F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names],
            *[F.sum(f"{n}_{x}").alias(f"{n}_{x}") for n in names for x in ("rows", "below")],
        ),
        "sketches",
    )
    row = merged.first()
    out = []
    for n, b in zip(names, brackets):
        rows, below = row[f"{n}_rows"] or 0, row[f"{n}_below"] or 0
        ranks = [t.rank - below for t in b.targets]
        if rows == 0 or min(ranks) < 0 or max(ranks) >= rows:
            out.append(b)  # the sketch was off; the values read will show it
            continue
        shares = [max((min(ranks) - 1) / rows - error, 0.0), min((max(ranks) + 2) / rows + error, 1.0)]
        low, high = _quantiles(merged, [(n, shares)])[0]
        low, high = b.low if shares[0] == 0.0 else low, b.high if shares[1] == 1.0 else high
        out.append(_Bracket(b.targets, low, high, b.share * (shares[1] - shares[0])))
    return out


def _read_brackets(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Settle targets from one pass over the table: rows below each bracket, and its values' counts."""
    cells = F.array(
        *[
            F.when(
                b.number() <= b.high,
                F.struct(F.lit(i).alias("b"), F.when(b.number() >= b.low, F.col(b.targets[0].column)).alias("x")),
            )
            for i, b in enumerate(brackets)
        ]
    )
    counted = df.select(F.explode(cells).alias("_cell")).where(F.col("_cell").isNotNull()).groupBy("_cell.b", "_cell.x")
    found: list[list[tuple]] = [[] for _ in brackets]
    # a row per distinct value inside, of which there are few, and one for all rows below
    for row in counted.agg(F.count("*").alias("rows")).collect():
        found[row["b"]].append((row["x"], row["rows"]))
    for bracket, values in zip(brackets, found):
        below = sum(n for x, n in values if x is None)
        inside = sorted((x, n) for x, n in values if x is not None)
        for target in bracket.targets:
            seen = below
            for x, n in inside:
                if seen <= target.rank < seen + n:
                    target.value, target.done = x, True
                seen += n


def _seeded(df: DataFrame, targets: list[_Target], sketch: DataFrame) -> None:
    """Find targets from sketched brackets: one pass, or two if a bracket holds many rows.

    A target whose bracket turns out not to hold its rank stays open.
    """
    error = rank_error()
    for kind in {t.kind for t in targets}:
        brackets = _bracketed([t for t in targets if t.kind == kind], sketch, error)
        rows = sum(b.share * b.targets[0].rows for b in brackets)
        while rows > SKETCH_VALUES:
            brackets = _narrowed(df, brackets, error)
            before, rows = rows, sum(b.share * b.targets[0].rows for b in brackets)
            if rows > before / 2:
                break
        _read_brackets(df, brackets)


def select_ranks(
    df: DataFrame,
    wanted: Sequence[tuple[str, int]],
    direct_rows: int = DIRECT_ROWS,
    known: dict[str, tuple] | None = None,
    sketch: DataFrame | None = None,
) -> list[object]:
    """Values at given 0-based ranks: ``wanted`` lists (column, rank), nulls not ranked.

    With sketches of the columns, each rank is looked for in the narrow range of values that they
    give.  Without, or where a sketch was off, each round counts the open ranges by bins and keeps
    the bin that holds the rank, until the bin has one value or few rows.  Rows are never shuffled
    or collected, only counts are.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    known = extents(df, list(dict.fromkeys(c for c, _ in wanted))) if known is None else known
    targets = [_Target(c, kinds[c], rank, *known[c]) for c, rank in wanted]
    for target in targets:
        target.by_bins = _number(F.col(target.column), target.kind) is not None
        target.done, target.value = target.low == target.high, target.low
    open_ = [t for t in targets if t.by_bins and not t.done]
    if sketch is not None and open_:
        _seeded(df, open_, sketch)
    while True:
        _read_few(df, [t for t in targets if not t.done and t.rows <= direct_rows])
        waiting = [t for t in targets if not t.done]
        if not waiting:
            return [t.value for t in targets]
        for kind in {t.kind for t in waiting if t.by_bins}:
            _narrow_by_bins(df, [t for t in waiting if t.by_bins and t.kind == kind])
        for target in [t for t in waiting if not t.by_bins and not t.done]:
            _narrow_by_pivots(df, target)


def exact_quantiles(
    df: DataFrame, probabilities: dict[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns; nulls and NaN do not count.

    The two order statistics around each quantile are selected exactly, at any size alike.
    """
    columns = list(probabilities)
    doubles = [F.col(c).cast("double") for c in columns]
    names = [f"x{i}" for i in range(len(columns))]
    numbers = df.select(*[F.when(~F.isnan(x), x).alias(n) for n, x in zip(names, doubles)])
    known, sketch = sketched_extents(numbers, names)
    wanted, places = [], []
    for x, column in zip(names, columns):
        rows = known[x][0]
        for p in probabilities[column] if rows else []:
            at = p * (rows - 1)
            places.append((column, at - math.floor(at)))
            wanted += [(x, math.floor(at)), (x, math.ceil(at))]
    values = select_ranks(numbers, wanted, known=known, sketch=sketch)
    result: dict[str, list[float | None]] = {c: [] for c in columns}
    for k, (column, share) in enumerate(places):
        below, above = values[2 * k], values[2 * k + 1]
        result[column].append(below + (above - below) * share)
    return {c: v or [None] * len(probabilities[c]) for c, v in result.items()}


def quantile_table(df: DataFrame, probabilities: dict[str, Sequence[float]]) -> DataFrame:
    """Quantiles as rows ``(column, p, value)``."""
    found = exact_quantiles(df, probabilities)
    rows = [(c, float(p), v) for c in probabilities for p, v in zip(probabilities[c], found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


# --- time split ------------------------------------------------------------------------------


def split_cuts(
    df: DataFrame, time: str, key: str, fractions: Sequence[float], direct_rows: int = DIRECT_ROWS
) -> list[tuple[object, object] | None]:
    """The (time, key) found at position ``int(n * f)`` for every fraction; None past the end."""
    kind = df.schema[time].dataType
    known, sketch = sketched_extents(df, [time])
    total, timed = known["*"][0], known[time][0]
    ranks = [int(total * f) for f in fractions]
    inner = [r for r in ranks if r < timed]
    cuts: list[tuple[object, object] | None] = []
    if inner:
        times = select_ranks(df, [(time, r) for r in inner], direct_rows, known, sketch)
        moments = [_literal(found, kind) for found in times]
        around = []
        for moment in moments:
            at = F.col(time) == moment
            around += [F.count_if(F.col(time) < moment), F.min(F.when(at, F.col(key)))]
        around = df.agg(*[c.alias(f"a{i}") for i, c in enumerate(around)]).first()
        for i, (rank, found) in enumerate(zip(inner, times)):
            before, edge = around[2 * i : 2 * i + 2]
            if rank > before:
                at_moment = df.where(F.col(time) == moments[i])
                edge = select_ranks(at_moment, [(key, rank - before)], direct_rows)[0]
            cuts.append((found, edge))
    # rows without a time come last
    late = [r for r in ranks if timed <= r < total]
    if late:
        untimed = df.where(F.col(time).isNull())
        edges = select_ranks(untimed, [(key, r - timed) for r in late], direct_rows)
        cuts += [(None, edge) for edge in edges]
    return cuts + [None] * (len(ranks) - len(cuts))


def _before(df: DataFrame, time: str, key: str, cut: tuple[object, object] | None) -> Column:
    if cut is None:
        return F.lit(True)
    edge = _literal(cut[1], df.schema[key].dataType)
    if cut[0] is None:
        return F.col(time).isNotNull() | (F.col(key) < edge)
    moment = _literal(cut[0], df.schema[time].dataType)
    return (F.col(time) < moment) | ((F.col(time) == moment) & (F.col(key) < edge))


def time_split(
    df: DataFrame,
    time: str,
    key: str,
    fractions: Sequence[float] = (0.70, 0.85),
    names: Sequence[str] = ("train", "val", "test"),
    out: str = "split",
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Split by position in (time, key) order without sorting or moving any row.

    Only the keys at the cut positions are searched; each row then compares with them.
    """
    cuts = split_cuts(df, time, key, fractions, direct_rows)
    label = F.when(_before(df, time, key, cuts[0]), names[0])
    for cut, name in zip(cuts[1:], names[1:]):
        label = label.when(_before(df, time, key, cut), name)
    return df.withColumn(out, label.otherwise(names[-1]))


# --- sampling --------------------------------------------------------------------------------


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42, margin: float = 1.3) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same under any partitioning.

    Rows are ordered by a hash of (key, seed).  A cut on the hash lets only slightly more than
    ``n`` rows reach the final sort; the smallest ``n`` hashes always lie under a wide enough cut.
    """
    total = df.count()
    if n >= total:
        return df
    rank = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    hashed = df.withColumn("_rank", rank)
    share, kept = margin * n / total, hashed
    while share < 1:
        kept = hashed.where(F.col("_rank") < f"{int(share * 16**8):08x}")
        if kept.count() >= n:
            break
        share, kept = share * 2, hashed
    return kept.orderBy("_rank", key).limit(n).drop("_rank")


# --- prefix sums -----------------------------------------------------------------------------


def _starts(columns: list[pa.Array], rows: int) -> np.ndarray:
    """Whether each row but the first differs from the row before in any column; nulls and NaN are equal."""
    differs = np.zeros(max(rows - 1, 0), bool)
    for column in columns:
        now, last = column.slice(1), column.slice(0, max(rows - 1, 0))
        same = pc.or_(pc.fill_null(pc.equal(now, last), False), pc.and_(pc.is_null(now), pc.is_null(last)))
        if pa.types.is_floating(column.type):
            nan = pc.and_(pc.fill_null(pc.is_nan(now), False), pc.fill_null(pc.is_nan(last), False))
            same = pc.or_(same, nan)
        differs |= ~same.to_numpy(zero_copy_only=False)
    return differs


def running_totals(
    df: DataFrame,
    key: str,
    sums: dict[str, str],
    group: Sequence[str] = (),
    wholes: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums in ascending order of a key, unique within ``group``.

    ``sums`` and ``wholes`` map new columns to summed ones, which hold whole numbers; wholes are
    sums of the whole group.  Null group values form a group.

    Rows are dealt by ranges of (group, key), so a group of any size spans as many ranges as it
    needs.  A range is summed as its sorted rows are written, the one shuffle of the rows; then
    each row takes the total of its group's ranges before, from a table with a row per range and
    group, which is broadcast if it is counted to be small.
    """
    group, wholes = list(group), wholes or {}
    fields = df.columns
    schema = T.StructType(
        [*df.schema.fields, *[T.StructField(out, T.LongType()) for out in sums], T.StructField("_part", T.IntegerType())]
    )

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before: pa.RecordBatch | None = None
        carried = dict.fromkeys(sums, 0)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            at = [fields.index(c) for c in group]
            starts = np.flatnonzero(np.r_[True, _starts([batch.column(i) for i in at], rows)])
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, rows]))
            if before is not None:
                ends = pa.Table.from_batches([before, batch.slice(0, 1)]).combine_chunks()
                if _starts([ends.column(i).combine_chunks() for i in at], 2)[0]:
                    carried = dict.fromkeys(sums, 0)
            columns = list(batch.columns)
            for out, name in sums.items():
                x = batch.column(fields.index(name)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(x)
                base = upto[starts] - x[starts]
                base[0] -= carried[out]
                total = upto - base[run]
                carried[out] = int(total[-1])
                columns.append(pa.array(total))
            columns.append(pa.array(np.full(rows, part, np.int32)))
            before = batch.slice(rows - 1, 1)
            yield pa.RecordBatch.from_arrays(columns, [*fields, *sums, "_part"])

    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *group, key).sortWithinPartitions(*group, key)
    local = stage(dealt.mapInArrow(accumulate, schema), "ranges")
    # a row per range and group
    names = list(dict.fromkeys([*sums.values(), *wholes.values()]))
    totals = local.groupBy(*group, "_part").agg(*[F.sum(n).alias(f"_in_{n}") for n in names])
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(c).alias(f"_group_{c}") for c in group],
        F.col("_part").alias("_start_part"),
        *[
            F.coalesce(F.sum(f"_in_{name}").over(earlier), F.lit(0)).alias(f"_before_{out}")
            for out, name in sums.items()
        ],
        *[F.sum(f"_in_{name}").over(whole).alias(f"_whole_{out}") for out, name in wholes.items()],
    )
    totals = stage(totals, "range-totals")
    totals = F.broadcast(totals) if totals.count() <= MOST_BINS else totals
    same = F.col("_part") == F.col("_start_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_group_{c}"))
    return local.join(totals, same).select(
        *fields,
        *[(F.col(out) + F.col(f"_before_{out}")).alias(out) for out in sums],
        *[F.col(f"_whole_{out}").alias(out) for out in wholes],
    )
