"""Distributed order operators against plain ones, on bounds low enough to leave the short paths."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from riskloom.operators import ordering


@pytest.fixture(scope="module")
def tied(spark):
    """A third of the rows share one time and one amount."""
    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        t = base + dt.timedelta(seconds=0 if hot else int(rng.integers(-5000, 5000)))
        rows.append((f"k{i:05d}", t, 7.5 if hot else float(rng.normal(8, 3)), i))
    return spark.createDataFrame(rows, "key string, t timestamp_ntz, x double, n bigint").repartition(6).cache()


def test_global_position_distributed(tied):
    far = ordering.global_position(tied, ["t", "key"], "place")
    near = tied.withColumn("place", F.row_number().over(Window.orderBy("t", "key")) - 1)
    assert far.select("place").distinct().count() == 3000
    both = far.join(near.select("key", F.col("place").alias("want")), "key")
    assert both.where("place <> want").count() == 0


@pytest.mark.parametrize("direct", [10, 100_000])
@pytest.mark.parametrize("key", ["key", "n"])
def test_time_split_equals_positions(tied, direct, key):
    split = ordering.time_split(tied, "t", key, direct_rows=direct)
    place = F.row_number().over(Window.orderBy("t", key)) - 1
    want = F.when(place < 2100, "train").when(place < 2550, "val").otherwise("test")
    placed = tied.select("key", want.alias("want"))
    assert split.join(placed, "key").where("split <> want").count() == 0


@pytest.mark.parametrize("rows", [1, 2, 10, 20])
def test_small_splits_cut_at_truncated_positions(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("t"), F.col("id").alias("k"))
    sizes = {r["split"]: r["count"] for r in ordering.time_split(df, "t", "k").groupBy("split").count().collect()}
    train, val = int(rows * 0.70), int(rows * 0.85)
    assert [sizes.get(s, 0) for s in ("train", "val", "test")] == [train, val - train, rows - val]


@pytest.mark.parametrize("bound", [1, 1000])
def test_rows_without_time_come_last(spark, bound):
    rows = [(None, "c"), (None, "a"), (2, "x"), (1, "y"), (None, "b"), (None, "d")]
    df = spark.createDataFrame(rows, "t int, k string")
    split = ordering.time_split(df, "t", "k", (0.34, 0.67), direct_rows=bound)
    parts = {r["k"]: r["split"] for r in split.collect()}
    assert parts == {"y": "train", "x": "train", "a": "val", "b": "val", "c": "test", "d": "test"}
    placed = ordering.global_position(df, ["t", "k"], "place")
    assert [r["k"] for r in placed.orderBy("place").collect()] == list("yxabcd")


def test_split_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, k) for k in "dcba"], "t int, k string")
    split = ordering.time_split(df, "t", "k", (0.5,), ("first", "last"))
    assert {r["k"]: r["split"] for r in split.collect()} == {"a": "first", "b": "first", "c": "last", "d": "last"}


def interpolated(x, p):
    x, at = sorted(x), p * (len(x) - 1)
    below, above = x[int(np.floor(at))], x[int(np.ceil(at))]
    return below + (above - below) * (at - np.floor(at))


@pytest.mark.parametrize("rows", [7, 300, 3000])
def test_quantiles_equal_to_the_bit_at_any_size(tied, rows):
    probabilities = {"x": [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0], "n": [0.5]}
    part = tied.where(F.col("n") < rows)
    found = ordering.exact_quantiles(part, probabilities)
    x = [r[0] for r in part.select("x").collect()]
    assert found["x"] == [interpolated(x, p) for p in probabilities["x"]]
    assert found["n"] == [(rows - 1) / 2]


def test_quantiles_pass_over_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert ordering.exact_quantiles(df, {"x": [0.0, 0.5, 1.0]}) == {"x": [1.0, 2.0, 3.0]}


def test_rank_selection_narrows_exactly(tied):
    ranks = [0, 1, 999, 1000, 1500, 2998, 2999]
    found = ordering.select_ranks(tied, [("x", r) for r in ranks], direct_rows=5)
    x = sorted(r[0] for r in tied.select("x").collect())
    assert found == [x[r] for r in ranks]
    texts = ordering.select_ranks(tied, [("key", r) for r in ranks], direct_rows=5)
    assert texts == [f"k{r:05d}" for r in ranks]


def test_rank_selection_over_wide_values(spark):
    """Magnitudes far apart, and many rows within one second."""
    wide = spark.range(3000).select(F.pow(F.lit(10.0), (F.col("id") % 300) - 150).alias("v"), "id")
    want = sorted(10.0 ** (i % 300 - 150) for i in range(3000))
    found = ordering.select_ranks(wide, [("v", 5), ("v", 1500), ("v", 2990)], direct_rows=3)
    assert np.allclose(found, [want[5], want[1500], want[2990]])
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(microseconds=i),) for i in range(1000)]
    close = spark.createDataFrame(rows, "t timestamp_ntz")
    assert ordering.select_ranks(close, [("t", 321)], direct_rows=3) == [rows[321][0]]


def test_rank_selection_in_very_long_integers(spark):
    df = spark.range(2000).select((F.col("id") + F.lit(2**60)).alias("v"))
    assert ordering.select_ranks(df, [("v", 777)], direct_rows=5) == [2**60 + 777]


def test_quantile_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert ordering.exact_quantiles(df, {"x": [0.5]}) == {"x": [None]}


def test_running_totals_distributed(spark):
    df = spark.range(5000).select(
        ((F.col("id") * 7919) % 5000 / 10.0).alias("key"), "id", F.lit(1).alias("one")
    )
    df = df.withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3)).drop("id")
    for group in ([], ["g"]):
        whole = Window.partitionBy(*group)
        near = df.withColumn("total", F.sum("one").over(whole.orderBy("key")))
        near = near.withColumn("all", F.sum("one").over(whole))
        far = ordering.running_totals(df, "key", {"total": "one"}, group, {"all": "one"})
        assert far.exceptAll(near).count() == 0 and near.exceptAll(far).count() == 0


def test_sample_is_exact_and_independent_of_layout(tied):
    kept = [
        {r["key"] for r in ordering.sample_n(tied.repartition(parts), "key", 500).select("key").collect()}
        for parts in (1, 4, 32)
    ]
    assert len(kept[0]) == 500 and kept[0] == kept[1] == kept[2]
    assert ordering.sample_n(tied, "key", 10_000).count() == 3000
    other = {r["key"] for r in ordering.sample_n(tied, "key", 500, seed=1).select("key").collect()}
    assert other != kept[0]
    narrow = ordering.sample_n(tied, "key", 500, margin=0.01)
    assert {r["key"] for r in narrow.collect()} == kept[0]


def test_head_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "n int")
    assert [r["n"] for r in ordering.head_n(df, ["n"], 2).collect()] == [1, 2]
    assert [r["n"] for r in ordering.head_n(df, ["n"], 5).collect()] == [1, 2, None]


def test_head(tied):
    assert [r["n"] for r in ordering.head_n(tied, ["n"], 3).collect()] == [0, 1, 2]


# --- sketches --------------------------------------------------------------------------------


@pytest.fixture
def passes(monkeypatch):
    """Names of the passes over the table that follow the sketch."""
    made = []
    for name in ("_read_brackets", "_narrowed", "_histograms", "_read_few"):
        plain = getattr(ordering, name)

        def counted(df, targets, *rest, plain=plain, name=name):
            if targets:
                made.append(name)
            return plain(df, targets, *rest)

        monkeypatch.setattr(ordering, name, counted)
    return made


@pytest.mark.parametrize("values, bound", [(200_000, 1), (5_000, 2)])
def test_sketched_quantiles_take_two_passes(spark, monkeypatch, passes, values, bound):
    """Smooth, tied, bunched and infinite values, nulls and NaN; the same values as by NumPy."""
    monkeypatch.setattr(ordering, "SKETCH_K", 512)
    monkeypatch.setattr(ordering, "SKETCH_VALUES", values)
    rng = np.random.default_rng(9)
    n = 40_000
    columns = {
        "smooth": rng.normal(size=n),
        "tied": rng.integers(0, 5, n).astype(float),
        "bunched": np.where(rng.random(n) < 0.5, 1e12, rng.random(n)),
        "ends": np.where(rng.random(n) < 0.1, -np.inf, np.where(rng.random(n) < 0.1, np.inf, rng.random(n))),
        "holes": np.where(rng.random(n) < 0.4, np.nan, rng.random(n)),
    }
    df = spark.createDataFrame(pd.DataFrame(columns)).repartition(6)
    shares = {c: [0.0, 0.01, 0.25, 0.5, 0.99, 1.0] for c in columns}
    shares["ends"] = [0.25, 0.5, 0.75]
    found = ordering.exact_quantiles(df, shares)
    for c, values_ in columns.items():
        known = values_[~np.isnan(values_)]
        assert np.allclose(found[c], np.quantile(known, shares[c]), rtol=1e-12, atol=0), c
    assert len(passes) <= bound and "_histograms" not in passes


def test_a_sketch_that_is_off(spark, monkeypatch, passes):
    """Brackets without the rank are found out, and the ranks are looked for by bins."""
    monkeypatch.setattr(ordering, "_quantiles", lambda sketch, wanted: [[0.5, 0.5 + 1e-9] for _ in wanted])
    df = spark.range(20_000).select((F.col("id") / 20_000.0).alias("x"))
    found = ordering.exact_quantiles(df, {"x": [0.1, 0.9]})["x"]
    assert found == pytest.approx(np.quantile(np.arange(20_000) / 20_000, [0.1, 0.9]).tolist())
    assert "_histograms" in passes


def test_ranks_of_whole_numbers_and_times(spark):
    """Numbers that doubles cannot tell apart, and times within one second."""
    rows = [(2**60 + i, dt.datetime(2024, 1, 1, 0, 0, i // 400, i % 400)) for i in range(2000)]
    df = spark.createDataFrame(rows, "v long, t timestamp_ntz").repartition(3)
    known, sketch = ordering.sketched_extents(df, ["v", "t"])
    found = ordering.select_ranks(df, [("v", 777), ("t", 1234), ("v", 0), ("t", 1999)], 5, known, sketch)
    assert found == [2**60 + 777, rows[1234][1], 2**60, rows[1999][1]]


def test_sketches_of_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert ordering.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [1.5]}
    assert ordering.exact_quantiles(df.limit(0), {"b": [0.5]}) == {"b": [None]}


# --- running totals --------------------------------------------------------------------------


def test_running_totals_of_odd_groups(spark):
    """NaN, null and text groups, many groups per batch, a group over all ranges, null summands."""
    rows = [
        (float("nan") if i % 5 == 0 else None if i % 5 == 1 else float(i % 700), "b" if i % 2 else None, i, None if i % 9 == 0 else i)
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "f double, s string, key long, n long").repartition(5)
    for group in (["f", "s"], ["s"], []):
        whole = Window.partitionBy(*group)
        up = whole.orderBy("key")
        near = df.withColumns({"total": F.sum(F.coalesce("n", F.lit(0))).over(up), "all": F.sum("n").over(whole)})
        far = ordering.running_totals(df, "key", {"total": "n"}, group, {"all": "n"})
        assert far.exceptAll(near).count() == 0 and near.exceptAll(far).count() == 0
    assert ordering.running_totals(df.limit(0), "key", {"total": "n"}, ["s"]).count() == 0


def test_rows_of_running_totals_move_once(spark):
    """After the sorted rows are written only totals of ranges are exchanged, and none of it is a window of rows."""
    df = spark.range(4000).select(F.col("id").alias("key"), (F.col("id") % 3).alias("g"), F.lit(1).alias("one"))
    plan = ordering.running_totals(df, "key", {"t": "one"}, ["g"], {"w": "one"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "Exchange hashpartitioning" not in plan
