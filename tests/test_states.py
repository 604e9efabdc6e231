"""Merged states against statistics of all rows, and the first rows of keys."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import moments, quality, states, velocity
from riskloom.plans import enrich
from riskloom.schema import TxnColumns
from riskloom.sources.profiles import ProfileStates

COLS = TxnColumns(key="id", entity="card", time="t", amount="amt")


@pytest.fixture(scope="module")
def rows(spark):
    """Amounts far from zero, nulls in each column, rows without a time, a hot card, constant cards."""
    rng, base, out = np.random.default_rng(7), dt.datetime(2024, 3, 1), []
    for i in range(1200):
        card = 1 if i % 3 == 0 else int(rng.integers(2, 30))
        amount = None if i % 17 == 0 else 1e9 + float(rng.normal(0, 3))
        when = None if i % 23 == 0 else base + dt.timedelta(hours=int(rng.integers(0, 200)))
        out.append((i, card, when, amount, None if i % 11 == 0 else float(rng.random()) * 40))
    out += [(2000 + i, 101, base + dt.timedelta(days=i), 0.1, 0.3) for i in range(7)]
    out += [(3000, 102, base, 5.0, 1.0), (3001, None, base, 7.0, 2.0), (3002, 103, None, 7.0, None), (3003, 104, base, None, None)]
    schema = "id long, card long, t timestamp_ntz, amt double, distance_km double"
    return spark.createDataFrame(out, schema).repartition(4).cache()


def table(df, key="card"):
    return df.toPandas().sort_values(key).reset_index(drop=True)


def test_day_n_plus_one_equals_a_refit(spark, rows, tmp_path):
    """Stored states, and then the states of later rows: the earlier rows are gone."""
    early = rows.where("id % 3 <> 0")
    ProfileStates.of(early, COLS).save(str(tmp_path / "s"))
    grown = ProfileStates.load(spark, str(tmp_path / "s"), COLS).merged(ProfileStates.of(rows.where("id % 3 = 0"), COLS))
    files = [f for f in grown.entities().inputFiles() if str(tmp_path) in f]
    assert files, "the earlier part comes from its states"
    whole = velocity.entity_profile(rows, "card", "t", "amt", "distance_km")
    # rows without an entity have no profile to be joined
    found, want = table(grown.entities().dropna(subset="card")), table(whole.dropna(subset="card"))
    pd.testing.assert_frame_equal(found, want, check_exact=False, rtol=1e-6)
    counts = velocity.daily_count(rows, "card", "t")
    assert grown.counts().exceptAll(counts).count() == 0 and counts.exceptAll(grown.counts()).count() == 0
    names = ["amt", "distance_km", velocity.COUNT]
    dated = velocity.with_daily_count(rows, "card", "t")
    got, true = grown.mean_cov().first().asDict(), moments.mean_cov(dated, names).first().asDict()
    assert got.keys() == true.keys()
    for name, value in true.items():
        assert got[name] == pytest.approx(value, rel=1e-6), name


def test_constants_keep_a_deviation_of_zero(rows):
    parts = [ProfileStates.of(rows.where(f"id % 5 = {k}"), COLS) for k in range(5)]
    found = table(parts[0].merged(*parts[1:]).entities()).set_index("card")
    assert found.loc[101, "user_std_amt"] == 0.0 and found.loc[101, "user_mean_amt"] == 0.1
    assert found.loc[101, "user_std_velocity"] == 0.0
    assert found.loc[102, "user_std_amt"] == 1.0  # a single row


def test_merging_is_the_same_in_any_order(rows):
    parts = [states.moment_state(rows.where(f"id % 4 = {k}"), ["amt", "distance_km"], ["card"]) for k in range(4)]
    names, group = ["amt", "distance_km"], ["card"]
    flat = states.merge_states(parts, names, group)
    steps = states.merge_states([states.merge_states(parts[2:], names, group), *parts[:2]], names, group)
    whole = states.moment_state(rows, names, group)
    for merged in (flat, steps):
        pd.testing.assert_frame_equal(table(merged)[whole.columns], table(whole), check_exact=False, rtol=1e-6)
        assert set(merged.columns) == set(whole.columns)


def test_states_without_rows_or_groups(rows):
    none = rows.limit(0)
    assert states.moment_state(none, ["amt"], ["card"]).count() == 0
    both = states.merge_states([states.moment_state(r, ["amt"]) for r in (none, rows)], ["amt"])
    got = states.state_moments(both, ["amt"]).first()
    want = rows.agg(F.avg("amt"), F.var_samp("amt")).first()
    assert got["mean_amt"] == pytest.approx(want[0]) and got["cov_amt_amt"] == pytest.approx(want[1], rel=1e-6)
    empty = ProfileStates.of(none, COLS)
    assert empty.merged(ProfileStates.of(rows, COLS)).entities().count() == rows.select("card").distinct().count()
    assert empty.entities().count() == 0 and empty.mean_cov().first()["mean_amt"] is None


def test_global_profile_of_states(rows):
    whole = enrich.fit_global(velocity.with_daily_count(rows, "card", "t"), COLS)
    found = ProfileStates.of(rows, COLS).overall(whole.mahala_99_pct)
    assert found.mean_amt == pytest.approx(whole.mean_amt) and found.std_dist == pytest.approx(whole.std_dist)
    assert np.allclose(found.mahala_inv_cov, whole.mahala_inv_cov, rtol=1e-5)


# --- first rows of keys ----------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_first_rows_of_keys(spark):
    """Unique keys, a hot key, null keys, ties in the order, equal rows, and a clashing column name."""
    rng, rows = np.random.default_rng(3), []
    for i in range(3000):
        key = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{rng.integers(0, 4000)}"
        rows.append((key, int(rng.integers(0, 5)) if i % 7 else None, int(rng.integers(0, 3)), i % 4))
    df = spark.createDataFrame(rows, "key string, at int, x int, _dedup_0 int").repartition(7)
    found = [tuple(r) for r in quality.dedup_key(df, ["key"], ["at"]).collect()]
    lowest = {}
    none_first = lambda r: [(v is not None, v or 0) for v in r[1:]]
    for r in rows:
        if r[0] not in lowest or none_first(r) < none_first(lowest[r[0]]):
            lowest[r[0]] = r
    assert sorted(found, key=str) == sorted(lowest.values(), key=str)


def test_map_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, {"a": 1}, 2), (1, {"b": 1}, 1), (2, {}, 1)], "key int, m map<string,int>, at int")
    assert sorted((r["key"], r["at"]) for r in quality.dedup_key(df, ["key"], ["at"]).collect()) == [(1, 1), (2, 1)]
    assert quality.dedup_key(df.limit(0), ["key"], ["at"]).count() == 0


def test_a_full_map_of_repeated_keys(spark, monkeypatch):
    """With a map far too small nearly every row is ranked, and the result is the same."""
    monkeypatch.setattr(quality, "KEY_BITS", 64)
    df = spark.range(4000).select((F.col("id") % 2500).alias("key"), F.col("id").alias("at")).repartition(5)
    found = quality.dedup_key(df, ["key"], ["at"])
    assert sorted(tuple(r) for r in found.collect()) == [(i, i) for i in range(2500)]


def test_unique_rows_are_not_shuffled(spark, tmp_path):
    """Rows off the map pass no exchange, and nothing is aggregated by sorting."""
    df = spark.range(20_000).select((F.col("id") % 19_990).alias("key"), F.col("id").alias("at"), F.repeat(F.lit("x"), 50).alias("text"))
    df.write.parquet(str(tmp_path / "t"))
    found = quality.dedup_key(spark.read.parquet(str(tmp_path / "t")), ["key"], ["at"])
    assert found.count() == 19_990
    text = plan(found)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    # what moves are the hashes of the keys, the words of the map, and the rows that are ranked
    assert len([x for x in text.splitlines() if "Exchange hashpartitioning(key" in x]) == 1
    assert quality._repeated(spark.read.parquet(str(tmp_path / "t")), ["key"]).agg(F.sum(F.bit_count("_bits"))).first()[0] == 10
