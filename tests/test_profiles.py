"""Velocity, profiles, lookups under skew, codes, quality."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from riskloom.operators import encoding, lookup, quality, velocity


@pytest.fixture(scope="module")
def cards(spark):
    """One card holds a third of the rows, one has a single row, one a constant amount."""
    base, rows = dt.datetime(2024, 3, 1), []
    rng = np.random.default_rng(2)
    for i in range(900):
        card = 1 if i % 3 == 0 else int(rng.integers(2, 40))
        rows.append((i, card, base + dt.timedelta(hours=int(rng.integers(0, 240))), float(rng.normal(50, 9)), float(rng.random())))
    rows += [(900, 100, base, 5.0, 1.0)]
    rows += [(901 + i, 101, base + dt.timedelta(days=i), 0.1, 0.3) for i in range(7)]
    return spark.createDataFrame(rows, "id bigint, card bigint, t timestamp_ntz, amt double, dist double").repartition(5).cache()


def test_profile_equals_pandas(cards):
    found = velocity.entity_profile(cards, "card", "t", "amt", "dist").toPandas().set_index("card").sort_index()
    rows = cards.toPandas()
    rows["day"] = pd.to_datetime(rows["t"]).dt.date
    rows["n"] = rows.groupby(["card", "day"])["id"].transform("size")
    want = rows.groupby("card").agg(
        user_mean_amt=("amt", "mean"), user_std_amt=("amt", "std"), user_mean_dist=("dist", "mean"),
        user_std_dist=("dist", "std"), user_mean_velocity=("n", "mean"), user_std_velocity=("n", "std"),
    )
    want = want.fillna({c: 1.0 for c in velocity.PROFILE_STDS})
    assert np.allclose(found[list(want.columns)], want)
    # a constant entity has a deviation of exactly zero, which the z-score guard needs
    assert found.loc[101, "user_std_amt"] == 0.0 and found.loc[101, "user_std_velocity"] == 0.0


@pytest.mark.parametrize("share", [1e-9, 1 / 256, 0.2, 1.0])
def test_spread_lookup_with_any_hot_share(cards, share):
    counts = velocity.daily_count(cards, "card", "t", "day")
    dated = cards.withColumn("day", F.to_date("t"))
    found = lookup.spread_lookup(dated, counts, ["card", "day"], ["daily_txn_count"], "daily_txn_count", share)
    want = F.count("*").over(Window.partitionBy("card", "day"))
    both = found.withColumn("want", want)
    assert both.count() == cards.count() and both.where("daily_txn_count <> want").count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_lookup_without_weights_keeps_unmatched_rows(spark, cards, adaptive):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        dim = cards.where("card <> 100").groupBy("card").agg(F.max("amt").alias("top"))
        found = lookup.spread_lookup(cards, dim, ["card"], ["top"], share=0.1)
        assert found.count() == cards.count()
        assert found.where("top is null").select("card").distinct().collect()[0][0] == 100
        wrong = found.join(dim.withColumnRenamed("top", "want"), "card").where("top <> want")
        assert wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("hot", ["a hot key", "null keys", "an unseen key"])
def test_hot_rows_do_not_share_a_shuffle_partition(spark, hot):
    """Two thirds of the rows have one key; with plain hashing one partition would hold them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        key = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(None if hot == "null keys" else -1)
        df = spark.range(0, 60_000, 1, 64).withColumn("key", key.cast("bigint"))
        counts = df.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
        weight = "n"
        if hot == "an unseen key":
            counts, weight = counts.where("key >= 0"), None
        found = lookup.spread_lookup(df, counts, ["key"], ["n"], weight)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 60_000 and max(sizes) < 60_000 / 5
        unmatched = 0 if hot == "a hot key" else 40_000
        assert found.agg(F.max("n")).first()[0] == (1 if unmatched else 40_000)
        assert found.where("n is null").count() == unmatched
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_unseen_entities_get_defaults(cards):
    profile = velocity.entity_profile(cards.where("card < 20"), "card", "t", "amt", "dist")
    joined = velocity.join_profile(cards, profile, "card")
    scored = velocity.user_zscores(
        velocity.with_daily_count(joined, "card", "t"), "amt", "dist"
    ).where("card = 100")
    row = scored.first()
    assert row["user_amt_zscore"] == row["amt"] and row["user_velocity_zscore"] == 1.0


def test_one_join_equals_two(cards):
    profile = velocity.entity_profile(cards, "card", "t", "amt", "dist").cache()
    one = velocity.with_entity_state(cards, profile, "card", "t")
    two = velocity.with_daily_count(velocity.join_profile(cards, profile, "card"), "card", "t")
    assert one.exceptAll(two.select(*one.columns)).count() == 0


def test_codes_by_first_appearance_and_null(spark):
    rows = [(3, "b"), (1, "c"), (2, None), (4, "a"), (5, "c"), (6, "b")]
    df = spark.createDataFrame(rows, "pos bigint, v string")
    codes = encoding.label_codes(df, "v", "pos")
    assert {r["value"]: r["code"] for r in codes.collect()} == {"c": 0, None: 1, "b": 2, "a": 3}
    mapped = encoding.code_map(df.withColumn("w", F.col("v")), ["v", "w"], ["pos"], "pos").collect()
    for column in "vw":
        assert {r["value"]: (r["code"], r["freq"]) for r in mapped if r["column"] == column} == {
            "c": (0, 2), None: (1, 0), "b": (2, 2), "a": (3, 1)
        }
    assert all(r["code"] is None and r["freq"] == 1 for r in mapped if r["column"] == "pos")


def test_large_maps_read_the_rows_once(spark):
    df = spark.createDataFrame([(i, f"a{i % 3}", f"b{i % 4}", f"c{i % 5}") for i in range(50)], "pos int, a string, b string, c string")
    codes = encoding.code_map(df, ["a", "b"], ["a", "b", "c"], "pos").cache()
    for n in (1, 2, 3):
        freq = {x: f"{x}_freq" for x in "abc"[:n]}
        plan = encoding.apply_codes(df, codes, {}, freq, broadcast_rows=0)
        # one scan of the rows, however many columns there are
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("pos#") < 60 * n
        scans = plan._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("|").count("LogicalRDD")
        assert scans <= 1


def test_rows_without_a_time_keep_their_profile(spark):
    rows = [("a", f"2024-01-0{i % 3 + 1}", float(i), 1.0 * i) for i in range(9)] + [("a", None, 4.0, 1.0), ("z", None, 1.0, 1.0), (None, "2024-01-01", 1.0, 1.0)]
    cards = spark.createDataFrame(rows, "card string, t string, amt double, dist double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    fit = cards.where("card = 'a'")
    profile = velocity.entity_profile(fit, "card", "t", "amt", "dist").cache()
    one = velocity.with_entity_state(cards, profile, "card", "t", rows_as="freq").collect()
    assert len(one) == len(rows)
    known = [r for r in one if r["card"] == "a"]
    assert len({r["user_mean_amt"] for r in known}) == 1 and {r["freq"] for r in known} == {10}
    assert [r["daily_txn_count"] for r in known if r["t"] is None] == [None]
    assert {(r["user_mean_amt"], r["user_std_amt"], r["freq"]) for r in one if r["card"] != "a"} == {(0.0, 1.0, 0)}


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_apply_codes_unseen_and_null(spark, broadcast_rows):
    fit = spark.createDataFrame([(0, "a", "x"), (1, "b", None), (2, "a", "x")], "pos int, v string, w string")
    codes = encoding.code_map(fit, ["v"], ["w"], "pos")
    batch = spark.createDataFrame([(0, "b", "x"), (1, "z", None), (2, None, "q")], "pos int, v string, w string")
    found = encoding.apply_codes(batch, codes, {"v": "v"}, {"w": "w_freq"}, broadcast_rows=broadcast_rows)
    assert [(r["v"], r["w_freq"]) for r in found.orderBy("pos").collect()] == [(1, 2), (-1, 0), (-1, 0)]


def test_mode_ties_take_the_smallest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",)], "v string")
    assert quality.modes(df, ["v"]) == {"v": "a"}
    assert quality.impute_mode(df).where("v is null").count() == 0


def test_median_imputation_only_where_needed(spark):
    df = spark.createDataFrame([(1.0, 1), (4.0, 2), (None, 3)], "x double, y int")
    assert quality.columns_with_nulls(df, ["x", "y"]) == ["x"]
    assert [r["x"] for r in quality.impute_median(df).orderBy("y").collect()] == [1.0, 4.0, 2.5]


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_first_row_of_each_key_wins_in_any_layout(spark, parts):
    rows = [(i, f"k{i % 50}", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "pos bigint, key string, x double").repartition(parts)
    kept = quality.dedup_key(df, ["key"], ["pos"])
    assert sorted(r["pos"] for r in kept.collect()) == list(range(50))
    assert kept.columns == df.columns


def test_duplicate_rows_compare_nulls_as_equal(spark):
    df = spark.createDataFrame([(0, None, 1), (1, None, 1), (2, "a", 1)], "pos int, a string, b int")
    assert sorted(r["pos"] for r in quality.dedup_rows(df, "pos").collect()) == [0, 2]
    found = quality.repeat_counts(df, ["b"], ignore=["pos"]).first()
    assert (found["duplicate_rows"], found["duplicate_keys"]) == (1, 2)


def test_class_counts_with_one_class(spark):
    row = quality.class_counts(spark.createDataFrame([(0,), (0,)], "y int"), "y").first()
    assert (row["total"], row["fraud"], row["imbalance_ratio"]) == (2, 0, None)
    assert quality.class_weight(spark.createDataFrame([(0,)], "y int"), "y").first()["value"] is None


# --- hot values and entities that the fitted table did not show --------------------------------


@pytest.fixture
def plain_shuffles(spark):
    """16 partitions that nothing merges, splits or broadcasts away."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def widest(df):
    """Share of the rows in the fullest partition."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


@pytest.mark.parametrize("known", [True, False])
def test_a_new_hot_value_is_spread(spark, plain_shuffles, known):
    """A merchant with a third of the batch, rare in the fitted table or unseen."""
    fitted = spark.range(5000).select(F.concat(F.lit("m"), F.col("id")).alias("m"), F.col("id").alias("at"))
    if known:
        fitted = fitted.union(spark.createDataFrame([("new", 5000)], "m string, at long"))
    codes = encoding.code_map(fitted, ["m"], [], "at").cache()
    batch = spark.range(0, 12_000, 1, 16).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "new").otherwise(F.concat(F.lit("m"), F.col("id") % 6000)).alias("m")
    )
    coded = encoding.apply_codes(batch, codes, {"m": "code"}, {}, broadcast_rows=0)
    want = batch.join(F.broadcast(codes.select(F.col("value").alias("m"), F.col("code").alias("want"))), "m", "left")
    both = coded.join(want, "id")
    assert both.count() == 12_000
    assert both.where("code <> coalesce(want, -1)").count() == 0
    assert widest(coded) < 0.15


def test_frequent_values(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("a"),
        F.concat(F.lit("x"), F.col("id") % 100).alias("b"),
    )
    found = lookup.frequent_values(df, ["a", "b"])
    assert found["a"] == ["hot"] and sorted(found["b"]) == sorted(f"x{i}" for i in range(100))
    assert lookup.frequent_values(df.limit(0), ["a"]) == {"a": []} and lookup.frequent_values(df, []) == {}


def test_an_entity_without_times_is_spread(spark, plain_shuffles):
    """Half of all rows are those of one card, none of which has a time."""
    base = F.lit("2024-03-01").cast("timestamp_ntz")
    rows = spark.range(0, 9000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(100 + F.col("id") % 900).alias("card"),
        F.when(F.col("id") % 2 == 1, base).alias("t"),
        F.lit(2.0).alias("amt"),
        (F.col("id") % 10).cast("double").alias("dist"),
    )
    profile = velocity.entity_profile(rows, "card", "t", "amt", "dist").cache()
    joined = velocity.with_entity_state(rows, profile, "card", "t")
    hot = joined.where("card = 7")
    assert hot.count() == 4500 and hot.where("daily_txn_count is not null or user_mean_amt <> 2.0").count() == 0
    assert widest(joined) < 0.2
