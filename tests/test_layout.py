"""Bucketed joins without an exchange, and positions from file metadata."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import velocity
from riskloom.sources import layout, tables


@pytest.fixture(scope="module")
def cards(spark):
    base = dt.datetime(2024, 3, 1)
    rows = [
        (i, None if i % 40 == 0 else 1 if i % 3 == 0 else i % 50, None if i % 13 == 0 else base + dt.timedelta(hours=i % 300), float(i % 7), 1.0 * i)
        for i in range(1500)
    ]
    return spark.createDataFrame(rows, "id long, card long, t timestamp_ntz, amt double, dist double").repartition(5).cache()


@pytest.fixture(scope="module")
def lines(cards):
    known = cards.where("card <> 17")
    counts = velocity.daily_count(cards, "card", "t")
    return layout.entity_lines(velocity.entity_profile(known, "card", "t", "amt", "dist"), counts, "card")


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_bucketed_rows_and_lines_join_in_place(spark, cards, lines, threshold):
    """No exchange below the join, small or large; the same columns as by the shuffled join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows, stored = layout.write_bucketed(cards, ["card"], 4), layout.write_bucketed(lines, ["card"], 4)
        joined = layout.with_bucketed_state(rows, stored, "card", "t", rows_as="card_freq")
        assert "Exchange" not in executed(joined) and "SortMergeJoin" in executed(joined)
        profile = lines.drop("_days")
        counts = velocity.daily_count(cards, "card", "t").join(profile.select("card"), "card", "left_semi")
        plain = velocity.with_entity_state(cards, profile, "card", "t", counts=counts, rows_as="card_freq")
        plain = plain.select(*joined.columns)
        assert joined.count() == 1500
        assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_without_rows(spark, cards, lines):
    rows, stored = layout.write_bucketed(cards.limit(0), ["card"], 3), layout.write_bucketed(lines, ["card"], 3)
    assert layout.with_bucketed_state(rows, stored, "card", "t").count() == 0
    rows, stored = layout.write_bucketed(cards, ["card"], 3), layout.write_bucketed(lines.limit(0), ["card"], 3)
    found = layout.with_bucketed_state(rows, stored, "card", "t")
    assert found.where("user_mean_amt = 0 and user_std_amt = 1 and daily_txn_count is null").count() == 1500


# --- file order ------------------------------------------------------------------------------


@pytest.fixture
def small_blocks(spark):
    """Files are cut into many blocks, and a task reads several of them."""
    settings = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_csv_rows_keep_their_order(spark, tmp_path, small_blocks):
    """Files whose names order them, cut into blocks; one is empty, one has a single row."""
    schema, at = "a long, _row string, _file int", 0
    for name, n in (("a", 900), ("b", 0), ("c", 1), ("d", 1500)):
        lines = [f"{at + i},r{(at + i) % 7},{i}" for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["a,_row,_file", *lines]) + "\n")
        at += n
    path = str(tmp_path)
    found = tables.read_csv(spark, path, schema, position="pos")
    assert found.columns == ["a", "_row", "_file", "pos"]
    assert spark.read.schema(schema).option("header", True).csv(path).rdd.getNumPartitions() > 4
    assert sorted((r["pos"], r["a"]) for r in found.collect()) == [(i, i) for i in range(at)]


def test_parquet_rows_keep_their_order(spark, tmp_path, small_blocks):
    df = spark.range(0, 4000, 1, 6).withColumn("text", F.repeat(F.lit("x"), 20))
    df.write.option("parquet.block.size", 2048).parquet(str(tmp_path / "p"))
    found = layout.with_file_position(spark.read.parquet(str(tmp_path / "p")).where("id % 3 <> 1").select("id"))
    assert found.columns == ["id", "pos"]
    want = [i for i in range(4000) if i % 3 != 1]
    assert sorted((r["pos"], r["id"]) for r in found.collect()) == list(enumerate(want))


def test_no_rows(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "e"))
    assert layout.with_file_position(spark.read.parquet(str(tmp_path / "e"))).count() == 0
