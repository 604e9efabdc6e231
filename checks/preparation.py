"""Data quality, order, splits, duplicates and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import txn as b
from checks.registry import query, rounded
from checks.statistics import scratch
from checks.txn import COLS, table, txn, txn_nulls, txn_twice
from riskloom.operators import ordering, quality
from riskloom.plans import features
from riskloom.sources import tables

# --- nulls -----------------------------------------------------------------------------------


@query(
    "null_profile",
    """WITH d AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    u AS (SELECT 'quality' AS c, count(*) - count(quality) AS nulls, count(*) AS n FROM d
      UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM d
      UNION ALL SELECT 'doc_id', count(*) - count(doc_id), count(*) FROM d
      UNION ALL SELECT 'text', count(*) - count(text), count(*) FROM d
      UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM d
      UNION ALL SELECT 'lang', count(*) - count(lang), count(*) FROM d
      UNION ALL SELECT 'source', count(*) - count(source), count(*) FROM d)
    SELECT c AS "column", nulls, round(100.0 * nulls / n, 2) AS pct FROM u WHERE nulls > 0""",
)
def null_profile(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.null_profile(documents.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


@query(
    "null_total",
    b.sql("SELECT count(*) * 2 - count(amt) - count(state) AS nulls FROM txn_nulls"),
)
def null_total(spark, sf_dir):
    return quality.null_total(txn_nulls(spark, sf_dir))


@query(
    "impute_median",
    b.sql("SELECT * REPLACE (coalesce(amt, (SELECT median(amt) FROM txn_nulls)) AS amt) FROM txn_nulls"),
)
def impute_median(spark, sf_dir):
    """All numeric columns of the whole table."""
    return quality.impute_median(txn_nulls(spark, sf_dir))


@query(
    "impute_mode",
    b.sql(
        """SELECT * REPLACE (coalesce(state, (SELECT state FROM txn_nulls WHERE state IS NOT NULL
        GROUP BY state ORDER BY count(*) DESC, state LIMIT 1)) AS state) FROM txn_nulls"""
    ),
)
def impute_mode(spark, sf_dir):
    """All text columns of the whole table."""
    return quality.impute_mode(txn_nulls(spark, sf_dir))


# --- order -----------------------------------------------------------------------------------


@query(
    "time_order",
    "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS place FROM events",
)
def time_order(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return ordering.global_position(events, ["ts", "event_id"], "place")


@query("head_n", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 3")
def head_n(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return ordering.head_n(events, ["ts", "event_id"], 3)


SPLIT_SQL = b.sql(
    """SELECT pos, is_fraud, CASE WHEN place < CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) THEN 'train'
      WHEN place < CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY trans_date_trans_time, pos) - 1 AS place,
      count(*) OVER () AS n FROM txn)"""
)


@query("time_split", SPLIT_SQL)
def time_split(spark, sf_dir):
    """Split, store one folder per split, read back."""
    split = ordering.time_split(txn(spark, sf_dir), COLS.time, "pos").select("pos", "is_fraud", "split")
    path = scratch(spark, "splits")
    tables.write_splits(split, path)
    return tables.read_splits(spark, path)


@query(
    "class_balance",
    f"""SELECT split, count(*) AS total, count(*) FILTER (WHERE is_fraud = 0) AS legit,
      count(*) FILTER (WHERE is_fraud = 1) AS fraud,
      round(100.0 * count(*) FILTER (WHERE is_fraud = 0) / count(*), 2) AS legit_pct,
      round(100.0 * count(*) FILTER (WHERE is_fraud = 1) / count(*), 2) AS fraud_pct,
      count(*) FILTER (WHERE is_fraud = 0) // count(*) FILTER (WHERE is_fraud = 1) AS imbalance_ratio
    FROM ({SPLIT_SQL}) GROUP BY split""",
)
def class_balance(spark, sf_dir):
    split = ordering.time_split(txn(spark, sf_dir), COLS.time, "pos")
    return quality.class_counts(split, "is_fraud", ["split"])


@query(
    "class_weight",
    f"""SELECT 'class_weight' AS name, round(CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE)
      / count(*) FILTER (WHERE is_fraud = 1), 6) AS value FROM ({SPLIT_SQL}) WHERE split = 'train'""",
)
def class_weight(spark, sf_dir):
    """Weight of the train split, stored as a one-row table and read back."""
    split = ordering.time_split(txn(spark, sf_dir), COLS.time, "pos")
    path = scratch(spark, "weight")
    tables.write_scalar(quality.class_weight(split.where("split = 'train'"), "is_fraud"), path)
    return rounded(spark.read.parquet(path), "value")


SAMPLED = 3000


@query(
    "sample_n",
    f"""SELECT event_id, value FROM events
    ORDER BY md5(CAST(event_id AS VARCHAR) || '-42'), event_id LIMIT {SAMPLED}""",
)
def sample_n(spark, sf_dir):
    return ordering.sample_n(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", SAMPLED)


# --- duplicates ------------------------------------------------------------------------------


@query(
    "repeat_counts",
    """SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows,
    (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
      AS duplicate_keys""",
)
def repeat_counts(spark, sf_dir):
    return quality.repeat_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedup_rows", b.sql("SELECT * FROM txn_nulls"))
def dedup_rows(spark, sf_dir):
    """Every row is there twice; the first copy stays."""
    return quality.dedup_rows(txn_twice(spark, sf_dir), "pos")


@query(
    "dedup_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_key(spark, sf_dir):
    """The earliest shipped line of each key, by all columns on ties."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    order += ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    lineitem = table(spark, sf_dir, "lineitem")
    return quality.dedup_key(lineitem, ["l_orderkey", "l_linenumber"], order)


# --- feature table ---------------------------------------------------------------------------

FEATURES_SQL = b.sql(
    """SELECT trans_num, trans_date_trans_time, is_fraud, round(amt, 6) AS amt,
      CAST(c.code AS BIGINT) AS category, CAST(s.code AS BIGINT) AS state,
      CASE gender WHEN 'M' THEN 1 ELSE 0 END AS gender, lat, long_, merch_lat, merch_long, city_pop,
      round(distance_km, 6) AS distance_km,
      CAST(hour(trans_date_trans_time) AS INTEGER) AS trans_hour,
      CAST(day(trans_date_trans_time) AS INTEGER) AS trans_day,
      CAST(month(trans_date_trans_time) AS INTEGER) AS trans_month,
      CAST(isodow(trans_date_trans_time) - 1 AS INTEGER) AS trans_weekday,
      CAST(isodow(trans_date_trans_time) >= 6 AS INTEGER) AS is_weekend,
      CAST(hour(trans_date_trans_time) >= 22 OR hour(trans_date_trans_time) <= 5 AS INTEGER) AS is_night,
      CAST(trunc(date_diff('day', dob, CAST((SELECT max(trans_date_trans_time) FROM txn) AS DATE))
        / CAST(365.25 AS DOUBLE)) AS INTEGER) AS age,
      round(ln(1 + amt), 6) AS amt_log,
      count(*) OVER (PARTITION BY merchant) AS merchant_freq, count(*) OVER (PARTITION BY job) AS job_freq,
      count(*) OVER (PARTITION BY cc_num) AS cc_num_freq
    FROM cleaned_dist t JOIN codes_category c ON t.category = c.value JOIN codes_state s ON t.state = s.value""",
    """cleaned AS (SELECT * REPLACE (coalesce(amt, (SELECT median(amt) FROM txn_nulls)) AS amt,
      coalesce(state, (SELECT state FROM txn_nulls WHERE state IS NOT NULL
        GROUP BY state ORDER BY count(*) DESC, state LIMIT 1)) AS state) FROM txn_nulls)""",
    b.distance("cleaned"),
    """codes_category AS (SELECT category AS value, row_number() OVER
      (ORDER BY min(trans_date_trans_time)) - 1 AS code FROM cleaned GROUP BY category)""",
    """codes_state AS (SELECT state AS value, row_number() OVER
      (ORDER BY min(trans_date_trans_time)) - 1 AS code FROM cleaned GROUP BY state)""",
)


@query("feature_table", FEATURES_SQL)
def feature_table(spark, sf_dir):
    """Rows with nulls, each twice, become one clean numeric row each."""
    constants = {n: F.lit("x") for n in COLS.unused}
    raw = txn_twice(spark, sf_dir).withColumns(constants)
    return rounded(features.feature_table(raw, COLS), "amt", "distance_km", "amt_log")
