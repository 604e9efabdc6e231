"""Transactions bound to the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.schema import TxnColumns

COLS = TxnColumns(lon="long_")
FIT_BEFORE = "2024-01-22 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tenth(number: Column, by: int = 10) -> Column:
    return number.cast("double") / F.lit(float(by))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card transaction per event; the card holder's segment and nation are job and state."""
    events, customer, nation = (table(spark, sf_dir, n) for n in ("events", "customer", "nation"))
    user, hour = F.col("user_id"), F.hour("ts")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    joined = (
        events.join(customer, events["user_id"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .withColumn("k", k)
    )
    lat, lon = F.lit(-60.0) + _tenth(user * 37 % 1200), F.lit(-180.0) + _tenth(user * 73 % 3600)
    at_night = (hour >= 22) | (hour <= 5)
    fraud = ((F.col("value") > 120) & at_night) | (F.col("event_id") % 997 == 0)
    return joined.select(
        F.col("event_id").alias("pos"),
        F.col("event_id").cast("string").alias("trans_num"),
        F.col("ts").alias("trans_date_trans_time"),
        user.alias("cc_num"),
        F.col("value").alias("amt"),
        F.concat(F.lit("m"), F.col("k").cast("string")).alias("merchant"),
        F.col("c_mktsegment").alias("job"),
        F.col("event_type").alias("category"),
        F.col("n_name").alias("state"),
        F.when(user % 2 == 0, "M").otherwise("F").alias("gender"),
        lat.alias("lat"),
        lon.alias("long_"),
        (lat + _tenth(F.col("k") * 13 % 200 - 100, 100)).alias("merch_lat"),
        (lon + _tenth(F.col("k") * 29 % 200 - 100, 100)).alias("merch_long"),
        (1000 + user * 7919 % 100000).cast("int").alias("city_pop"),
        F.date_add(F.lit("1950-01-01").cast("date"), (user * 97 % 18000).cast("int")).alias("dob"),
        fraud.cast("int").alias("is_fraud"),
    )


def txn_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount and state are unknown for one merchant each."""
    return txn(spark, sf_dir).withColumns(
        {
            "amt": F.when(F.col("merchant") != "m7", F.col("amt")),
            "state": F.when(F.col("merchant") != "m11", F.col("state")),
        }
    )


def txn_twice(spark: SparkSession, sf_dir: str, extra: float = 0.0) -> DataFrame:
    """Every row again at a later position, with ``extra`` on the amount."""
    once = txn_nulls(spark, sf_dir)
    again = once.withColumns({"pos": F.col("pos") + 1000000000, "amt": F.col("amt") + F.lit(extra)})
    return once.unionByName(again)


def known(df: DataFrame) -> DataFrame:
    """Rows of the past, before one state, category and merchant joined."""
    return df.where(
        (F.col("trans_date_trans_time") < F.lit(FIT_BEFORE).cast("timestamp_ntz"))
        & (F.col("state") != "NATION_10")
        & (F.col("category") != "signup")
        & (F.col("merchant") != "m13")
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in predictions: a monotone function of the amount, with many ties."""
    amount = F.col("amt")
    return txn(spark, sf_dir).select(
        "pos",
        F.col("is_fraud").alias("y_true"),
        F.round(amount / (amount + 100.0), 3).alias("y_prob"),
    )


def staged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in margins of twelve rounds: later rounds weigh the night more."""
    night = F.hour("trans_date_trans_time")
    night = ((night >= 22) | (night <= 5)).cast("int")
    amount = F.col("amt")
    margin = F.round(amount / (amount + 100.0) - 0.6, 3) + F.round(0.08 * F.col("round") * night, 2)
    return (
        txn(spark, sf_dir)
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(11))))
        .select(
            F.col("is_fraud").alias("y"),
            "round",
            F.when(F.col("trans_date_trans_time") < F.lit(FIT_BEFORE).cast("timestamp_ntz"), "train")
            .otherwise("val")
            .alias("part"),
            F.round(margin, 3).alias("margin"),
        )
    )


BASE = f"""
WITH base AS (
  SELECT e.*, c.c_mktsegment, n.n_name,
         CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
txn AS (
  SELECT event_id AS pos, CAST(event_id AS VARCHAR) AS trans_num, ts AS trans_date_trans_time,
    user_id AS cc_num, value AS amt, 'm' || CAST(k AS VARCHAR) AS merchant, c_mktsegment AS job,
    event_type AS category, n_name AS state,
    CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    CAST(-60 AS DOUBLE) + CAST((user_id * 37) % 1200 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat,
    CAST(-180 AS DOUBLE) + CAST((user_id * 73) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) AS long_,
    CAST(-60 AS DOUBLE) + CAST((user_id * 37) % 1200 AS DOUBLE) / CAST(10 AS DOUBLE)
      + CAST((k * 13) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_lat,
    CAST(-180 AS DOUBLE) + CAST((user_id * 73) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE)
      + CAST((k * 29) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_long,
    CAST(1000 + (user_id * 7919) % 100000 AS INTEGER) AS city_pop,
    CAST(DATE '1950-01-01' + CAST((user_id * 97) % 18000 AS INTEGER) AS DATE) AS dob,
    CASE WHEN (value > 120 AND (hour(ts) >= 22 OR hour(ts) <= 5)) OR event_id % 997 = 0
         THEN 1 ELSE 0 END AS is_fraud
  FROM base
),
txn_nulls AS (
  SELECT * REPLACE (CASE WHEN merchant <> 'm7' THEN amt END AS amt,
                    CASE WHEN merchant <> 'm11' THEN state END AS state)
  FROM txn
),
known AS (
  SELECT * FROM txn
  WHERE trans_date_trans_time < TIMESTAMP '{FIT_BEFORE}' AND state <> 'NATION_10'
    AND category <> 'signup' AND merchant <> 'm13'
),
scores AS (
  SELECT pos, is_fraud AS y_true, round(amt / (amt + 100.0), 3) AS y_prob FROM txn
)
"""


def sql(select: str, *extra: str) -> str:
    """A query over the bound tables, with further common table expressions."""
    return ",\n".join([BASE.strip(), *[e.strip() for e in extra]]) + "\n" + select.strip()


def distance(source: str) -> str:
    """``source`` with the great-circle distance in km."""
    half_lat = "sin(radians(merch_lat - lat) / 2)"
    half_lon = "sin(radians(merch_long - long_) / 2)"
    chord = f"{half_lat} * {half_lat} + cos(radians(lat)) * cos(radians(merch_lat)) * {half_lon} * {half_lon}"
    return f"{source}_dist AS (SELECT *, 2 * 6371.0 * asin(sqrt(least({chord}, 1.0))) AS distance_km FROM {source})"


def daily(source: str) -> str:
    return f"""{source}_daily AS (
  SELECT *, count(*) OVER (PARTITION BY cc_num, CAST(trans_date_trans_time AS DATE)) AS daily_txn_count
  FROM {source}_dist)"""


def profile(source: str) -> str:
    return f"""{source}_profile AS (
  SELECT cc_num, avg(amt) AS user_mean_amt, coalesce(stddev_samp(amt), 1) AS user_std_amt,
    avg(distance_km) AS user_mean_dist, coalesce(stddev_samp(distance_km), 1) AS user_std_dist,
    avg(daily_txn_count) AS user_mean_velocity,
    coalesce(stddev_samp(daily_txn_count), 1) AS user_std_velocity, count(*) AS entity_rows
  FROM {source}_daily GROUP BY cc_num)"""


def profiled(source: str, profile_of: str) -> str:
    """``source`` with profiles, defaults for unseen cards and entity z-scores."""
    profiled = ", ".join(
        f"coalesce(p.user_{s}_{k}, {d}) AS user_{s}_{k}"
        for k in ("amt", "dist", "velocity")
        for s, d in (("mean", 0), ("std", 1))
    )
    z = ", ".join(
        f"CASE WHEN user_std_{k} = 0 THEN 0 ELSE ({c} - user_mean_{k}) / user_std_{k} END AS user_{k}_zscore"
        for k, c in (("amt", "amt"), ("dist", "distance_km"), ("velocity", "daily_txn_count"))
    )
    return f"""{source}_profiled AS (
  SELECT *, {z} FROM (
    SELECT t.*, {profiled} FROM {source}_daily t LEFT JOIN {profile_of}_profile p ON t.cc_num = p.cc_num))"""


def mahalanobis(source: str, moments_of: str, row: str) -> str:
    """Means, covariances, the 3x3 inverse by cofactors, and the distance of ``source`` rows."""
    return f"""{row}_m AS (
  SELECT avg(amt) AS ma, avg(distance_km) AS mb, avg(daily_txn_count) AS mc,
    stddev_samp(amt) AS sa, stddev_samp(distance_km) AS sb,
    covar_samp(amt, amt) AS aa, covar_samp(amt, distance_km) AS ab,
    covar_samp(amt, daily_txn_count) AS ac, covar_samp(distance_km, distance_km) AS bb,
    covar_samp(distance_km, daily_txn_count) AS bc,
    covar_samp(daily_txn_count, daily_txn_count) AS cc
  FROM {moments_of}),
{row}_i AS (
  SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
  FROM {row}_m),
{row} AS (
  SELECT *, sqrt((
      (bb * cc - bc * bc) * xa * xa + (aa * cc - ac * ac) * xb * xb + (aa * bb - ab * ab) * xc * xc
      + 2 * (ac * bc - ab * cc) * xa * xb + 2 * (ab * bc - ac * bb) * xa * xc
      + 2 * (ab * ac - aa * bc) * xb * xc) / det) AS mahalanobis_dist
  FROM (SELECT t.*, i.*, amt - ma AS xa, distance_km - mb AS xb, daily_txn_count - mc AS xc
        FROM {source} t CROSS JOIN {row}_i i))"""
