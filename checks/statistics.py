"""Scans, statistics, joins and row features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import txn as b
from checks.registry import query, rounded
from checks.txn import COLS, known, table, txn, txn_nulls
from riskloom.functions import calendar, scores as fs
from riskloom.operators import encoding, lookup, moments, ordering, quality, velocity
from riskloom.plans import enrich, features
from riskloom.schema import txn_schema
from riskloom.session import shared_folder, stage
from riskloom.sources import profiles, tables


def scratch(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


ALL_TXN = "SELECT * FROM txn"


@query("scan_typed", b.sql(ALL_TXN))
def scan_typed(spark, sf_dir):
    path = scratch(spark, "csv")
    schema = txn_schema(COLS)
    tables.write_table(txn(spark, sf_dir).select(*schema.fieldNames()), path, "csv")
    return tables.read_csv(spark, path, schema)


@query("scan_drop_index", b.sql("SELECT * EXCLUDE (pos) FROM txn"))
def scan_drop_index(spark, sf_dir):
    """The first column is a row number, not data."""
    path = scratch(spark, "csv")
    schema = txn_schema(COLS)
    tables.write_table(txn(spark, sf_dir).select(*schema.fieldNames()), path, "csv")
    return tables.read_csv(spark, path, schema, drop=[COLS.row_id])


@query(
    "write_table",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def write_table(spark, sf_dir):
    path = scratch(spark, "table")
    tables.write_table(table(spark, sf_dir, "events").drop("props", "ts"), path, "csv")
    back = tables.read_csv_inferred(spark, path)
    return back.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "scan_inferred",
    """SELECT *, 'int,timestamp,int,string,double,string' AS kinds FROM events""",
)
def scan_inferred(spark, sf_dir):
    """All columns of a table written and read back without a schema, and the types that were found."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "inferred")
    tables.write_table(events, path, "csv")
    back = tables.read_csv_inferred(spark, path)
    kinds = ",".join(kind for _, kind in back.dtypes)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in events.schema.fields], F.lit(kinds).alias("kinds"))


@query("csv_round_trip", "SELECT * FROM events")
def csv_round_trip(spark, sf_dir):
    """All columns of a table with quotes, commas and times in its fields, written and read back."""
    events = table(spark, sf_dir, "events")
    path = scratch(spark, "events")
    tables.write_table(events, path, "csv")
    return tables.read_csv(spark, path, events.schema)


# --- rows ------------------------------------------------------------------------------------


@query(
    "haversine",
    b.sql("SELECT pos, round(distance_km, 6) AS distance_km FROM txn_dist", b.distance("txn")),
)
def haversine(spark, sf_dir):
    return rounded(enrich.measured(txn(spark, sf_dir), COLS).select("pos", "distance_km"))


@query(
    "time_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS trans_hour, CAST(day(ts) AS INTEGER) AS trans_day,
    CAST(month(ts) AS INTEGER) AS trans_month, CAST(isodow(ts) - 1 AS INTEGER) AS trans_weekday FROM events""",
)
def time_parts(spark, sf_dir):
    parts = calendar.time_parts(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query(
    "weekend_night",
    """SELECT event_id, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(ts) >= 22 OR hour(ts) <= 5 AS INTEGER) AS is_night FROM events""",
)
def weekend_night(spark, sf_dir):
    parts = calendar.weekend_night(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query(
    "age_years",
    b.sql(
        """SELECT pos, CAST(trunc(date_diff('day', dob,
        CAST((SELECT max(trans_date_trans_time) FROM txn) AS DATE)) / CAST(365.25 AS DOUBLE)) AS INTEGER) AS age
        FROM txn"""
    ),
)
def age_years(spark, sf_dir):
    rows = txn(spark, sf_dir)
    age = calendar.age_years(F.col("dob"), features.reference_time(rows, COLS))
    return rows.select("pos", age.alias("age"))


@query("amt_log", "SELECT event_id, round(ln(1 + value), 6) + 0.0 AS amt_log FROM events")
def amt_log(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(events.select("event_id", fs.amount_log(F.col("value")).alias("amt_log")))


@query(
    "interaction",
    b.sql(
        """SELECT t.pos, round(ln(1 + amt) * (CAST(0.3 AS DOUBLE) - (CAST(0.2 AS DOUBLE) - y_prob)), 6) + 0.0
        AS anomaly_weighted_amt FROM txn t JOIN scores s ON t.pos = s.pos"""
    ),
)
def interaction(spark, sf_dir):
    amount = F.col("amt")
    stand_in = F.lit(0.2) - F.round(amount / (amount + 100.0), 3)
    weighted = fs.anomaly_weighted(fs.amount_log(amount), stand_in)
    return rounded(txn(spark, sf_dir).select("pos", weighted.alias("anomaly_weighted_amt")))


@query(
    "threshold_flag",
    b.sql("SELECT pos, y_prob, CASE WHEN y_prob >= 0.6 THEN 1 ELSE 0 END AS flag FROM scores"),
)
def threshold_flag(spark, sf_dir):
    flag = fs.threshold_flag(F.col("y_prob"), 0.6)
    return b.scores(spark, sf_dir).select("pos", "y_prob", flag.alias("flag"))


@query(
    "fill_constant",
    b.sql(
        """SELECT pos, coalesce(amt, 0) AS amt, coalesce(state, 'unknown') AS state FROM txn_nulls"""
    ),
)
def fill_constant(spark, sf_dir):
    rows = txn_nulls(spark, sf_dir).select("pos", "amt", "state")
    return lookup.fill_defaults(rows, {"amt": 0.0, "state": "unknown"})


# --- global statistics -----------------------------------------------------------------------


@query(
    "global_moments",
    b.sql(
        """SELECT round(avg(amt), 6) AS mean_amt, round(stddev_samp(amt), 6) AS std_amt,
        round(avg(distance_km), 6) AS mean_distance_km, round(stddev_samp(distance_km), 6) AS std_distance_km
        FROM txn_dist""",
        b.distance("txn"),
    ),
)
def global_moments(spark, sf_dir):
    return rounded(
        moments.global_moments(enrich.measured(txn(spark, sf_dir), COLS), ["amt", "distance_km"])
    )


@query(
    "global_zscore",
    b.sql(
        """SELECT pos, round((amt - (SELECT avg(amt) FROM txn)) / (SELECT stddev_samp(amt) FROM txn), 6) + 0.0
          AS global_amt_zscore,
        round((distance_km - (SELECT avg(distance_km) FROM txn_dist))
          / (SELECT stddev_samp(distance_km) FROM txn_dist), 6) + 0.0 AS global_dist_zscore
        FROM txn_dist""",
        b.distance("txn"),
    ),
)
def global_zscore(spark, sf_dir):
    rows = enrich.measured(txn(spark, sf_dir), COLS)
    outputs = {"amt": "global_amt_zscore", "distance_km": "global_dist_zscore"}
    return rounded(moments.global_zscores(rows, outputs).select("pos", *outputs.values()))


@query(
    "mean_cov",
    """SELECT round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(l_extendedprice), 6) AS mean_l_extendedprice,
    round(avg(l_discount), 6) AS mean_l_discount,
    round(covar_samp(l_quantity, l_quantity), 6) AS cov_l_quantity_l_quantity,
    round(covar_samp(l_quantity, l_extendedprice), 3) AS cov_l_quantity_l_extendedprice,
    round(covar_samp(l_quantity, l_discount), 6) + 0.0 AS cov_l_quantity_l_discount,
    round(covar_samp(l_extendedprice, l_extendedprice), 0) AS cov_l_extendedprice_l_extendedprice,
    round(covar_samp(l_extendedprice, l_discount), 3) + 0.0 AS cov_l_extendedprice_l_discount,
    round(covar_samp(l_discount, l_discount), 6) AS cov_l_discount_l_discount FROM lineitem""",
)
def mean_cov(spark, sf_dir):
    out = moments.mean_cov(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )
    # large magnitudes keep fewer decimals
    fewer = {
        "cov_l_quantity_l_extendedprice": 3,
        "cov_l_extendedprice_l_discount": 3,
        "cov_l_extendedprice_l_extendedprice": 0,
    }
    for name, digits in fewer.items():
        out = rounded(out, name, digits=digits)
    return rounded(out, *[c for c in out.columns if c not in fewer])


@query(
    "mahalanobis",
    b.sql(
        "SELECT pos, round(mahalanobis_dist, 6) + 0.0 AS mahalanobis_dist FROM mahal",
        b.distance("txn"),
        b.daily("txn"),
        b.mahalanobis("txn_daily", "txn_daily", "mahal"),
    ),
)
def mahalanobis(spark, sf_dir):
    rows = velocity.with_daily_count(enrich.measured(txn(spark, sf_dir), COLS), COLS.entity, COLS.time)
    columns = enrich.distance_columns(COLS)
    center, inverse = enrich.fit_mahalanobis(rows, columns)
    scored = enrich.with_mahalanobis(rows, columns, center, inverse)
    return rounded(scored.select("pos", "mahalanobis_dist"))


@query(
    "quantile_exact",
    """SELECT c AS "column", p, round(v, 6) AS value FROM (
      SELECT 'l_extendedprice' AS c, 0.25::DOUBLE AS p, quantile_cont(l_extendedprice, 0.25) AS v FROM lineitem
      UNION ALL SELECT 'l_extendedprice', 0.75, quantile_cont(l_extendedprice, 0.75) FROM lineitem
      UNION ALL SELECT 'l_extendedprice', 0.99, quantile_cont(l_extendedprice, 0.99) FROM lineitem
      UNION ALL SELECT 'l_quantity', 0.5, quantile_cont(l_quantity, 0.5) FROM lineitem)""",
)
def quantile_exact(spark, sf_dir):
    wanted = {"l_extendedprice": [0.25, 0.75, 0.99], "l_quantity": [0.5]}
    return rounded(ordering.quantile_table(table(spark, sf_dir, "lineitem"), wanted), "value")


@query(
    "iqr_outliers",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
    o AS (SELECT q1, q3, count(*) FILTER (WHERE value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)) AS outliers,
      count(*) AS n FROM events CROSS JOIN q GROUP BY q1, q3)
    SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, outliers, round(100.0 * outliers / n, 2) AS pct FROM o""",
)
def iqr_outliers(spark, sf_dir):
    return rounded(quality.iqr_outliers(table(spark, sf_dir, "events"), "value"), "q1", "q3")


@query(
    "min_max",
    """SELECT min(ts) AS min_ts, max(ts) AS max_ts, min(value) AS min_value, max(value) AS max_value FROM events""",
)
def min_max(spark, sf_dir):
    return quality.min_max(table(spark, sf_dir, "events"), ["ts", "value"])


DESCRIBED = {
    "lineitem": [
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    ]
}


def _describe_sql(source: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", count({n}) AS count, round(avg({n}), 6) AS mean,
        round(stddev_samp({n}), 6) AS std, CAST(min({n}) AS DOUBLE) AS min, round(quantile_cont({n}, 0.25), 6) AS q25,
        round(quantile_cont({n}, 0.5), 6) AS q50, round(quantile_cont({n}, 0.75), 6) AS q75,
        CAST(max({n}) AS DOUBLE) AS max FROM {source}"""
        for n in names
    )


@query("describe", _describe_sql("lineitem", DESCRIBED["lineitem"]))
def describe(spark, sf_dir):
    out = quality.describe(table(spark, sf_dir, "lineitem"))
    return rounded(out, "mean", "std", "q25", "q50", "q75")


# --- velocity and profiles -------------------------------------------------------------------


@query(
    "daily_count",
    """SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS daily_txn_count FROM events GROUP BY 1, 2""",
)
def daily_count(spark, sf_dir):
    return velocity.daily_count(table(spark, sf_dir, "events"), "user_id", "ts")


@query(
    "velocity_join",
    """SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS daily_txn_count
    FROM events""",
)
def velocity_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return velocity.with_daily_count(events, "user_id", "ts").drop("ts")


# a mean of cents over 64 rows has 8 decimals; fewer digits would round ties
MEANS = ("user_mean_amt", "user_mean_velocity")
OTHERS = tuple(c for c in velocity.PROFILE_COLUMNS if c not in MEANS)
PROFILE_SQL = ", ".join(f"round({c}, {9 if c in MEANS else 6}) + 0.0 AS {c}" for c in velocity.PROFILE_COLUMNS)


def rounded_profile(df):
    return rounded(rounded(df, *MEANS, digits=9), *OTHERS)


@query(
    "entity_profile",
    b.sql(
        f"SELECT cc_num, {PROFILE_SQL}, entity_rows FROM txn_profile",
        b.distance("txn"),
        b.daily("txn"),
        b.profile("txn"),
    ),
)
def entity_profile(spark, sf_dir):
    return rounded_profile(enrich.fit_entities(txn(spark, sf_dir), COLS))


@query(
    "profile_join",
    b.sql(
        f"SELECT pos, {PROFILE_SQL} FROM txn_profiled",
        b.distance("txn"),
        b.daily("txn"),
        b.distance("known"),
        b.daily("known"),
        b.profile("known"),
        b.profiled("txn", "known"),
    ),
)
def profile_join(spark, sf_dir):
    rows = txn(spark, sf_dir)
    profile = stage(enrich.fit_entities(known(rows), COLS), "profile")
    joined = velocity.join_profile(rows.select("pos", "cc_num"), profile, "cc_num")
    return rounded_profile(joined.drop("cc_num"))


ZSCORES = ("user_amt_zscore", "user_dist_zscore", "user_velocity_zscore")


@query(
    "safe_zscore",
    b.sql(
        f"""SELECT pos, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ZSCORES)} FROM txn_profiled""",
        b.distance("txn"),
        b.daily("txn"),
        b.profile("txn"),
        b.profiled("txn", "txn"),
    ),
)
def safe_zscore(spark, sf_dir):
    rows = txn(spark, sf_dir)
    scored = enrich.entity_scores(rows, COLS, enrich.fit_entities(rows, COLS))
    return rounded(scored.select("pos", *ZSCORES))


STAGE1 = ("distance_km", *ZSCORES, "global_amt_zscore", "global_dist_zscore", "mahalanobis_dist")


def stage1_sql(fit: str) -> str:
    """Scores of all transactions from statistics fitted on ``fit``."""
    parts = [b.distance("txn"), b.daily("txn")]
    if fit != "txn":
        parts += [b.distance(fit), b.daily(fit)]
    parts += [b.profile(fit), b.profiled("txn", fit)]
    parts.append(b.mahalanobis("txn_profiled", f"{fit}_daily", "mahal"))
    if fit == "txn":
        cut = "(SELECT quantile_cont(mahalanobis_dist, 0.99) FROM mahal)"
    else:
        parts.append(b.mahalanobis(f"{fit}_daily", f"{fit}_daily", "fitted"))
        cut = "(SELECT quantile_cont(mahalanobis_dist, 0.99) FROM fitted)"
    select = f"""SELECT pos, daily_txn_count, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in STAGE1)},
      CASE WHEN abs(global_amt_zscore) > 3 OR abs(global_dist_zscore) > 3 OR abs(user_amt_zscore) > 3
        OR mahalanobis_dist > {cut} THEN 1 ELSE 0 END AS classical_outlier_flag
    FROM (SELECT *, (amt - ma) / sa AS global_amt_zscore, (distance_km - mb) / sb AS global_dist_zscore
          FROM mahal)"""
    return b.sql(select, *parts)


def stage1(rows, fitted_on):
    overall, entities, _ = enrich.fit_stage1(fitted_on, COLS)
    scored = enrich.stage1_score(rows, COLS, overall, entities)
    return rounded(scored.select("pos", "daily_txn_count", *STAGE1, "classical_outlier_flag"))


@query("outlier_flag", stage1_sql("txn"))
def outlier_flag(spark, sf_dir):
    rows = txn(spark, sf_dir)
    return stage1(rows, rows)


@query("stage1_score", stage1_sql("known"))
def stage1_score(spark, sf_dir):
    rows = txn(spark, sf_dir)
    return stage1(rows, known(rows))


# --- codes -----------------------------------------------------------------------------------


def code_sql(source: str, column: str) -> str:
    return f"""{source}_{column}_codes AS (
      SELECT {column} AS value, row_number() OVER (ORDER BY min(pos)) - 1 AS code, count(*) AS freq
      FROM {source} GROUP BY {column})"""


@query(
    "label_codes",
    b.sql("SELECT value, code FROM txn_nulls_state_codes", code_sql("txn_nulls", "state")),
)
def label_codes(spark, sf_dir):
    return encoding.label_codes(txn_nulls(spark, sf_dir), "state", "pos")


@query(
    "value_counts",
    b.sql(
        """SELECT state AS value, count(*) AS count, round(100.0 * count(*) /
        (SELECT count(state) FROM txn_nulls), 2) AS pct FROM txn_nulls WHERE state IS NOT NULL GROUP BY state"""
    ),
)
def value_counts(spark, sf_dir):
    return quality.value_shares(txn_nulls(spark, sf_dir), "state")


@query(
    "label_lookup",
    b.sql(
        """SELECT t.pos, coalesce(c.code, -1) AS category, coalesce(s.code, -1) AS state FROM txn t
        LEFT JOIN known_category_codes c ON t.category = c.value
        LEFT JOIN known_state_codes s ON t.state = s.value""",
        code_sql("known", "category"),
        code_sql("known", "state"),
    ),
)
def label_lookup(spark, sf_dir):
    rows = txn(spark, sf_dir)
    codes = encoding.code_map(known(rows), ["category", "state"], [], "pos")
    labels = {"category": "category", "state": "state"}
    return encoding.apply_codes(rows.select("pos", *labels), codes, labels, {})


@query(
    "freq_lookup",
    b.sql(
        """SELECT t.pos, coalesce(m.freq, 0) AS merchant_freq, coalesce(j.freq, 0) AS job_freq,
        coalesce(c.freq, 0) AS cc_num_freq FROM txn t
        LEFT JOIN known_merchant_codes m ON t.merchant = m.value
        LEFT JOIN known_job_codes j ON t.job = j.value
        LEFT JOIN known_cc_num_codes c ON t.cc_num = c.value""",
        code_sql("known", "merchant"),
        code_sql("known", "job"),
        code_sql("known", "cc_num"),
    ),
)
def freq_lookup(spark, sf_dir):
    rows = txn(spark, sf_dir)
    names = ["merchant", "job", "cc_num"]
    codes = encoding.code_map(known(rows), [], names, "pos")
    found = encoding.apply_codes(
        rows.select("pos", *names), codes, {}, {n: f"{n}_freq" for n in names}
    )
    return found.drop(*names)


@query(
    "profile_store",
    b.sql(
        f"""SELECT cc_num, {PROFILE_SQL}, entity_rows, freq, round(ma, 6) AS mean_amt, round(sb, 6) AS std_dist
        FROM known_profile p JOIN known_cc_num_codes c ON p.cc_num = c.value CROSS JOIN mahal_m""",
        b.distance("known"),
        b.daily("known"),
        b.profile("known"),
        b.mahalanobis("known_daily", "known_daily", "mahal"),
        code_sql("known", "cc_num"),
    ),
)
def profile_store(spark, sf_dir):
    """Fit, save, load; every card's profile with its frequency and two global statistics."""
    rows = known(txn(spark, sf_dir))
    overall, entities, _ = enrich.fit_stage1(rows, COLS)
    path = scratch(spark, "profiles")
    profiles.Profiles(overall, entities, features.fit_codes(rows, COLS)).save(path)
    back = profiles.Profiles.load(spark, path)
    freq = back.codes.where("column = 'cc_num'").select(
        F.col("value").cast("bigint").alias("cc_num"), "freq"
    )
    overall = {"mean_amt": F.lit(back.overall.mean_amt), "std_dist": F.lit(back.overall.std_dist)}
    joined = rounded_profile(back.entities.join(freq, "cc_num").withColumns(overall))
    return rounded(joined, *overall)
