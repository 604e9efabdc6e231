"""Statistics that grow with their table: states of parts, stored, merged without the rows behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import txn as b
from checks.registry import query, rounded
from checks.statistics import PROFILE_SQL, rounded_profile, scratch
from checks.txn import COLS, txn
from riskloom.operators import states
from riskloom.operators.velocity import COUNT
from riskloom.plans import enrich
from riskloom.sources.profiles import ProfileStates

DAILY = (b.distance("txn"), b.daily("txn"))


def grown(spark, sf_dir) -> ProfileStates:
    """Two parts' states merged and stored, then a third's, whose days overlap theirs."""
    rows = enrich.measured(txn(spark, sf_dir), COLS)
    path = scratch(spark, "states")
    first, second, third = (ProfileStates.of(rows.where(F.col("pos") % 3 == k), COLS) for k in range(3))
    first.merged(second).save(path)
    return ProfileStates.load(spark, path, COLS).merged(third)


@query("profiles_merged", b.sql(f"SELECT cc_num, {PROFILE_SQL}, entity_rows FROM txn_profile", *DAILY, b.profile("txn")))
def profiles_merged(spark, sf_dir):
    return rounded_profile(grown(spark, sf_dir).entities())


@query(
    "counts_merged",
    "SELECT user_id AS cc_num, CAST(ts AS DATE) AS date, count(*) AS daily_txn_count FROM events GROUP BY ALL",
)
def counts_merged(spark, sf_dir):
    return grown(spark, sf_dir).counts()


NAMES = {"amt": "amt", "distance_km": "dist", COUNT: "count"}


def _moments_sql() -> str:
    names = list(NAMES)
    out = [f"round(avg({n}), 6) AS mean_{NAMES[n]}" for n in names]
    for i, x in enumerate(names):
        out += [f"round(covar_samp({x}, {y}), 6) + 0.0 AS cov_{NAMES[x]}_{NAMES[y]}" for y in names[i:]]
    return f"SELECT {', '.join(out)} FROM txn_daily"


@query("moments_merged", b.sql(_moments_sql(), *DAILY))
def moments_merged(spark, sf_dir):
    return rounded(states.state_mean_cov(grown(spark, sf_dir).states, COLS.entity, list(NAMES.values())))


@query(
    "moments_by_category",
    """SELECT event_type AS category, round(avg(value), 6) AS mean_amt, round(var_samp(value), 6) AS cov_amt_amt,
      round(covar_samp(value, user_id), 6) + 0.0 AS cov_amt_card, round(avg(user_id), 6) AS mean_card,
      round(var_samp(user_id), 6) AS cov_card_card FROM events GROUP BY ALL""",
)
def moments_by_category(spark, sf_dir):
    """States per category of four parts, merged in one go."""
    rows, names = txn(spark, sf_dir), ["amt", "cc_num"]
    parts = [states.moment_state(rows.where(F.col("pos") % 4 == k), names, ["category"]) for k in range(4)]
    merged = states.merge_states(parts, names, ["category"])
    return rounded(states.state_moments(merged, ["amt", "card"], ["category"]))
