"""Daily event counts and per-entity profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.scores import safe_zscore
from riskloom.operators.lookup import fill_defaults, lookup, spread_lookup

COUNT = "daily_txn_count"
PROFILE_MEANS = ("user_mean_amt", "user_mean_dist", "user_mean_velocity")
PROFILE_STDS = ("user_std_amt", "user_std_dist", "user_std_velocity")
PROFILE_COLUMNS = (
    "user_mean_amt",
    "user_std_amt",
    "user_mean_dist",
    "user_std_dist",
    "user_mean_velocity",
    "user_std_velocity",
)


PROFILE_ROWS = "entity_rows"


def daily_count(
    df: DataFrame, entity: str, time: str, day: str = "date", out: str = COUNT
) -> DataFrame:
    """Rows per (entity, day), counted in the map tasks before the shuffle."""
    return df.groupBy(entity, F.to_date(time).alias(day)).agg(F.count("*").alias(out))


def with_daily_count(df: DataFrame, entity: str, time: str, out: str = COUNT) -> DataFrame:
    """Add to each row how many rows its entity has on its day."""
    counts = daily_count(df, entity, time, "_day", out)
    dated = df.withColumn("_day", F.to_date(time))
    return spread_lookup(dated, counts, [entity, "_day"], [out], weight=out).drop("_day")


def velocity_profile(counts: DataFrame, entity: str, out: str = COUNT) -> DataFrame:
    """Row-weighted mean and sample deviation of the daily count, from the counts alone.

    A day with n rows weighs n, as if the count were repeated on each of its rows.
    """
    per_entity = Window.partitionBy(entity)
    n = F.col(out).cast("double")
    mean = F.sum(n * n).over(per_entity) / F.sum(n).over(per_entity)
    rows = F.sum(n)
    return (
        counts.withColumn("_mean", mean)
        .groupBy(entity)
        .agg(
            F.max("_mean").alias("user_mean_velocity"),
            F.sqrt(F.try_divide(F.sum(n * (n - F.col("_mean")) * (n - F.col("_mean"))), rows - 1)).alias(
                "user_std_velocity"
            ),
        )
    )


def entity_profile(
    df: DataFrame,
    entity: str,
    time: str,
    amount: str,
    distance: str,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Mean and sample deviation of amount, distance and daily count per entity, and its rows.

    Reads the table twice with few columns instead of joining the counts back to the rows:
    both aggregations shrink to keys in the map tasks.  ``counts`` are the daily counts if they
    are stored already.  A null deviation (one row) becomes 1.
    """
    amounts = df.groupBy(entity).agg(
        F.avg(amount).alias("user_mean_amt"),
        F.stddev_samp(amount).alias("user_std_amt"),
        F.avg(distance).alias("user_mean_dist"),
        F.stddev_samp(distance).alias("user_std_dist"),
        F.count("*").alias(PROFILE_ROWS),
    )
    counts = daily_count(df, entity, time) if counts is None else counts
    # rows without a time have no daily count
    velocity = velocity_profile(counts.where(F.col("date").isNotNull()), entity)
    profile = amounts.join(velocity, entity, "left")
    return fill_defaults(profile, dict.fromkeys(PROFILE_STDS, 1.0)).select(
        entity, *PROFILE_COLUMNS, PROFILE_ROWS
    )


def unseen_defaults(mean: float = 0.0, std: float = 1.0) -> dict[str, float]:
    return {**dict.fromkeys(PROFILE_MEANS, mean), **dict.fromkeys(PROFILE_STDS, std)}


def join_profile(
    df: DataFrame, profile: DataFrame, entity: str, unseen: dict[str, float] | None = None
) -> DataFrame:
    """Add the profile of each row's entity; unseen entities get mean 0 and deviation 1."""
    joined = lookup(df, profile, [entity], PROFILE_COLUMNS)
    return fill_defaults(joined, unseen_defaults() if unseen is None else unseen)


def with_entity_state(
    df: DataFrame,
    profile: DataFrame,
    entity: str,
    time: str,
    unseen: dict[str, float] | None = None,
    counts: DataFrame | None = None,
    rows_as: str | None = None,
) -> DataFrame:
    """Daily count and entity profile in a single join of the rows.

    ``rows_as`` names a further column for the frequency of the entity (unseen 0).  The profile is
    joined to the (entity, day) counts first, so the rows shuffle once, or not at all where Spark
    finds the counts small enough to broadcast.  A row without a time has no daily count; it takes
    its profile from a line per entity without a day.
    """
    counts = daily_count(df, entity, time) if counts is None else counts
    # a day no row has stands for no day, as a join matches no null
    no_day = F.lit("0001-01-01").cast("date")
    counts = counts.select(entity, F.coalesce("date", no_day).alias("_day"), COUNT)
    # such a line weighs as much as its entity, all of whose rows may lack a time
    undated = profile.select(
        entity, no_day.alias("_day"), F.lit(None).cast("long").alias(COUNT), F.col(PROFILE_ROWS).alias("_weight")
    )
    counts = counts.where(F.col("_day") != no_day).withColumn("_weight", F.col(COUNT)).unionByName(undated)
    counts = counts.join(profile, entity, "left")
    values = [COUNT, *PROFILE_COLUMNS]
    if rows_as:
        counts = counts.withColumn(rows_as, F.col(PROFILE_ROWS))
        values.append(rows_as)
    dated = df.withColumn("_day", F.coalesce(F.to_date(time), no_day))
    joined = spread_lookup(dated, counts, [entity, "_day"], values, weight="_weight").drop("_day")
    # after the join, so that rows whose key found no line are filled as well
    joined = fill_defaults(joined, unseen_defaults() if unseen is None else unseen)
    return fill_defaults(joined, {rows_as: 0}) if rows_as else joined


def user_zscores(df: DataFrame, amount: str, distance: str, velocity: str = COUNT) -> DataFrame:
    """z-scores against the joined profile; zero where the deviation is zero."""
    names = {"amt": amount, "dist": distance, "velocity": velocity}
    return df.withColumns(
        {
            f"user_{kind}_zscore": safe_zscore(
                F.col(name), F.col(f"user_mean_{kind}"), F.col(f"user_std_{kind}")
            )
            for kind, name in names.items()
        }
    )


def drop_profile(df: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    return df.drop(*columns)
