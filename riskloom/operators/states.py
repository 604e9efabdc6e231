"""Moments that grow: states per group that merge exactly with those of later rows.

A state holds a count, means, and sums of squared and mixed deviations.  Two states of a group
merge by Chan's update, so statistics of old and new rows together need the states only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from riskloom.operators.lookup import fill_defaults
from riskloom.operators.velocity import COUNT, PROFILE_COLUMNS, PROFILE_ROWS, PROFILE_STDS

DAY = "date"


def _pairs(columns: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]


def moment_state(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``rows``, and per pair i <= j of the columns ``n_i_j, mean_i_j, mean_j_i,
    co_i_j``, over the rows that have both; the state of one column is that of its pair with itself.

    The columns' places stand for their names.  Null group values form a group; NaN is not a number
    to average, so turn it into null first.  Without rows a table without groups has one empty row.
    """
    found = [F.count("*").alias("rows")]
    for i, j in _pairs(columns):
        x, y = (F.col(columns[k]).cast("double") for k in (i, j))
        both = x.isNotNull() & y.isNotNull()
        n = F.count_if(both)
        means = [F.avg(F.when(both, x)).alias(f"mean_{i}_{j}")]
        if i != j:
            means.append(F.avg(F.when(both, y)).alias(f"mean_{j}_{i}"))
        spread = F.covar_pop(x, y) if i != j else F.var_pop(x)
        found += [n.alias(f"n_{i}_{j}"), *means, F.coalesce(spread * n, F.lit(0.0)).alias(f"co_{i}_{j}")]
    return df.groupBy(*group).agg(*found)


def merge_states(states: Sequence[DataFrame], columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """States of the rows behind all the given states; groups may stand in any of them.

    Deviations are taken around the merged mean, which a window over the group's states provides:
    nothing cancels however far the means lie from zero.
    """
    group = list(group)
    both = reduce(DataFrame.unionByName, states)
    # without a group there is a row per state
    of = Window.partitionBy(*group)
    centred, merged = {}, [F.sum("rows").alias("rows")]
    for i, j in _pairs(columns):
        n = F.col(f"n_{i}_{j}")
        for a, b in dict.fromkeys(((i, j), (j, i))):
            centred[f"_mean_{a}_{b}"] = _mean(F.col(f"mean_{a}_{b}"), n, of)
    both = both.withColumns(centred)
    for i, j in _pairs(columns):
        n = F.col(f"n_{i}_{j}")
        away = [F.col(f"mean_{a}_{b}") - F.col(f"_mean_{a}_{b}") for a, b in ((i, j), (j, i))]
        merged.append(F.sum(n).alias(f"n_{i}_{j}"))
        merged += [F.max(f"_mean_{a}_{b}").alias(f"mean_{a}_{b}") for a, b in dict.fromkeys(((i, j), (j, i)))]
        shift = F.coalesce(n * away[0] * away[1], F.lit(0.0))
        merged.append(F.sum(F.col(f"co_{i}_{j}") + shift).alias(f"co_{i}_{j}"))
    return both.groupBy(*group).agg(*merged)


def _mean(mean: Column, n: Column, of: WindowSpec) -> Column:
    """Mean over states; equal means stay as they are, so a constant keeps a deviation of zero."""
    low, high = F.min(mean).over(of), F.max(mean).over(of)
    return F.when(low == high, low).otherwise(F.try_divide(F.sum(mean * n).over(of), F.sum(F.when(mean.isNotNull(), n)).over(of)))


def state_moments(state: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Per group ``mean_x`` per column and the sample covariance ``cov_x_y`` per pair."""
    out = [F.col(f"mean_{i}_{i}").alias(f"mean_{name}") for i, name in enumerate(columns)]
    out += [_sample(f"co_{i}_{j}", f"n_{i}_{j}").alias(f"cov_{columns[i]}_{columns[j]}") for i, j in _pairs(columns)]
    return state.select(*group, *out)


def _sample(co: str | Column, n: str | Column) -> Column:
    co, n = (F.col(x) if isinstance(x, str) else x for x in (co, n))
    return F.when(n > 1, co / (n - 1))


# --- states per entity and day ---------------------------------------------------------------


def day_states(df: DataFrame, entity: str, time: str, amount: str, distance: str) -> DataFrame:
    """States of amount and distance per (entity, day): all that profiles and global moments need.

    The daily count of a row is the ``rows`` of its state, so even a day whose rows come in two
    batches gets the count of both.  Rows without a time share a state per entity without a day.
    """
    return moment_state(df.withColumn(DAY, F.to_date(time)), [amount, distance], [entity, DAY])


def merge_day_states(states: Sequence[DataFrame], entity: str) -> DataFrame:
    return merge_states(states, ["amount", "distance"], [entity, DAY])


def state_counts(states: DataFrame, entity: str) -> DataFrame:
    """Daily counts as :func:`daily_count` gives them."""
    return states.select(entity, DAY, F.col("rows").alias(COUNT))


def state_profile(states: DataFrame, entity: str) -> DataFrame:
    """Entity profiles as :func:`entity_profile` gives them, from day states alone."""
    of = Window.partitionBy(entity)
    parts, out = {}, [F.sum("rows").alias(PROFILE_ROWS)]
    for i, kind in enumerate(("amt", "dist")):
        n, mean = F.col(f"n_{i}_{i}"), F.col(f"mean_{i}_{i}")
        parts[f"_{kind}"] = _mean(mean, n, of)
        away = mean - F.col(f"_{kind}")
        co = F.sum(F.col(f"co_{i}_{i}") + F.coalesce(n * away * away, F.lit(0.0)))
        out += [F.max(f"_{kind}").alias(f"user_mean_{kind}"), _sample(co, F.sum(n)).alias(f"user_std_{kind}")]
    # a row without a time has no daily count
    n = F.when(F.col(DAY).isNotNull(), F.col("rows")).cast("double")
    parts["_velocity"] = _mean(n, n, of)
    away = n - F.col("_velocity")
    velocity = _sample(F.sum(n * away * away), F.sum(n))
    out += [F.max("_velocity").alias("user_mean_velocity"), velocity.alias("user_std_velocity")]
    profile = states.withColumns(parts).groupBy(entity).agg(*out)
    profile = profile.withColumns({s: F.sqrt(s) for s in PROFILE_STDS})
    return fill_defaults(profile, dict.fromkeys(PROFILE_STDS, 1.0)).select(entity, *PROFILE_COLUMNS, PROFILE_ROWS)


def state_mean_cov(states: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """Means and covariances of amount, distance and daily count over all rows, from day states.

    ``columns`` names the three in the result, which reads like that of :func:`mean_cov`.  Within a
    state the count is constant, so its part in a covariance lies between the states.  Rows without
    an entity or a time have no daily count.
    """
    n = F.when(F.col(entity).isNotNull() & F.col(DAY).isNotNull(), F.col("rows"))
    # the count is a column whose mean is the state's rows and which does not vary inside a state
    terms = {(0, 0): None, (0, 1): None, (1, 1): None}
    weights = {key: F.col(f"n_{key[0]}_{key[1]}") for key in terms}
    means = {(a, b): F.col(f"mean_{a}_{b}") for a in (0, 1) for b in (0, 1)}
    inside = {key: F.col(f"co_{key[0]}_{key[1]}") for key in terms}
    for k in (0, 1):
        weights[k, 2] = F.when(n.isNotNull(), F.col(f"n_{k}_{k}"))
        means[k, 2], means[2, k], inside[k, 2] = F.col(f"mean_{k}_{k}"), n.cast("double"), F.lit(0.0)
    weights[2, 2], means[2, 2], inside[2, 2] = n, n.cast("double"), F.lit(0.0)
    # one row: the means of the whole table, needed before deviations from them
    wholes = []
    for a, b in means:
        w = weights[min(a, b), max(a, b)]
        wholes.append(F.try_divide(F.sum(w * means[a, b]), F.sum(F.when(means[a, b].isNotNull(), w))).alias(f"m_{a}_{b}"))
    whole = states.agg(*wholes)
    whole = whole.select(F.struct(*whole.columns)).scalar()
    names = list(columns)
    out = [F.max(whole.getField(f"m_{i}_{i}")).alias(f"mean_{name}") for i, name in enumerate(names)]
    for i, j in _pairs(names):
        w = weights[i, j]
        away = [means[a, b] - whole.getField(f"m_{a}_{b}") for a, b in ((i, j), (j, i))]
        co = F.sum(F.coalesce(inside[i, j], F.lit(0.0)) + F.coalesce(w * away[0] * away[1], F.lit(0.0)))
        out.append(_sample(co, F.sum(w)).alias(f"cov_{names[i]}_{names[j]}"))
    return states.agg(*out)
