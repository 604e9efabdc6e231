"""Stage 1: distances, velocity, z-scores, Mahalanobis distance and outlier flag."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.geo import with_distance
from riskloom.functions.scores import mahalanobis, outlier_flag, zscore
from riskloom.operators.moments import center_and_inverse, mean_cov
from riskloom.operators.ordering import exact_quantiles
from riskloom.operators.velocity import (
    COUNT,
    daily_count,
    drop_profile,
    entity_profile,
    user_zscores,
    with_entity_state,
)
from riskloom.schema import TxnColumns, nan_to_null
from riskloom.session import stage
from riskloom.sources.profiles import GlobalProfile

DISTANCE = "distance_km"
MAHALANOBIS = "mahalanobis_dist"
FLAG = "classical_outlier_flag"
CUT_SHARE = 0.99


def measured(df: DataFrame, cols: TxnColumns) -> DataFrame:
    """Add the distance unless present."""
    return with_distance(df, cols.lat, cols.lon, cols.merch_lat, cols.merch_lon, DISTANCE)


def fit_entities(df: DataFrame, cols: TxnColumns, counts: DataFrame | None = None) -> DataFrame:
    rows = measured(df, cols)
    return entity_profile(rows, cols.entity, cols.time, cols.amount, DISTANCE, counts)


def entity_scores(
    df: DataFrame,
    cols: TxnColumns,
    entities: DataFrame,
    unseen: dict[str, float] | None = None,
    counts: DataFrame | None = None,
    rows_as: str | None = None,
) -> DataFrame:
    """Add distance, daily count of this table and z-scores against the entity profiles."""
    rows = measured(df, cols)
    joined = with_entity_state(rows, entities, cols.entity, cols.time, unseen, counts, rows_as)
    return drop_profile(user_zscores(joined, cols.amount, DISTANCE))


def distance_columns(cols: TxnColumns) -> list[str]:
    return [cols.amount, DISTANCE, COUNT]


def with_mahalanobis(
    df: DataFrame, columns: Sequence[str], center: list[float], inverse: list[list[float]]
) -> DataFrame:
    return df.withColumn(MAHALANOBIS, mahalanobis([F.col(c) for c in columns], center, inverse))


def fit_mahalanobis(df: DataFrame, columns: Sequence[str]) -> tuple[list, list]:
    """Center and inverse covariance from one aggregation."""
    return center_and_inverse(mean_cov(df, columns).first().asDict(), columns)


def fit_global(df: DataFrame, cols: TxnColumns) -> GlobalProfile:
    """Fixed-size statistics of a table that has passed :func:`entity_scores`."""
    columns = distance_columns(cols)
    # the means and deviations come out of the covariance pass
    row = mean_cov(df, columns).first().asDict()
    center, inverse = center_and_inverse(row, columns)
    scored = with_mahalanobis(df, columns, center, inverse)
    cut = exact_quantiles(scored, {MAHALANOBIS: [CUT_SHARE]})[MAHALANOBIS][0]
    return GlobalProfile(
        mean_amt=row[f"mean_{cols.amount}"],
        std_amt=row[f"cov_{cols.amount}_{cols.amount}"] ** 0.5,
        mean_dist=row[f"mean_{DISTANCE}"],
        std_dist=row[f"cov_{DISTANCE}_{DISTANCE}"] ** 0.5,
        mahala_mu=center,
        mahala_inv_cov=inverse,
        mahala_99_pct=cut,
    )


def fit_stage1(
    df: DataFrame,
    cols: TxnColumns,
    scope: Column | None = None,
    rows_as: str | None = None,
    store: Callable[[DataFrame | Callable[[], DataFrame], str], DataFrame] | None = None,
) -> tuple[GlobalProfile, DataFrame, DataFrame]:
    """Statistics fitted on the rows in ``scope`` (all by default).

    Returns the global profile, the entity profiles, and all rows with their entity scores.
    Counts, profiles and rows are read several times, so each is written once, by ``store`` if it
    is given.  NaN is null.
    """
    df = nan_to_null(df)
    store = (lambda table, name: stage(table() if callable(table) else table, name)) if store is None else store
    counts = store(daily_count(df, cols.entity, cols.time), "counts")
    if scope is None:
        fitted = fit_entities(df, cols, counts)
    else:
        fitted = fit_entities(df.where(scope), cols)
    entities = store(fitted, "entities")
    core = store(entity_scores(df, cols, entities, None, counts, rows_as), "core")
    within = core if scope is None else core.where(scope)
    overall = store(lambda: fit_global(within, cols).to_df(df.sparkSession), "overall")
    return GlobalProfile.from_df(overall), entities, core


def global_scores(df: DataFrame, cols: TxnColumns, overall: GlobalProfile) -> DataFrame:
    """Add global z-scores, Mahalanobis distance and the outlier flag from saved statistics."""
    amount, distance = F.col(cols.amount), F.col(DISTANCE)
    df = df.withColumns(
        {
            "global_amt_zscore": zscore(amount, F.lit(overall.mean_amt), F.lit(overall.std_amt)),
            "global_dist_zscore": zscore(distance, F.lit(overall.mean_dist), F.lit(overall.std_dist)),
        }
    )
    columns = distance_columns(cols)
    df = with_mahalanobis(df, columns, overall.mahala_mu, overall.mahala_inv_cov)
    scores = [F.col(c) for c in ("global_amt_zscore", "global_dist_zscore", "user_amt_zscore")]
    return df.withColumn(FLAG, outlier_flag(scores, F.col(MAHALANOBIS), overall.mahala_99_pct))


def stage1_score(
    df: DataFrame,
    cols: TxnColumns,
    overall: GlobalProfile,
    entities: DataFrame,
    unseen: dict[str, float] | None = None,
    rows_as: str | None = None,
) -> DataFrame:
    """Score a batch with saved statistics; daily counts are those of the batch.  NaN is null."""
    df = nan_to_null(df)
    return global_scores(entity_scores(df, cols, entities, unseen, None, rows_as), cols, overall)
