"""The numeric feature table, built the same way for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.calendar import age_years, time_parts, weekend_night
from riskloom.functions.scores import amount_log, anomaly_weighted, binary_code
from riskloom.operators.encoding import apply_codes, code_map
from riskloom.operators.quality import dedup_key, impute_median, impute_mode
from riskloom.plans.enrich import measured
from riskloom.schema import TxnColumns, nan_to_null, numeric_columns, require_columns, string_columns
from riskloom.session import stage

ANOMALY = "if_anomaly_score"
# left out of the feature list on both sides
NOT_FEATURES = ("global_amt_zscore",)


def clean(df: DataFrame, cols: TxnColumns) -> DataFrame:
    """Impute nulls, then drop repeated rows and repeated keys, keeping the first.

    A repeated row also repeats its key, so one pass over the keys drops both.
    """
    # a missing id or label is not a measurement to fill in
    keep = {cols.row_id, cols.key, cols.entity, cols.label}
    df = impute_median(df, [n for n in numeric_columns(df) if n not in keep])
    df = impute_mode(df, [n for n in string_columns(df) if n not in keep])
    return dedup_key(df, [cols.key], [cols.row_id])


def fit_codes(df: DataFrame, cols: TxnColumns, skip: Sequence[str] = ()) -> DataFrame:
    """One code map for the coded columns not in ``skip``, in order of time; values that first
    come at the same time follow their own order."""
    freqs = [c for c in cols.freq_coded if c not in skip]
    return code_map(df, cols.label_coded, freqs, cols.time)


def reference_time(df: DataFrame, cols: TxnColumns) -> Column:
    """Latest event of the batch, as a scalar subquery."""
    return df.agg(F.max(cols.time).alias("latest")).scalar()


def build_features(
    df: DataFrame,
    cols: TxnColumns,
    codes: DataFrame,
    sizes: dict[str, int] | None = None,
    reference: Column | None = None,
    gender_default: int | None = 0,
) -> DataFrame:
    """Add time, age, amount and coded features; codes replace the label columns.

    A frequency column that is there already is not looked up again.
    """
    reference = reference_time(df, cols) if reference is None else reference
    time = F.col(cols.time)
    df = measured(df, cols).withColumns(
        {
            **time_parts(time),
            **weekend_night(time),
            "age": age_years(F.col(cols.birth), reference),
            "amt_log": amount_log(F.col(cols.amount)),
            cols.gender: binary_code(F.col(cols.gender), "M", "F", gender_default),
        }
    )
    if ANOMALY in df.columns:
        weighted = anomaly_weighted(F.col("amt_log"), F.col(ANOMALY))
        df = df.withColumn("anomaly_weighted_amt", weighted)
    labels = {c: c for c in cols.label_coded if c in df.columns}
    freqs = {c: f"{c}_freq" for c in cols.freq_coded if c in df.columns}
    freqs = {c: out for c, out in freqs.items() if out not in df.columns}
    return apply_codes(df, codes, labels, freqs, sizes)


def feature_names(df: DataFrame, cols: TxnColumns, extra: Sequence[str] = ()) -> list[str]:
    """Columns of a built table that a model reads: all but ids, raw text, dates and the label."""
    out = {cols.row_id, cols.key, cols.time, cols.birth, cols.label, *cols.freq_coded, *cols.unused}
    out |= {*NOT_FEATURES, *extra}
    return [c for c in df.columns if c not in out]


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The listed columns in order, all numeric; a missing or text column is an error."""
    require_columns(df, features)
    chosen = df.select(*keep, *features)
    texts = [c for c in string_columns(chosen) if c in features]
    if texts:
        raise ValueError(f"text columns left: {texts}")
    return chosen


def feature_table(df: DataFrame, cols: TxnColumns) -> DataFrame:
    """From a raw or enriched table to cleaned, fully numeric rows with key, time and label."""
    # the input is read for its nulls, their fills and the rows, the clean rows for the codes, the
    # reference time and the result; either is computed once
    cleaned = stage(clean(stage(nan_to_null(df), "raw"), cols), "clean")
    built = build_features(cleaned, cols, fit_codes(cleaned, cols))
    keep = [cols.key, cols.time, *([cols.label] if cols.label in built.columns else [])]
    return select_features(built, feature_names(built, cols), keep)
