"""Global moments and covariance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scores import zscore


def global_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``mean_x`` and ``std_x`` (sample) for every column."""
    aggregates = []
    for name in columns:
        aggregates += [F.avg(name).alias(f"mean_{name}"), F.stddev_samp(name).alias(f"std_{name}")]
    return df.agg(*aggregates)


def global_zscores(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    """Add ``(x - mean) / std`` over the whole table; ``outputs`` maps column to new name.

    The moments enter as a scalar subquery, so the plan needs no join.
    """
    moments = global_moments(df, list(outputs))
    one_row = moments.select(F.struct(*moments.columns)).scalar()
    return df.withColumns(
        {
            out: zscore(F.col(name), one_row.getField(f"mean_{name}"), one_row.getField(f"std_{name}"))
            for name, out in outputs.items()
        }
    )


def mean_cov(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``mean_x`` per column and the sample covariance ``cov_x_y`` per pair."""
    aggregates = [F.avg(name).alias(f"mean_{name}") for name in columns]
    for i, left in enumerate(columns):
        for right in columns[i:]:
            aggregates.append(F.covar_samp(left, right).alias(f"cov_{left}_{right}"))
    return df.agg(*aggregates)


def center_and_inverse(moments: dict[str, float], columns: Sequence[str]) -> tuple[list, list]:
    """Mean vector and inverse covariance from the one row of :func:`mean_cov`.

    A singular matrix falls back to the pseudo-inverse.  The matrix is k by k for k columns,
    whatever the size of the data.
    """
    k = len(columns)
    cov = np.empty((k, k))
    for i, left in enumerate(columns):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = moments[f"cov_{left}_{columns[j]}"]
    try:
        inverse = np.linalg.inv(cov)
    except np.linalg.LinAlgError:
        inverse = np.linalg.pinv(cov)
    return [float(moments[f"mean_{name}"]) for name in columns], inverse.tolist()
