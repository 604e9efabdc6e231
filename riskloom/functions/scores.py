"""Row-level scores: z-scores, Mahalanobis distance, flags, transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The z-score that flags a row, and the anomaly score at which the weight is 1.
Z_LIMIT = 3.0
ANOMALY_PIVOT = 0.3


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Null when the standard deviation is zero."""
    return F.try_divide(value - mean, std)


def safe_zscore(value: Column, mean: Column, std: Column) -> Column:
    """Zero when the standard deviation is zero."""
    return F.when(std == 0, 0.0).otherwise(F.try_divide(value - mean, std))


def beyond(z: Column, limit: float = Z_LIMIT) -> Column:
    """Whether a score passes the limit; null and NaN do not."""
    return F.coalesce((F.abs(z) > limit) & ~F.isnan(z), F.lit(False))


def outlier_flag(
    zscores: Sequence[Column], distance: Column, cut: Column | float, limit: float = Z_LIMIT
) -> Column:
    """1 if any |z| passes the limit or the distance passes its cut; null and NaN never flag."""
    flagged = F.coalesce((distance > cut) & ~F.isnan(distance), F.lit(False))
    for z in zscores:
        flagged = flagged | beyond(z, limit)
    return flagged.cast("int")


def threshold_flag(probability: Column, threshold: Column | float) -> Column:
    """1 from the threshold on; a row without a score, null or NaN, gets 0."""
    reached = (probability >= threshold) & ~F.isnan(probability)
    return F.coalesce(reached, F.lit(False)).cast("int")


def mahalanobis(
    values: Sequence[Column], center: Sequence[float], inverse: Sequence[Sequence[float]]
) -> Column:
    """sqrt((x-m)' S^-1 (x-m)) as one column expression; S^-1 is symmetric."""
    offsets = [value - float(mid) for value, mid in zip(values, center)]
    squared = F.lit(0.0)
    for i, left in enumerate(offsets):
        squared = squared + float(inverse[i][i]) * left * left
        for j in range(i + 1, len(offsets)):
            squared = squared + float(inverse[i][j] + inverse[j][i]) * left * offsets[j]
    # a distance of zero may come out as a tiny negative number
    return F.sqrt(F.when(squared < 0, 0.0).otherwise(squared))


def amount_log(amount: Column) -> Column:
    return F.log1p(amount)


def anomaly_weighted(log_amount: Column, anomaly: Column, pivot: float = ANOMALY_PIVOT) -> Column:
    """Log amount weighted up for rows the forest finds abnormal (low score)."""
    return log_amount * (F.lit(pivot) - anomaly)


def binary_code(value: Column, one: str, zero: str, default: int | None = 0) -> Column:
    """Map two values to 1 and 0; anything else (null too) gets the default."""
    return F.when(value == one, 1).when(value == zero, 0).otherwise(F.lit(default).cast("int"))
