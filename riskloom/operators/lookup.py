"""Left equi-joins of a large table with a keyed table, safe under hot keys.

A key that holds a large share of the rows would put all of them into one shuffle partition.
Keys above a share of the rows are few by construction (at most ``1/share`` of them), so their
part of the keyed table is broadcast, and their rows are spread over many partitions when the
rest is joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot above this share of the rows, or above what one task should take if that is less;
#: so there are at most ``1 / LEAST_SHARE`` hot keys to broadcast.
HOT_SHARE = 1 / 256
TASK_ROWS = 5_000_000
LEAST_SHARE = 1e-5
BROADCAST_ROWS = 200_000


def hot_keys(counts: DataFrame, on: Sequence[str], weight: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys whose weight exceeds a share of the total: at most ``1/share`` rows."""
    total = counts.agg(F.sum(weight)).scalar()
    return counts.where(F.col(weight) > _hot_rows(total, share)).select(*on)


def _hot_rows(total: Column, share: float) -> Column:
    return F.greatest(F.least(share * total, F.lit(float(TASK_ROWS))), LEAST_SHARE * total)


def spread_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    values: Sequence[str],
    weight: str | None = None,
    share: float = HOT_SHARE,
    always: str | None = None,
    also: DataFrame | None = None,
) -> DataFrame:
    """Left join ``values`` of ``dim`` (unique on ``on``) to ``df``.

    ``weight`` names a column of ``dim`` that counts the rows of ``df`` per key; without it the
    keys of ``df`` are counted.  ``always`` names one that marks keys, a handful, to take as hot;
    ``also`` holds further hot keys, a handful, which ``dim`` may lack.
    """
    on = list(on)
    payload = F.struct(*values)
    if weight:
        total = dim.agg(F.sum(weight)).scalar()
        over = F.col(weight) > _hot_rows(total, share)
        if always:
            over = over | F.col(always)
        hot = dim.where(over).select(*on, payload.alias("_hot"))
        if also is not None:
            more = also.select(*on).distinct().join(F.broadcast(hot.select(*on)), on, "left_anti")
            # a key that the keyed table lacks is settled as well
            met = dim.join(F.broadcast(more), on, "left_semi").select(*on, payload.alias("_hot"))
            hot = hot.unionByName(more.join(F.broadcast(met), on, "left"))
    else:
        counts = df.groupBy(*on).agg(F.count("*").alias("_rows"))
        keys = hot_keys(counts, on, "_rows", share)
        found = dim.join(F.broadcast(keys), on, "left_semi").select(*on, payload.alias("_hot"))
        # a hot key that the keyed table lacks is settled as well
        hot = keys.join(F.broadcast(found), on, "left")
    hot = hot.withColumn("_settled", F.lit(True))
    # A key's own slot is a hash of the key.  Rows that have their value already, or can match
    # nothing, take a slot of their task instead, so they spread and a retried task repeats it.
    # Should two slots coincide, the keys still decide the match.
    slot = F.xxhash64(*on)
    rest = dim.select(*on, slot.alias("_slot"), payload.alias("_rest"))
    settled = F.col("_settled").isNotNull()
    for key in on:
        settled = settled | F.col(key).isNull()
    joined = (
        df.join(F.broadcast(hot), on, "left")
        .withColumn("_slot", F.when(settled, F.xxhash64(*on, F.spark_partition_id())).otherwise(slot))
        .join(rest, [*on, "_slot"], "left")
        .withColumn("_value", F.coalesce("_hot", "_rest"))
    )
    return joined.select(*df.columns, *[F.col(f"_value.{name}").alias(name) for name in values])


def frequent_values(df: DataFrame, columns: Sequence[str], share: float = HOT_SHARE) -> dict[str, list]:
    """Per column the values that may hold more than a share of the rows, from one small summary.

    A frequent-items sketch counts in fixed space and never too low by more than a small part of
    the share, so no value above it is missed; at most ``1/share`` values come back per column.
    Nulls count as no value.
    """
    if not columns:
        return {}
    most = round(1 / share)
    tops = [F.call_function("approx_top_k", c, F.lit(most), F.lit(40 * most)).alias(f"t{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count("*").alias("rows"), *tops).first()
    least = share * row["rows"] / 2
    return {
        c: [x["item"] for x in row[f"t{i}"] or [] if x["item"] is not None and x["count"] > least] for i, c in enumerate(columns)
    }


def is_small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``rows`` rows; for a stored table the count is in the footers."""
    return dim.count() <= rows


def lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], values: Sequence[str], small: bool | None = None
) -> DataFrame:
    """Left join by broadcast if the keyed table is measured small, else by spread shuffle."""
    if is_small(dim) if small is None else small:
        return df.join(F.broadcast(dim.select(*on, *values)), list(on), "left").select(
            *df.columns, *values
        )
    return spread_lookup(df, dim, on, values)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls of the listed columns by constants of any type."""
    filled: dict[str, Column] = {
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()
    }
    return df.withColumns(filled)
