"""Label codes by first appearance and frequency codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.operators.lookup import BROADCAST_ROWS, frequent_values, spread_lookup
from riskloom.operators.ordering import global_position
from riskloom.session import stage

UNSEEN_CODE = -1
UNSEEN_FREQ = 0


def label_codes(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """Rows ``(value, code)``: codes 0..k-1 in order of first appearance; null takes a code.

    Values that appear first at the same ``order_by`` follow their own order.
    """
    firsts = df.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.min(order_by).alias("_first")
    )
    firsts = stage(firsts, "codes")
    return global_position(firsts, ["_first", "value"], "code").select("value", "code")


def code_map(
    df: DataFrame,
    label_columns: Sequence[str],
    freq_columns: Sequence[str],
    order_by: str,
) -> DataFrame:
    """Rows ``(column, value, code, freq)`` for all coded columns, counted in one scan.

    ``code`` is null for frequency-only columns; the frequency of null is 0.  Both aggregates
    have fixed width, so map tasks hash and never sort.
    """
    names = list(dict.fromkeys([*label_columns, *freq_columns]))
    is_label = F.col("column").isin(*label_columns)
    cells = F.array(
        *[F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")) for n in names]
    )
    firsts = (
        df.select(F.explode(cells).alias("_cell"), F.col(order_by).alias("_order"))
        .select("_cell.*", "_order")
        .groupBy("column", "value")
        .agg(F.count("*").alias("_rows"), F.min(F.when(is_label, F.col("_order"))).alias("_first"))
    )
    firsts = stage(firsts, "codes")
    # all label columns are numbered together; a column's codes start at its first position
    placed = global_position(firsts.where(is_label), ["column", "_first", "value"], "_place")
    starts = placed.groupBy("column").agg(F.min("_place").alias("_start"))
    ranked = placed.join(F.broadcast(starts), "column").select(
        *firsts.columns, (F.col("_place") - F.col("_start")).alias("code")
    )
    counted = firsts.where(~is_label).withColumn("code", F.lit(None).cast("long"))
    freq = F.when(F.col("value").isNull(), 0).otherwise(F.col("_rows"))
    return ranked.unionByName(counted).select("column", "value", "code", freq.alias("freq"))


def map_sizes(codes: DataFrame) -> dict[str, int]:
    """Number of values per coded column: one row per column."""
    return {r["column"]: r["count"] for r in codes.groupBy("column").count().collect()}


def apply_codes(
    df: DataFrame,
    codes: DataFrame,
    label_columns: dict[str, str],
    freq_columns: dict[str, str],
    sizes: dict[str, int] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add codes (unseen -1) and frequencies (unseen 0); the dicts map column to new name.

    Each column's map is broadcast only if it was measured small; a larger one joins by shuffle
    with hot values spread: those frequent where the map was fitted, and those frequent in this
    batch, which the map may not know.  The latter come from one pass over the columns concerned.
    """
    sizes = map_sizes(codes) if sizes is None else sizes
    large = [c for c in {**label_columns, **freq_columns} if sizes.get(c, 0) > broadcast_rows]
    frequent = frequent_values(df.select(*[F.col(c).cast("string").alias(c) for c in large]), large)
    jobs = [(c, "code", out, UNSEEN_CODE) for c, out in label_columns.items()]
    jobs += [(c, "freq", out, UNSEEN_FREQ) for c, out in freq_columns.items()]
    for column, kind, out, unseen in jobs:
        # a mark stands for null, which has a code of its own
        dim = codes.where(F.col("column") == column).select(
            F.coalesce(F.concat(F.lit("="), "value"), F.lit("null")).alias("_value"),
            F.col(kind).alias("_found"),
            F.col("freq").alias("_weight"),
            F.col("value").isNull().alias("_always"),
        )
        text = F.col(column).cast("string")
        marked = df.withColumn("_value", F.coalesce(F.concat(F.lit("="), text), F.lit("null")))
        if sizes.get(column, 0) <= broadcast_rows:
            joined = marked.join(F.broadcast(dim.select("_value", "_found")), "_value", "left")
        else:
            # the map has the counts, so the rows so far are not read to find hot values; null,
            # whose frequency is 0 by definition, is settled as if hot
            # a handful of literals, no table of its own
            values = F.array(*[F.lit(f"={v}") for v in frequent[column]]).cast("array<string>")
            hot = df.sparkSession.range(1).select(F.explode(values).alias("_value"))
            joined = spread_lookup(
                marked, dim, ["_value"], ["_found"], weight="_weight", always="_always", also=hot
            )
        found = F.coalesce("_found", F.lit(unseen).cast("long"))
        kept = [c for c in df.columns if c != out]
        df = joined.select(*kept, found.alias(out))
    return df
