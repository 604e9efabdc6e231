"""Data quality: nulls, imputation, duplicates, summaries, class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.operators.ordering import exact_quantiles
from riskloom.schema import numeric_columns, string_columns

# Fixed value: quartile distances beyond which a value is an outlier.
IQR_REACH = 3.0
#: Bits of the map of repeated keys that dedup_key sends to all tasks, 64 to a row.
KEY_BITS = 1 << 26


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), digits)


def _to_rows(wide: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row table into a row per name; ``fields`` maps output to column prefix."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{p}_{i}").alias(o) for o, p in fields.items()])
        for i, n in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*structs)).alias("_row")).select("_row.*")


# --- nulls -----------------------------------------------------------------------------------


def null_profile(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """Null count and percent per column, in one aggregation."""
    names = df.columns
    wide = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(n).isNull()).alias(f"nulls_{i}") for i, n in enumerate(names)]
    )
    structs = [F.struct(F.lit(n).alias("column"), F.col(f"nulls_{i}").alias("nulls")) for i, n in enumerate(names)]
    rows = wide.select("_n", F.explode(F.array(*structs)).alias("_row")).select(
        "_row.column", "_row.nulls", percent(F.col("_row.nulls"), F.col("_n")).alias("pct")
    )
    return rows.where(F.col("nulls") > 0) if only_with_nulls else rows


def null_total(df: DataFrame) -> DataFrame:
    """One row: null cells of the whole table."""
    return null_profile(df).agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"))


def columns_with_nulls(df: DataFrame, names: Sequence[str]) -> list[str]:
    if not names:
        return []
    row = df.agg(*[F.count_if(F.col(n).isNull()).alias(f"c{i}") for i, n in enumerate(names)]).first()
    return [n for n, nulls in zip(names, row) if nulls]


def medians(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    found = exact_quantiles(df, {n: [0.5] for n in names}) if names else {}
    return {n: v[0] for n, v in found.items() if v[0] is not None}


def modes(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties; one pass over all columns."""
    if not names:
        return {}
    counted = value_counts(df, names)
    best = counted.groupBy("column").agg(
        F.min(F.struct((-F.col("count")).alias("_order"), F.col("value"))).alias("_best")
    )
    # one row per column
    return {row["column"]: row["_best"]["value"] for row in best.collect()}


def _fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    if not values:
        return df
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v).cast(kinds[n])) for n, v in values.items()}
    )


def impute_median(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Fill numeric nulls by the exact median; columns without nulls cost one shared check."""
    names = numeric_columns(df) if names is None else names
    return _fill(df, medians(df, columns_with_nulls(df, names)))


def impute_mode(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    names = string_columns(df) if names is None else names
    return _fill(df, modes(df, columns_with_nulls(df, names)))


# --- counts and summaries --------------------------------------------------------------------


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, count)``; nulls are not counted.  One scan for all columns."""
    cells = F.array(
        *[F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")) for n in names]
    )
    return (
        df.select(F.explode(cells).alias("_cell"))
        .select("_cell.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows ``(value, count, pct)`` of one column, percent of the non-null rows."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("count")
    )
    total = counted.agg(F.sum("count")).scalar()
    return counted.withColumn("pct", percent(F.col("count"), total))


def describe(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per numeric column."""
    names = numeric_columns(df) if names is None else list(names)
    quartiles = exact_quantiles(df, {n: [0.25, 0.5, 0.75] for n in names})
    aggregates = []
    for i, n in enumerate(names):
        x = F.col(n).cast("double")
        aggregates += [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
            *[F.lit(v).cast("double").alias(f"q{k}_{i}") for k, v in enumerate(quartiles[n])],
        ]
    fields = {
        "count": "count",
        "mean": "mean",
        "std": "std",
        "min": "min",
        "q25": "q0",
        "q50": "q1",
        "q75": "q2",
        "max": "max",
    }
    return _to_rows(df.agg(*aggregates), names, fields)


def iqr_outliers(df: DataFrame, column: str, reach: float = IQR_REACH) -> DataFrame:
    """Quartiles, and count and percent of rows outside ``q -/+ reach * IQR``; keeps all rows."""
    q1, q3 = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    spread = q3 - q1
    outside = (F.col(column) < q1 - reach * spread) | (F.col(column) > q3 + reach * spread)
    return df.agg(
        F.lit(q1).alias("q1"),
        F.lit(q3).alias("q3"),
        F.count_if(outside).alias("outliers"),
        percent(F.count_if(outside), F.count("*")).alias("pct"),
    )


def min_max(df: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = [(F.min(n).alias(f"min_{n}"), F.max(n).alias(f"max_{n}")) for n in names]
    return df.agg(*[c for pair in pairs for c in pair])


# --- duplicates ------------------------------------------------------------------------------


def repeat_counts(df: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that repeat an earlier row, and rows that repeat an earlier key."""

    def repeats(names: Sequence[str], out: str) -> DataFrame:
        counted = df.groupBy(*names).agg(F.count("*").alias("_n"))
        return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(out))

    whole = repeats([c for c in df.columns if c not in ignore], "duplicate_rows")
    keyed = repeats(list(key), "duplicate_keys")
    return whole.withColumn("duplicate_keys", keyed.scalar())


def dedup_rows(df: DataFrame, position: str) -> DataFrame:
    """Drop repeated rows, keeping the first; the position column is not compared."""
    data = [c for c in df.columns if c != position]
    return df.groupBy(*data).agg(F.min(position).alias(position)).select(*df.columns)


def dedup_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key; a null key is a key, and equal first rows are one.

    First the keys alone are counted by their hash.  Keys met twice set bits in a map of fixed size,
    which goes to all tasks: rows off the map are unique and stay where they are, in no shuffle and
    no sort.  Only the others, the repeats and what the map's size confuses with them, are ranked by
    key; map tasks drop all but their first row of a key, so a key with any number of rows is fine.
    ``df`` is read three times, of which once for its key only, so store it if it is not a table.
    """
    bits = F.broadcast(_repeated(df, key))
    names = dict(zip(("_word", "_bits", "_place"), _unused(df, 3)))
    hashed = df.withColumn(names["_word"], _word(key)).join(bits.withColumnsRenamed(names), names["_word"], "left")
    repeated = F.coalesce(F.getbit(names["_bits"], _bit(key)) == 1, F.lit(False))
    unique = hashed.where(~repeated).select(*df.columns)
    sortable = {f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))}
    # the other columns settle rows that come first together
    ordered = dict.fromkeys([*order_by, *[c for c in df.columns if c in sortable]])
    first = Window.partitionBy(*key).orderBy(*[c for c in ordered if c not in key] or [F.lit(0)])
    ranked = hashed.where(repeated).withColumn(names["_place"], F.row_number().over(first))
    return unique.unionByName(ranked.where(F.col(names["_place"]) == 1).select(*df.columns))


def _unused(df: DataFrame, n: int) -> list[str]:
    """Names that no column of the table has."""
    taken, found, i = {c.lower() for c in df.columns}, [], 0
    while len(found) < n:
        name, i = f"_dedup_{i}", i + 1
        if name not in taken:
            found.append(name)
    return found


def _word(key: Sequence[str]) -> Column:
    return F.shiftright(F.pmod(F.xxhash64(*key), F.lit(KEY_BITS)), 6)


def _bit(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(64)).cast("int")


def _repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows ``(_word, _bits)``, at most KEY_BITS / 64: the bits of the hashes of keys met twice."""
    counted = df.groupBy(F.xxhash64(*key).alias("_hash")).agg(F.count("*").alias("_n")).where("_n > 1")
    slot = F.pmod("_hash", F.lit(KEY_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_hash", F.lit(64)).cast("int"))
    return counted.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))


# --- class balance ---------------------------------------------------------------------------


def class_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group: total, legit and fraud rows, their percents and the whole-number ratio."""
    fraud, legit = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    counted = df.groupBy(*by).agg(
        (fraud + legit).alias("total"), legit.alias("legit"), fraud.alias("fraud")
    )
    ratio = F.when(F.col("fraud") > 0, F.expr("legit div fraud"))
    return counted.withColumns(
        {
            "legit_pct": percent(F.col("legit"), F.col("total")),
            "fraud_pct": percent(F.col("fraud"), F.col("total")),
            "imbalance_ratio": ratio,
        }
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row ``(name, value)``: legit over fraud rows of the given (training) rows."""
    weight = F.try_divide(
        F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1)
    )
    return df.agg(weight.alias("value")).select(F.lit("class_weight").alias("name"), "value")


def flag_rate(df: DataFrame, flag: str) -> DataFrame:
    """Row count, flagged rows and their percent."""
    flagged = F.count_if(F.col(flag) == 1)
    return df.agg(
        F.count("*").alias("rows"),
        flagged.alias("flagged"),
        percent(flagged, F.count("*"), 4).alias("pct"),
    )
