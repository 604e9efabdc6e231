"""Column names of a transaction table, its declared types, and column checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class TxnColumns:
    """Which columns of a table play which part; every operator takes names from here."""

    row_id: str = "pos"
    key: str = "trans_num"
    time: str = "trans_date_trans_time"
    entity: str = "cc_num"
    amount: str = "amt"
    lat: str = "lat"
    lon: str = "long"
    merch_lat: str = "merch_lat"
    merch_lon: str = "merch_long"
    birth: str = "dob"
    gender: str = "gender"
    population: str = "city_pop"
    label: str = "is_fraud"
    # Which columns are coded how, and which no model reads.
    label_coded: tuple[str, ...] = ("category", "state")
    freq_coded: tuple[str, ...] = ("merchant", "job", "cc_num")
    unused: tuple[str, ...] = ("first", "last", "street", "city", "zip", "unix_time")


def txn_schema(cols: TxnColumns = TxnColumns()) -> T.StructType:
    """Declared types of the raw transaction table."""
    text = ("merchant", "job", "category", "state")
    fields = [
        T.StructField(cols.row_id, T.LongType()),
        T.StructField(cols.key, T.StringType()),
        T.StructField(cols.time, T.TimestampNTZType()),
        T.StructField(cols.entity, T.LongType()),
        T.StructField(cols.amount, T.DoubleType()),
        *[T.StructField(name, T.StringType()) for name in text],
        T.StructField(cols.gender, T.StringType()),
        T.StructField(cols.lat, T.DoubleType()),
        T.StructField(cols.lon, T.DoubleType()),
        T.StructField(cols.merch_lat, T.DoubleType()),
        T.StructField(cols.merch_lon, T.DoubleType()),
        T.StructField(cols.population, T.IntegerType()),
        T.StructField(cols.birth, T.DateType()),
        T.StructField(cols.label, T.IntegerType()),
    ]
    return T.StructType(fields)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with its type and kind (numeric, string, other)."""
    kinds = {
        **dict.fromkeys(numeric_columns(df), "numeric"),
        **dict.fromkeys(string_columns(df), "string"),
    }
    rows = [(f.name, f.dataType.simpleString(), kinds.get(f.name, "other")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, kind string")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null, since Spark orders NaN above every number."""
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            F.when(~F.isnan(name), F.col(name)).alias(name) if name in floating else F.col(name)
            for name in df.columns
        ]
    )


def narrow_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that exist; a value that does not fit raises (ANSI)."""
    present = {name: F.col(name).cast(kind) for name, kind in types.items() if name in df.columns}
    return df.withColumns(present) if present else df
