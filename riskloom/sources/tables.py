"""Table sources and sinks: typed and inferred CSV, parquet, splits, one-value tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.schema import nan_to_null
from riskloom.sources.layout import with_file_position

QUOTING = {"quote": '"', "escape": '"'}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    drop: Sequence[str] = (),
    time_format: str = TIME_FORMAT,
    multi_line: bool = False,
    position: str | None = None,
) -> DataFrame:
    """CSV with declared types; NaN becomes null.  A value that does not parse raises.

    Quotes inside a quoted field are doubled, as in most writers.  ``multi_line`` reads fields
    with line breaks; such files cannot be split, so each is read by one task.  ``position`` names
    a new column that numbers the rows in file order.
    """
    df = (
        spark.read.schema(schema)
        .options(**QUOTING)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("timestampFormat", time_format)
        .option("timestampNTZFormat", time_format)
        .csv(path)
    )
    df = df.drop(*drop)
    return nan_to_null(with_file_position(df, position) if position else df)


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with inferred types, for ad-hoc input; costs a pass over the file."""
    reader = spark.read.options(**QUOTING).option("header", True).option("inferSchema", True)
    return nan_to_null(reader.option("multiLine", multi_line).csv(path))


def write_table(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.options(**QUOTING).option("header", True)
        writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown table kind: {kind}")


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split, so reading a split reads only its files."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_scalar(df: DataFrame, path: str) -> None:
    """Store a one-row table ``(name, value)``."""
    df.select("name", F.col("value").cast("double")).write.mode("overwrite").parquet(path)


def read_scalar(spark: SparkSession, path: str, name: str) -> float:
    stored = spark.read.schema("name string, value double").parquet(path)
    return stored.where(F.col("name") == name).first()["value"]


def predictions_table(df: DataFrame, label: str, probability: str) -> DataFrame:
    """The table ``(y_true, y_prob)`` that evaluation reads."""
    return df.select(
        F.col(label).cast("int").alias("y_true"), F.col(probability).cast("double").alias("y_prob")
    )
