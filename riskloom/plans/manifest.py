"""Stages of a long fit, kept in a folder with a manifest, so that a restarted fit goes on."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.session import shared_folder

MANIFEST_SCHEMA = "stage string, inputs string, path string"
Model = TypeVar("Model")


def fingerprint(df: DataFrame, *settings: object) -> str:
    """A digest of a table's rows, whatever their order, of its columns, and of settings.

    One pass; rows that repeat count as often as they occur.
    """
    row = df.agg(
        F.count("*").alias("rows"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("sum"),
        F.sum(F.xxhash64(F.lit(1), *df.columns).cast("decimal(38,0)")).alias("again"),
    ).first()
    about = [*df.dtypes, *map(str, row), *map(repr, settings)]
    return hashlib.sha256(repr(about).encode()).hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class Stages:
    """Finished stages of a fit on given inputs.

    A stage is written to a folder of its own and entered in the manifest only then, so one that
    was cut short is not found and is written anew, elsewhere.  Stages of other inputs or settings
    stay and are not used.  Without a folder nothing is looked up: the stages go where
    :func:`riskloom.session.stage` puts them.
    """

    def __init__(self, spark: SparkSession, inputs: str, folder: str | None = None):
        self.spark, self.inputs = spark, inputs
        self.folder = (folder or f"{shared_folder(spark).rstrip('/')}/riskloom/run-{uuid.uuid4().hex}").rstrip("/")
        self.reused: list[str] = []
        self.written: list[str] = []

    @property
    def manifest(self) -> str:
        return f"{self.folder}/manifest"

    def finished(self) -> dict[str, str]:
        """Path of every finished stage of these inputs: a row per stage."""
        if not path_exists(self.spark, self.manifest):
            return {}
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest)
        return {r["stage"]: r["path"] for r in rows.where(F.col("inputs") == self.inputs).collect()}

    def _place(self, name: str, write: Callable[[str], None]) -> str:
        path = self.finished().get(name)
        if path is not None and path_exists(self.spark, path):
            self.reused.append(name)
            return path
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        write(path)
        entry = self.spark.createDataFrame([(name, self.inputs, path)], MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(self.manifest)
        self.written.append(name)
        return path

    def table(self, df: DataFrame | Callable[[], DataFrame], name: str) -> DataFrame:
        """The stage's table, built only if it is not there."""
        path = self._place(name, lambda path: (df() if callable(df) else df).write.parquet(path))
        return self.spark.read.parquet(path)

    def model(self, name: str, fit: Callable[[], Model], load: Callable[[SparkSession, str], Model]) -> Model:
        """The stage's model, fitted and saved only if it is not there."""
        return load(self.spark, self._place(name, lambda path: fit().save(path)))
