from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import calendar, geo, scores
from riskloom.operators import moments
from riskloom.schema import narrow_types, nan_to_null, require_columns


def one(df):
    return df.first()[0]


def test_haversine_antipodes_same_point_and_null(spark):
    rows = [(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (None, 0.0, 1.0, 1.0), (90.0, 0.0, -90.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = [r[0] for r in df.select(geo.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    half = math.pi * 6371.0
    assert found[0] == pytest.approx(half) and found[1] == 0.0 and found[2] is None
    assert found[3] == pytest.approx(half)


def test_distance_is_kept_if_present(spark):
    df = spark.createDataFrame([(7.0, 1.0)], "distance_km double, lat double")
    assert geo.with_distance(df, "lat", "lat", "lat", "lat").columns == ["distance_km", "lat"]


def test_night_weekend_and_age(spark):
    times = [dt.datetime(2024, 1, 6, 22, 0), dt.datetime(2024, 1, 8, 5, 59), dt.datetime(2024, 1, 8, 6, 0)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    flags = calendar.weekend_night(F.col("t"))
    rows = df.select(*flags.values()).collect()
    assert [tuple(r) for r in rows] == [(1, 1), (0, 1), (0, 0)]
    age = calendar.age_years(F.lit("2000-01-02").cast("date"), F.lit("2024-01-01").cast("date"))
    assert one(df.select(age)) == int((dt.date(2024, 1, 1) - dt.date(2000, 1, 2)).days / 365.25)


def test_zscore_guards(spark):
    df = spark.range(1)
    assert one(df.select(scores.zscore(F.lit(5.0), F.lit(1.0), F.lit(0.0)))) is None
    assert one(df.select(scores.safe_zscore(F.lit(5.0), F.lit(1.0), F.lit(0.0)))) == 0.0
    assert one(df.select(scores.safe_zscore(F.lit(5.0), F.lit(1.0), F.lit(2.0)))) == 2.0


def test_outlier_flag_is_strict_and_ignores_nulls(spark):
    rows = [(3.0, 1.0), (-3.1, 1.0), (None, 1.0), (None, 2.1), (0.0, 2.0)]
    df = spark.createDataFrame(rows, "z double, d double")
    flags = df.select(scores.outlier_flag([F.col("z")], F.col("d"), 2.0))
    assert [r[0] for r in flags.collect()] == [0, 1, 0, 1, 0]


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1)], "x double, y int"))
    assert df.first()[0] is None


def test_gender_default(spark):
    df = spark.createDataFrame([("M",), ("F",), ("x",), (None,)], "g string")
    assert [r[0] for r in df.select(scores.binary_code(F.col("g"), "M", "F")).collect()] == [1, 0, 0, 0]
    open_ = df.select(scores.binary_code(F.col("g"), "M", "F", None))
    assert [r[0] for r in open_.collect()] == [1, 0, None, None]


def test_mahalanobis_against_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 3)) @ np.array([[1, 0.5, 0], [0, 2, 0.3], [0, 0, 0.7]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    row = moments.mean_cov(df, ["a", "b", "c"]).first().asDict()
    center, inverse = moments.center_and_inverse(row, ["a", "b", "c"])
    found = [r[0] for r in df.select(scores.mahalanobis([F.col(c) for c in "abc"], center, inverse)).collect()]
    left = data - data.mean(axis=0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", left, np.linalg.inv(np.cov(data.T)), left))
    assert np.allclose(found, want)


def test_singular_covariance_uses_the_pseudo_inverse(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(4)], "a double, b double")
    row = moments.mean_cov(df, ["a", "b"]).first().asDict()
    _, inverse = moments.center_and_inverse(row, ["a", "b"])
    cov = np.cov(np.array([[i, 2.0 * i] for i in range(4)]).T)
    assert np.allclose(inverse, np.linalg.pinv(cov))


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 300)], "a int, b int")
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["a", "z"])
    assert dict(narrow_types(df, {"a": "smallint", "z": "int"}).dtypes)["a"] == "smallint"
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        narrow_types(df, {"b": "tinyint"}).collect()


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    from riskloom import session

    class Conf:
        def __init__(self, folder):
            self.folder = folder

        def get(self, name, default=None):
            return self.folder if name == "spark.checkpoint.dir" else default

    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, folder):
            self.conf, self.sparkContext = Conf(folder), Context()

    assert session.shared_folder(Session("hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(None))


def test_stage_reads_back_the_same_rows(spark):
    from riskloom.session import stage

    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0, 5))], "a int, t timestamp_ntz")
    assert stage(df, "rows").collect() == df.collect()
