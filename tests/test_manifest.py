"""A fit that is cut short and started again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.txn import COLS, txn
from riskloom.plans import risk
from riskloom.plans.manifest import Stages, fingerprint
from riskloom.plans.risk import PROBABILITY, RiskEstimator, RiskSettings

SETTINGS = RiskSettings(COLS, forest={"trees": 8}, boost={"max_rounds": 2, "depth": 2, "bins": 16})


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return txn(spark, sf_dir).withColumns({"street": F.concat(F.lit("s"), "pos"), "zip": F.col("pos").cast("int")}).cache()


def test_a_fit_goes_on_after_its_last_stage(rows, tmp_path, monkeypatch):
    class Cut(Exception):
        pass

    folder, booster = str(tmp_path / "run"), risk.BoostedTrees

    class Killed:
        def __init__(self, settings):
            pass

        def fit(self, df):
            raise Cut

    monkeypatch.setattr(risk, "BoostedTrees", Killed)
    first = RiskEstimator(SETTINGS, folder)
    with pytest.raises(Cut):
        first.fit(rows)
    done = ["clean", "counts", "entities", "core", "overall", "forest", "enriched", "code-map"]
    assert first.stages.written == done and first.stages.reused == []

    monkeypatch.setattr(risk, "BoostedTrees", booster)
    second = RiskEstimator(SETTINGS, folder)
    model = second.fit(rows.repartition(3))
    assert second.stages.reused == done and second.stages.written == ["booster"]
    whole = RiskEstimator(SETTINGS).fit(rows)
    one, two = (m.transform(rows).select("pos", PROBABILITY, "if_anomaly_score") for m in (model, whole))
    assert one.exceptAll(two).count() == 0 and one.count() == rows.count()

    third = RiskEstimator(SETTINGS, folder)
    third.fit(rows)
    assert third.stages.written == [] and third.stages.reused == [*done, "booster"]


def test_other_rows_or_settings_start_anew(rows, tmp_path):
    one = fingerprint(rows, SETTINGS)
    assert one == fingerprint(rows.repartition(2), SETTINGS)
    assert one != fingerprint(rows.where("pos > 0"), SETTINGS)
    assert one != fingerprint(rows.withColumnRenamed("zip", "zap"), SETTINGS)
    assert one != fingerprint(rows.union(rows.limit(1)), SETTINGS)
    assert one != fingerprint(rows, RiskSettings(COLS))
    assert fingerprint(rows.limit(0)) == fingerprint(rows.limit(0))


def test_columns_that_nothing_reads_are_stored_once(rows, tmp_path):
    estimator = RiskEstimator(SETTINGS, str(tmp_path / "run"))
    model = estimator.fit(rows)
    spark, places = rows.sparkSession, estimator.stages.finished()
    for name in ("core", "enriched"):
        assert not {"street", "zip"} & set(spark.read.parquet(places[name]).columns)
    both = model.enriched.join(rows.select("pos", F.col("street").alias("s"), F.col("zip").alias("z")), "pos")
    assert both.count() == rows.count() and both.where("street <> s or zip <> z").count() == 0


def test_a_stage_without_its_entry_is_written_again(spark, tmp_path):
    stages = Stages(spark, "a", str(tmp_path / "run"))
    built = []

    def table():
        built.append(1)
        return spark.range(3)

    stages.table(table, "x")
    assert Stages(spark, "a", str(tmp_path / "run")).table(table, "x").count() == 3 and len(built) == 1
    assert Stages(spark, "b", str(tmp_path / "run")).table(table, "x").count() == 3 and len(built) == 2

    def fails():
        built.append(1)
        return spark.range(3).select(F.raise_error(F.lit("lost")))

    with pytest.raises(Exception):
        stages.table(fails, "y")
    assert "y" not in stages.finished()
    assert stages.table(table, "y").count() == 3
