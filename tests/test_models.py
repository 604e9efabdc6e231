from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.txn import COLS, known, txn
from riskloom.operators import evaluation as ev
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel, BoostSettings, early_stop
from riskloom.operators.isolation import ForestSettings, IsolationForest, IsolationForestModel
from riskloom.operators.ordering import time_split
from riskloom.plans import enrich, features
from riskloom.plans.risk import PREDICTION, PROBABILITY, RiskEstimator, RiskModel, RiskSettings

# --- forest ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cloud(spark):
    """A dense cloud and five far points."""
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(0, 1, 2))) for i in range(2000)]
    rows += [(2000 + i, 12.0 + i, -15.0 - i) for i in range(5)]
    return spark.createDataFrame(rows, "id bigint, a double, b double").repartition(6).cache()


@pytest.fixture(scope="module")
def forest(cloud):
    return IsolationForest(ForestSettings(("a", "b"), "id", "score", trees=60)).fit(cloud)


def test_trees_partition_their_rows(forest):
    nodes = forest.nodes.toPandas()
    assert set(nodes["tree"]) == set(range(60)) and (nodes["depth"] <= 8).all()
    leaves = nodes[nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == 256).all()
    assert (nodes.groupby("tree").size() == 2 * leaves.groupby("tree").size() - 1).all()


def test_far_points_score_lowest(cloud, forest):
    scored = forest.transform(cloud)
    lowest = [r["id"] for r in scored.orderBy("score").limit(5).collect()]
    assert set(lowest) == set(range(2000, 2005))
    share = scored.where("score < 0").count() / 2005
    assert 0.005 <= share <= 0.015


def test_forest_is_the_same_in_any_layout(cloud, forest):
    again = IsolationForest(forest.settings).fit(cloud.repartition(1))
    assert again.nodes.exceptAll(forest.nodes).count() == 0 and again.offset == forest.offset


def test_walk_equals_node_by_node(cloud, forest):
    """The packed walk against following child pointers."""
    nodes = {(r["tree"], r["node"]): r for r in forest.nodes.collect()}
    rows = cloud.orderBy("id").limit(40).toPandas()
    from riskloom.operators.isolation import mean_search_depth

    lengths = []
    for point in rows[["a", "b"]].to_numpy():
        total = 0.0
        for tree in range(60):
            node = nodes[tree, 0]
            while node["feature"] >= 0:
                left = point[node["feature"]] <= node["threshold"]
                node = nodes[tree, node["left"] if left else node["right"]]
            total += node["depth"] + float(mean_search_depth(node["size"]))
        lengths.append(total / 60)
    packed = forest.packed().value.mean_length(rows[["a", "b"]].to_numpy())
    assert np.allclose(packed, lengths)


def test_forest_store(spark, cloud, forest, tmp_path):
    forest.save(str(tmp_path / "f"))
    back = IsolationForestModel.load(spark, str(tmp_path / "f"))
    assert back.settings == forest.settings
    one, two = forest.transform(cloud), back.transform(cloud)
    assert one.exceptAll(two).count() == 0


def test_tiny_and_constant_samples(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(3)], "id int, a double")
    model = IsolationForest(ForestSettings(("a",), "id", "score", trees=5)).fit(df)
    assert [r["score"] for r in model.transform(df).collect()] == [0.0] * 3


# --- booster ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    table = features.feature_table(txn(spark, sf_dir.replace("0.001", "0.01")), COLS)
    return time_split(table, COLS.time, COLS.key).cache()


def settings(prepared, **changes):
    names = tuple(features.feature_names(prepared, COLS, ["split"]))
    base = {"max_rounds": 8, "depth": 4, "bins": 64, "patience": 30, "step": 0.3}
    return BoostSettings(names, COLS.label, **{**base, **changes})


@pytest.fixture(scope="module")
def boosted(prepared):
    return BoostedTrees(settings(prepared)).fit(prepared)


def test_feature_table_is_numeric(prepared):
    names = features.feature_names(prepared, COLS, ["split"])
    kinds = dict(prepared.dtypes)
    assert all(kinds[n] in ("int", "bigint", "double") for n in names)
    assert prepared.select([F.count_if(F.col(n).isNull()) for n in names]).first() == tuple([0] * len(names))


def test_booster_beats_the_amount(prepared, boosted):
    test = boosted.transform(prepared.where("split = 'test'"))
    ours = ev.roc_auc(ev.score_curve(test, COLS.label, "fraud_probability")).first()[0]
    amount = ev.roc_auc(ev.score_curve(test, COLS.label, "amt")).first()[0]
    assert ours > amount


def test_curve_ends_at_the_predictions(prepared, boosted):
    last = boosted.curve.where("round = 7").first()
    val = boosted.transform(prepared.where("split = 'val'"))
    assert ev.roc_auc(ev.score_curve(val, COLS.label, "fraud_probability")).first()[0] == pytest.approx(last["val_auc"])
    assert ev.log_loss(val, COLS.label, "fraud_probability").first()[0] == pytest.approx(last["val_loss"])


def test_training_ends_with_the_stop(prepared):
    model = BoostedTrees(settings(prepared, patience=1, max_rounds=16)).fit(prepared)
    best = BoostedTrees(settings(prepared, patience=1, max_rounds=16, rounds="best")).fit(prepared)
    assert best.rounds == best.best_round + 1 == best.nodes.select("tree").distinct().count()
    stop = early_stop(model.curve, 1).first()
    assert stop["stopped"] and model.rounds == model.curve.count() == stop["stop_round"] + 1 < 16
    assert model.best_round == stop["best_round"]
    val = model.transform(prepared.where("split = 'val'"))
    last = model.curve.where(F.col("round") == model.rounds - 1).first()
    assert ev.roc_auc(ev.score_curve(val, COLS.label, "fraud_probability")).first()[0] == pytest.approx(last["val_auc"])


def test_booster_store(spark, prepared, boosted, tmp_path):
    boosted.save(str(tmp_path / "b"))
    back = BoostedTreesModel.load(spark, str(tmp_path / "b"))
    assert back.settings == boosted.settings and back.rounds == boosted.rounds
    assert boosted.transform(prepared).exceptAll(back.transform(prepared)).count() == 0


# --- the whole flow --------------------------------------------------------------------------

BOOST = {"max_rounds": 4, "depth": 3, "bins": 32}


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return txn(spark, sf_dir.replace("0.001", "0.01")).cache()


@pytest.fixture(scope="module")
def model(rows):
    return RiskEstimator(RiskSettings(COLS, forest={"trees": 20}, boost=BOOST)).fit(rows)


def test_scoring_the_fitted_rows_repeats_the_enrichment(rows, model):
    names = ["pos", "daily_txn_count", "classical_outlier_flag", "user_amt_zscore", "if_anomaly_score"]
    fitted = model.enriched.select(*names)
    scored = model.anomalies(model.statistics(rows)).select(*names)
    both = fitted.join(scored.toDF(*["pos", *[f"{n}_2" for n in names[1:]]]), "pos")
    wrong = " or ".join(f"abs({n} - {n}_2) > 1e-9" for n in names[1:])
    assert both.count() == rows.count() and both.where(wrong).count() == 0


def test_whole_model_store(spark, rows, model, tmp_path):
    model.save(str(tmp_path / "m"))
    back = RiskModel.load(spark, str(tmp_path / "m"))
    assert back.cols == COLS and back.threshold == model.threshold
    names = ["pos", "category", "gender", PROBABILITY, PREDICTION]
    one, two = model.transform(rows), back.transform(rows)
    assert one.columns == two.columns
    assert one.select(*names).exceptAll(two.select(*names)).count() == 0
    assert one.select("pos", "category", "gender").exceptAll(rows.select("pos", "category", "gender")).count() == 0
    report = model.evaluate(one)
    assert report.where("metric = 'auc_roc'").first()["value"] > 0.9


def test_batch_without_label_and_with_unseen_values(rows, model):
    batch = rows.drop("is_fraud").withColumns({"category": F.lit("new"), "cc_num": F.col("cc_num") + 10**9})
    scored = model.transform(batch)
    assert scored.count() == rows.count() and scored.where(f"{PROBABILITY} is null").count() == 0


def test_fit_scope_train_ignores_later_rows(rows):
    split = time_split(rows, COLS.time, COLS.key)
    overall, entities, core = enrich.fit_stage1(split, COLS, F.col("split") == "train")
    alone, entities_alone, _ = enrich.fit_stage1(split.where("split = 'train'"), COLS)
    assert entities.exceptAll(entities_alone).count() == 0
    assert overall.mean_amt == pytest.approx(alone.mean_amt) and core.count() == rows.count()


def test_unseen_cards_in_known_history(rows):
    entities = enrich.fit_entities(known(rows), COLS)
    scored = enrich.entity_scores(rows, COLS, entities)
    unseen = scored.join(entities, "cc_num", "left_anti")
    assert unseen.count() > 0 and unseen.where("user_amt_zscore <> amt").count() == 0


def test_registered_queries_fit_by_the_defaults(spark, sf_dir):
    from checks import models

    _, settings = models.prepared(spark, sf_dir)
    assert settings == BoostSettings(settings.features, settings.label)
    assert (settings.max_rounds, settings.depth, settings.bins, settings.patience) == (500, 8, 256, 30)
