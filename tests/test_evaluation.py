from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskloom.functions.scores import outlier_flag, threshold_flag
from riskloom.operators import boosting, evaluation as ev


@pytest.fixture(scope="module")
def scored(spark):
    """Two thirds of the rows share a score."""
    rng = np.random.default_rng(9)
    rows = [(int(rng.random() < 0.2), 0.25 if i % 3 else float(np.round(rng.random(), 2))) for i in range(900)]
    return spark.createDataFrame(rows, "y int, s double").repartition(7).cache()


def brute(rows):
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, n = ((s >= t) & (y == 1)).sum(), (s >= t).sum()
        ap, last = ap + (tp / len(pos) - last) * tp / n, tp / len(pos)
    return auc, ap


def test_areas_against_brute_force(scored):
    curve = ev.score_curve(scored, "y", "s")
    auc, ap = brute(scored.collect())
    assert ev.roc_auc(curve).first()[0] == pytest.approx(auc, abs=1e-12)
    assert ev.average_precision(curve).first()[0] == pytest.approx(ap, abs=1e-12)


def test_auc_equals_the_library_evaluator(scored):
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    curve = ev.score_curve(scored, "y", "s")
    assert ev.roc_auc(curve).first()[0] == pytest.approx(evaluator.evaluate(scored.withColumn("y", F.col("y").cast("double"))))


def test_rows_without_score_or_label_are_reported(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (None, 0.8), (1, float("nan"))]
    df = spark.createDataFrame(rows, "y int, p double")
    df = df.withColumn("flag", threshold_flag(F.col("p"), 0.5))
    found = {(r["section"], r["metric"], r["class"]): r["value"] for r in ev.metrics_report(df, "y", "p", "flag").collect()}
    assert found["dataset", "rows", "all"] == 5 and found["dataset", "unlabelled", "all"] == 1
    assert [found["confusion", c, "all"] for c in ("tp", "fp", "fn", "tn")] == [1, 0, 2, 1]


def test_summary_above_the_highest_score(spark):
    df = spark.createDataFrame([(1, 0.4), (0, 0.2)], "y int, p double")
    row = ev.eval_summary(ev.score_curve(df, "y", "p"), 0.9).first()
    assert (row["caught"], row["fraud_total"], row["false_alarms"]) == (0, 1, 0)
    assert (row["precision"], row["recall"], row["best_f1"], row["threshold"]) == (0.0, 0.0, 0.0, 0.9)


def test_nan_never_flags(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (5.0,), (1.0,)], "z double")
    flag = outlier_flag([F.col("z")], F.col("z"), 4.0)
    assert [r[0] for r in df.select(flag).collect()] == [0, 0, 1, 0]


def test_known_numbers(spark):
    """Four counts give every figure of the published report."""
    counts = spark.createDataFrame([(7115, 161, 391, 1289008)], "tp long, fp long, fn long, tn long")
    row = ev.precision_recall_f1(counts).first()
    assert [round(v, 4) for v in row] == [0.9779, 0.9479, 0.9627]
    report = {r["class"]: r for r in ev.class_report(counts).collect()}
    assert report["Legit"]["support"] == 1289169 and report["Fraud"]["support"] == 7506
    assert report["accuracy"]["support"] == 1296675
    assert [round(report["Fraud"][c], 2) for c in ("precision", "recall", "f1")] == [0.98, 0.95, 0.96]
    assert [round(report["macro avg"][c], 2) for c in ("precision", "recall", "f1")] == [0.99, 0.97, 0.98]
    assert round(100 * 7506 / 1296675, 4) == 0.5789


def test_undefined_ratios_are_zero(spark):
    counts = spark.createDataFrame([(0, 0, 0, 5)], "tp long, fp long, fn long, tn long")
    assert tuple(ev.precision_recall_f1(counts).first()) == (0.0, 0.0, 0.0)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "y int, s double")
    assert ev.roc_auc(ev.score_curve(df, "y", "s")).first()[0] is None


def test_equal_scores(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.5)], "y int, s double")
    curve = ev.score_curve(df, "y", "s")
    assert ev.roc_auc(curve).first()[0] == 0.5
    assert {(r["fpr"], r["tpr"]) for r in ev.roc_curve(curve).collect()} == {(0.0, 0.0), (1.0, 1.0)}


def test_best_threshold_is_the_lowest_on_ties(spark):
    # 0.9 and 0.4 both give F1 = 2/3
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.6), (1, 0.4)], "y int, s double")
    best = ev.best_f1_threshold(ev.score_curve(df, "y", "s")).first()
    assert best["threshold"] == 0.4 and best["f1"] == pytest.approx(2 / 3)
    assert best["gain"] == pytest.approx(2 / 3 - 0.4)


def test_summary_at_a_given_threshold(scored):
    curve = ev.score_curve(scored, "y", "s")
    row = ev.eval_summary(curve, 0.305).first()
    rows = scored.collect()
    assert row["caught"] == sum(1 for y, s in rows if s >= 0.305 and y)
    assert row["false_alarms"] == sum(1 for y, s in rows if s >= 0.305 and not y)


def test_null_scores_are_left_out(spark):
    df = spark.createDataFrame([(1, None), (1, 0.9), (0, 0.1)], "y int, s double")
    assert ev.roc_auc(ev.score_curve(df, "y", "s")).first()[0] == 1.0


def curve_of(spark, values):
    rows = [(i, v + 0.01, v, 0.5, 0.5) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "round int, train_auc double, val_auc double, train_loss double, val_loss double")


def test_early_stop_needs_strict_improvement(spark):
    curve = curve_of(spark, [0.5, 0.7, 0.7, 0.6, 0.7, 0.9])
    stop = boosting.early_stop(curve, 3).first()
    assert tuple(stop) == (1, 0.7, 4, True)
    assert boosting.overfit_gap(curve, boosting.early_stop(curve, 3)).first()["verdict"] == "not overfitting"
    assert tuple(boosting.early_stop(curve, 10).first()) == (5, 0.9, 5, False)


def test_early_stop_at_published_rounds(spark):
    # best round 186 and last round 216 of the published log: patience 30
    values = [0.9876 + i * 6e-5 for i in range(187)] + [0.9987834356697546] * 31
    values[186] = 0.9988053742909813
    stop = boosting.early_stop(curve_of(spark, values), 30).first()
    assert (stop["best_round"], stop["stop_round"], stop["stopped"]) == (186, 216, True)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.4)], "y int, p double")
    want = -(np.log(0.8) + np.log(0.6)) / 2
    assert ev.log_loss(df, "y", "p").first()[0] == pytest.approx(want)
