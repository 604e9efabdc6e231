"""Evaluation of scores, and stopping rules on a curve derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import txn as b
from checks.registry import query, rounded
from checks.statistics import scratch
from riskloom.functions.scores import threshold_flag
from riskloom.operators import boosting, evaluation as ev, quality
from riskloom.sources import tables

AT = 0.6


def flagged(spark, sf_dir):
    return b.scores(spark, sf_dir).withColumn("y_pred", threshold_flag(F.col("y_prob"), AT))


def counts(spark, sf_dir):
    return ev.confusion(flagged(spark, sf_dir), "y_true", "y_pred")


def curve(spark, sf_dir):
    return ev.score_curve(b.scores(spark, sf_dir), "y_true", "y_prob")


CONFUSION = f"""conf AS (
  SELECT count(*) FILTER (WHERE y_prob >= {AT} AND y_true = 1) AS tp,
    count(*) FILTER (WHERE y_prob >= {AT} AND y_true = 0) AS fp,
    count(*) FILTER (WHERE y_prob < {AT} AND y_true = 1) AS fn,
    count(*) FILTER (WHERE y_prob < {AT} AND y_true = 0) AS tn FROM scores)"""
METRICS = """met AS (
  SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1,
    CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, CAST(tn AS DOUBLE) / (tn + fn) AS p0,
    CAST(tn AS DOUBLE) / (tn + fp) AS r0, CAST(2 * tn AS DOUBLE) / (2 * tn + fp + fn) AS f0,
    tn + fp AS n0, tp + fn AS n1, tp + fp + fn + tn AS n FROM conf)"""
CURVE = """cnt AS (
  SELECT y_prob AS threshold, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM scores GROUP BY y_prob),
curve AS (
  SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
    sum(neg) OVER (ORDER BY threshold DESC) AS fp,
    sum(neg) OVER (ORDER BY threshold) - neg AS below, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM cnt),
area AS (
  SELECT CAST(sum(pos * (below + neg / 2.0)) AS DOUBLE) / CAST(max(p * n) AS DOUBLE) AS auc,
    sum(CAST(pos AS DOUBLE) / p * tp / (tp + fp)) AS ap FROM curve),
best AS (
  SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS pr, CAST(tp AS DOUBLE) / p AS rc FROM curve),
ranked AS (
  SELECT *, 2 * pr * rc / (pr + rc + 1e-9) AS f1 FROM best)"""
TOP = "top AS (SELECT * FROM ranked ORDER BY f1 DESC, threshold LIMIT 1)"


@query("confusion", b.sql("SELECT * FROM conf", CONFUSION))
def confusion(spark, sf_dir):
    return counts(spark, sf_dir)


@query(
    "confusion_pct",
    b.sql(
        """SELECT 0 AS actual, 0 AS predicted, tn AS count, round(100.0 * tn / n0, 6) AS pct FROM met
        UNION ALL SELECT 0, 1, fp, round(100.0 * fp / n0, 6) FROM met
        UNION ALL SELECT 1, 0, fn, round(100.0 * fn / n1, 6) FROM met
        UNION ALL SELECT 1, 1, tp, round(100.0 * tp / n1, 6) FROM met""",
        CONFUSION,
        METRICS,
    ),
)
def confusion_pct(spark, sf_dir):
    return rounded(ev.confusion_matrix(counts(spark, sf_dir)))


@query(
    "error_rates",
    b.sql(
        "SELECT round(100.0 * fn / n1, 6) AS fnr_pct, round(100.0 * fp / n0, 6) AS fpr_pct FROM met",
        CONFUSION,
        METRICS,
    ),
)
def error_rates(spark, sf_dir):
    return rounded(ev.error_rates(counts(spark, sf_dir)))


@query(
    "precision_recall_f1",
    b.sql(
        "SELECT round(p1, 6) AS precision, round(r1, 6) AS recall, round(f1, 6) AS f1 FROM met",
        CONFUSION,
        METRICS,
    ),
)
def precision_recall_f1(spark, sf_dir):
    return rounded(ev.precision_recall_f1(counts(spark, sf_dir)))


REPORT = """report AS (
  SELECT 'Legit' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, n0 AS support FROM met
  UNION ALL SELECT 'Fraud', round(p1, 6), round(r1, 6), round(f1, 6), n1 FROM met
  UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(tp + tn AS DOUBLE) / n, 6), n FROM met
  UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM met
  UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / n, 6), round((r0 * n0 + r1 * n1) / n, 6),
    round((f0 * n0 + f1 * n1) / n, 6), n FROM met)"""


@query("class_report", b.sql("SELECT * FROM report", CONFUSION, METRICS, REPORT))
def class_report(spark, sf_dir):
    return rounded(ev.class_report(counts(spark, sf_dir)))


@query(
    "flag_rate",
    b.sql(
        f"""SELECT count(*) AS rows, count(*) FILTER (WHERE y_prob >= {AT}) AS flagged,
        round(100.0 * count(*) FILTER (WHERE y_prob >= {AT}) / count(*), 4) AS pct FROM scores"""
    ),
)
def flag_rate(spark, sf_dir):
    return quality.flag_rate(flagged(spark, sf_dir), "y_pred")


@query("roc_auc", b.sql("SELECT round(auc, 8) AS auc FROM area", CURVE))
def roc_auc(spark, sf_dir):
    return rounded(ev.roc_auc(curve(spark, sf_dir)), digits=8)


@query("average_precision", b.sql("SELECT round(ap, 8) AS average_precision FROM area", CURVE))
def average_precision(spark, sf_dir):
    return rounded(ev.average_precision(curve(spark, sf_dir)), digits=8)


@query(
    "roc_curve",
    b.sql(
        """SELECT round(CAST(fp AS DOUBLE) / n, 6) AS fpr, round(CAST(tp AS DOUBLE) / p, 6) AS tpr, threshold FROM curve
        UNION ALL SELECT 0.0, 0.0, NULL""",
        CURVE,
    ),
)
def roc_curve(spark, sf_dir):
    return rounded(ev.roc_curve(curve(spark, sf_dir)), "fpr", "tpr")


@query(
    "pr_curve",
    b.sql(
        """SELECT round(pr, 6) AS precision, round(rc, 6) AS recall, threshold FROM best
        UNION ALL SELECT 1.0, 0.0, NULL""",
        CURVE,
    ),
)
def pr_curve(spark, sf_dir):
    return rounded(ev.pr_curve(curve(spark, sf_dir)), "precision", "recall")


@query(
    "best_f1_threshold",
    b.sql(
        """SELECT threshold, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1,
        CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(p AS BIGINT) AS p, CAST(n AS BIGINT) AS n,
        round(f1 - (SELECT CAST(2 * tp AS DOUBLE) / (tp + fp + p) FROM curve
          WHERE threshold >= 0.5 ORDER BY threshold LIMIT 1), 6) + 0.0 AS gain FROM top""",
        CURVE,
        TOP,
    ),
)
def best_f1_threshold(spark, sf_dir):
    return rounded(ev.best_f1_threshold(curve(spark, sf_dir)))


@query(
    "eval_summary",
    b.sql(
        """SELECT round((SELECT auc FROM area), 6) AS auc, round(f1, 6) AS best_f1, threshold,
        round(pr, 6) AS precision, round(rc, 6) AS recall, CAST(tp AS BIGINT) AS caught,
        CAST(p AS BIGINT) AS fraud_total, CAST(fp AS BIGINT) AS false_alarms FROM top""",
        CURVE,
        TOP,
    ),
)
def eval_summary(spark, sf_dir):
    return rounded(ev.eval_summary(curve(spark, sf_dir)))


@query(
    "metrics_report",
    b.sql(
        """SELECT 'dataset' AS section, 'rows' AS metric, 'all' AS class, CAST(n AS DOUBLE) AS value FROM met
        UNION ALL SELECT 'dataset', 'prevalence_pct', 'all', round(100.0 * n1 / n, 6) FROM met
        UNION ALL SELECT 'metrics', 'precision', 'all', round(p1, 6) FROM met
        UNION ALL SELECT 'metrics', 'recall', 'all', round(r1, 6) FROM met
        UNION ALL SELECT 'metrics', 'f1', 'all', round(f1, 6) FROM met
        UNION ALL SELECT 'metrics', 'auc_roc', 'all', round(auc, 6) FROM area
        UNION ALL SELECT 'metrics', 'avg_precision', 'all', round(ap, 6) FROM area
        UNION ALL SELECT 'confusion', 'tp', 'all', CAST(tp AS DOUBLE) FROM met
        UNION ALL SELECT 'confusion', 'fp', 'all', CAST(fp AS DOUBLE) FROM met
        UNION ALL SELECT 'confusion', 'fn', 'all', CAST(fn AS DOUBLE) FROM met
        UNION ALL SELECT 'confusion', 'tn', 'all', CAST(tn AS DOUBLE) FROM met
        UNION ALL SELECT 'classes', 'precision', class, precision FROM report WHERE precision IS NOT NULL
        UNION ALL SELECT 'classes', 'recall', class, recall FROM report WHERE recall IS NOT NULL
        UNION ALL SELECT 'classes', 'f1', class, f1 FROM report
        UNION ALL SELECT 'classes', 'support', class, CAST(support AS DOUBLE) FROM report""",
        CONFUSION,
        METRICS,
        REPORT,
        CURVE,
    ),
)
def metrics_report(spark, sf_dir):
    return rounded(ev.metrics_report(flagged(spark, sf_dir), "y_true", "y_prob", "y_pred"))


@query(
    "log_loss",
    b.sql(
        """SELECT y_true, round(avg(CASE WHEN y_true = 1 THEN -ln(greatest(y_prob, 1e-15))
        ELSE -ln(1 - y_prob) END), 6) AS logloss FROM scores GROUP BY y_true"""
    ),
)
def log_loss(spark, sf_dir):
    return rounded(ev.log_loss(b.scores(spark, sf_dir), "y_true", "y_prob", ["y_true"]))


@query("predictions_table", b.sql("SELECT y_true, y_prob FROM scores"))
def predictions_table(spark, sf_dir):
    path = scratch(spark, "predictions")
    rows = tables.predictions_table(b.scores(spark, sf_dir), "y_true", "y_prob")
    tables.write_table(rows, path, "csv")
    return tables.read_csv(spark, path, rows.schema)


# --- stopping --------------------------------------------------------------------------------

PATIENCE = 3
STAGES = f"""stages AS (
  SELECT r.round, is_fraud AS y, CASE WHEN trans_date_trans_time < TIMESTAMP '{b.FIT_BEFORE}' THEN 'train' ELSE 'val' END AS part,
    round(round(amt / (amt + 100.0) - CAST(0.6 AS DOUBLE), 3) + round(CAST(0.08 AS DOUBLE) * r.round *
      CASE WHEN hour(trans_date_trans_time) >= 22 OR hour(trans_date_trans_time) <= 5 THEN 1 ELSE 0 END, 2), 3) AS margin
  FROM txn CROSS JOIN (SELECT CAST(range AS INTEGER) AS round FROM range(12)) r),
stage_counts AS (
  SELECT part, round, margin, sum(y) AS pos, sum(1 - y) AS neg FROM stages GROUP BY ALL),
stage_below AS (
  SELECT *, sum(neg) OVER (PARTITION BY part, round ORDER BY margin) - neg AS below FROM stage_counts),
stage_auc AS (
  SELECT part, round, CAST(sum(pos * (below + neg / 2.0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS auc,
    sum(-(pos * ln(1 / (1 + exp(-2 * margin))) + neg * ln(1 - 1 / (1 + exp(-2 * margin))))) / sum(pos + neg) AS loss
  FROM stage_below GROUP BY part, round),
log AS (
  SELECT round, max(auc) FILTER (WHERE part = 'train') AS train_auc, max(auc) FILTER (WHERE part = 'val') AS val_auc,
    max(loss) FILTER (WHERE part = 'train') AS train_loss, max(loss) FILTER (WHERE part = 'val') AS val_loss
  FROM stage_auc GROUP BY round)"""
# AUCs that are equal on paper may differ in the last bit
STOP = f"""rounded AS (SELECT round, round(val_auc, 9) AS val_auc FROM log),
improved AS (
  SELECT *, coalesce(val_auc > max(val_auc) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better
  FROM rounded),
so_far AS (
  SELECT *, max(CASE WHEN better THEN round END) OVER (ORDER BY round) AS best FROM improved),
ended AS (
  SELECT coalesce(min(CASE WHEN round - best >= {PATIENCE} THEN round END), max(round)) AS stop_round,
    coalesce(bool_or(round - best >= {PATIENCE}), false) AS stopped FROM so_far),
stop AS (
  SELECT max(best) AS best_round, max(CASE WHEN better THEN val_auc END) AS best_score, max(stop_round) AS stop_round,
    bool_or(stopped) AS stopped FROM so_far CROSS JOIN ended WHERE round <= stop_round)"""


def stage_log(spark, sf_dir):
    log = boosting.grouped_curve(b.staged_scores(spark, sf_dir), "y", "margin", "part", "round")
    return rounded(log, "val_auc", digits=9)


@query(
    "early_stop",
    b.sql(
        "SELECT best_round, round(best_score, 6) AS best_score, stop_round, stopped FROM stop",
        STAGES,
        STOP,
    ),
)
def early_stop(spark, sf_dir):
    return rounded(boosting.early_stop(stage_log(spark, sf_dir), PATIENCE))


@query(
    "overfit_gap",
    b.sql(
        """SELECT best_round, round(train_auc - val_auc, 6) + 0.0 AS gap,
        CASE WHEN train_auc - val_auc < 0.02 THEN 'not overfitting' WHEN train_auc - val_auc < 0.05
          THEN 'slight overfitting' ELSE 'overfitting' END AS verdict
        FROM log JOIN stop ON log.round = stop.best_round""",
        STAGES,
        STOP,
    ),
)
def overfit_gap(spark, sf_dir):
    log = stage_log(spark, sf_dir)
    return rounded(boosting.overfit_gap(log, boosting.early_stop(log, PATIENCE)))


@query(
    "stage_curve",
    b.sql(
        """SELECT round, round(train_auc, 6) AS train_auc, round(val_auc, 6) AS val_auc,
        round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM log""",
        STAGES,
    ),
)
def stage_curve(spark, sf_dir):
    """The curve operator on stand-in margins, where SQL can follow it."""
    log = boosting.grouped_curve(b.staged_scores(spark, sf_dir), "y", "margin", "part", "round")
    return rounded(log)
