"""Exact, tie-aware evaluation of scores and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.ordering import running_totals
from riskloom.session import stage

# Fixed value: keeps the F1 of nothing caught at 0.
F1_GUARD = 1e-9


# --- at a threshold --------------------------------------------------------------------------


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row ``(tp, fp, fn, tn)``."""
    y, p = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    )


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """Rows ``(actual, predicted, count, pct)``, percent of the actual class."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    whole = {0: F.col("tn") + F.col("fp"), 1: F.col("fn") + F.col("tp")}
    rows = F.array(
        *[
            F.struct(
                F.lit(actual).alias("actual"),
                F.lit(predicted).alias("predicted"),
                F.col(cell).alias("count"),
                F.try_divide(100.0 * F.col(cell), whole[actual]).alias("pct"),
            )
            for actual, predicted, cell in cells
        ]
    )
    return counts.select(F.explode(rows).alias("_row")).select("_row.*")


def _ratio(part: Column, whole: Column) -> Column:
    """Zero where undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        precision(tp, fp).alias("precision"), recall(tp, fn).alias("recall"), f1(tp, fp, fn).alias("f1")
    )


def error_rates(counts: DataFrame) -> DataFrame:
    """Missed positives and falsely flagged negatives, in percent."""
    return counts.select(
        (100 * _ratio(F.col("fn"), F.col("fn") + F.col("tp"))).alias("fnr_pct"),
        (100 * _ratio(F.col("fp"), F.col("fp") + F.col("tn"))).alias("fpr_pct"),
    )


def class_report(counts: DataFrame, names: tuple[str, str] = ("Legit", "Fraud")) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    negative = [precision(tn, fn), recall(tn, fp), f1(tn, fn, fp)]
    positive = [precision(tp, fp), recall(tp, fn), f1(tp, fp, fn)]
    n0, n1 = tn + fp, tp + fn
    accuracy = _ratio(tp + tn, n0 + n1)
    nothing = F.lit(None).cast("double")

    def line(name: str, values: Sequence[Column], support: Column) -> Column:
        fields = zip(("precision", "recall", "f1"), values)
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(n) for n, v in fields], support.alias("support")
        )

    rows = [
        line(names[0], negative, n0),
        line(names[1], positive, n1),
        line("accuracy", [nothing, nothing, accuracy], n0 + n1),
        line("macro avg", [(a + b) / 2 for a, b in zip(negative, positive)], n0 + n1),
        line("weighted avg", [_ratio(a * n0 + b * n1, n0 + n1) for a, b in zip(negative, positive)], n0 + n1),
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


# --- over all thresholds ---------------------------------------------------------------------


def score_curve(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with counts at it, at or above it, and in total.

    Columns: group, ``threshold, pos, neg, tp, fp, p, n``.  Rows shrink to distinct scores in
    the map tasks, so a score shared by many rows does not load one task.  The distinct scores
    are stored once; every metric below reads this table.
    """
    group = list(group)
    usable = F.col(score).isNotNull() & ~F.isnan(score)
    scored = df.where(usable).groupBy(*group, F.col(score).alias("threshold"))
    counts = stage(
        scored.agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        ),
        "scores",
    )
    upto = running_totals(
        counts, "threshold", {"_pos": "pos", "_neg": "neg"}, group, {"p": "pos", "n": "neg"}
    )
    return upto.select(
        *group,
        "threshold",
        "pos",
        "neg",
        (F.col("p") - F.col("_pos") + F.col("pos")).alias("tp"),
        (F.col("n") - F.col("_neg") + F.col("neg")).alias("fp"),
        "p",
        "n",
    )


def roc_auc(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; a tied pair counts one half.  Null if a class is missing."""
    below = F.col("n") - F.col("fp")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    pairs = F.max(F.col("p").cast("double") * F.col("n"))
    return curve.groupBy(*group).agg(F.try_divide(won, pairs).alias("auc"))


def average_precision(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of the recall gained there times the precision there."""
    gained = F.try_divide(F.col("pos").cast("double"), F.col("p"))
    at = F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve.groupBy(*group).agg(F.sum(gained * at).alias("average_precision"))


def roc_curve(curve: DataFrame) -> DataFrame:
    """Rows ``(fpr, tpr, threshold)`` for every distinct score, and (0, 0) without threshold."""
    points = curve.select(
        F.try_divide(F.col("fp").cast("double"), F.col("n")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("tpr"),
        F.col("threshold").cast("double").alias("threshold"),
    )
    origin = curve.sparkSession.createDataFrame([(0.0, 0.0, None)], points.schema)
    return points.unionByName(origin)


def pr_curve(curve: DataFrame) -> DataFrame:
    """Rows ``(precision, recall, threshold)`` for every distinct score, and (1, 0)."""
    points = curve.select(
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("p")).alias("recall"),
        F.col("threshold").cast("double").alias("threshold"),
    )
    end = curve.sparkSession.createDataFrame([(1.0, 0.0, None)], points.schema)
    return points.unionByName(end)


def best_f1_threshold(curve: DataFrame, default: float = 0.5) -> DataFrame:
    """The lowest threshold with the best F1, its counts, and the gain over the default."""
    tp, fp = F.col("tp"), F.col("fp")
    p, r = tp / (tp + fp), F.try_divide(tp.cast("double"), F.col("p"))
    scored = curve.select(
        F.col("threshold").cast("double").alias("threshold"),
        p.alias("precision"),
        r.alias("recall"),
        (2 * p * r / (p + r + F1_GUARD)).alias("f1"),
        "tp",
        "fp",
        "p",
        "n",
    )
    # the counts at the default belong to the lowest score that reaches it
    at_default = curve.where(F.col("threshold") >= default).agg(
        F.max_by(f1(tp, fp, F.col("p") - tp), -F.col("threshold"))
    )
    base = F.coalesce(at_default.scalar(), F.lit(0.0))
    best = scored.orderBy(F.desc("f1"), "threshold").limit(1)
    return best.withColumn("gain", F.col("f1") - base)


def eval_summary(curve: DataFrame, threshold: float | None = None) -> DataFrame:
    """AUC, best F1 and its threshold, precision, recall, caught of total, false alarms.

    With ``threshold`` given, the counts are taken at it and ``best_f1`` is the F1 there; above
    the highest score nothing is caught and nothing is a false alarm.
    """
    auc = roc_auc(curve).scalar()
    if threshold is None:
        at = best_f1_threshold(curve)
    else:
        tp, fp = F.col("tp"), F.col("fp")
        at = (
            curve.agg(
                # the counts belong to the lowest score that reaches the threshold
                *[
                    F.coalesce(
                        F.min_by(c, F.when(F.col("threshold") >= threshold, F.col("threshold"))), F.lit(0)
                    ).alias(c)
                    for c in ("tp", "fp")
                ],
                F.coalesce(F.max("p"), F.lit(0)).alias("p"),
            ).select(
                F.lit(float(threshold)).alias("threshold"),
                precision(tp, fp).alias("precision"),
                recall(tp, F.col("p") - tp).alias("recall"),
                f1(tp, fp, F.col("p") - tp).alias("f1"),
                "tp",
                "fp",
                "p",
            )
        )
    return at.select(
        auc.alias("auc"),
        F.col("f1").alias("best_f1"),
        "threshold",
        "precision",
        "recall",
        F.col("tp").alias("caught"),
        F.col("p").alias("fraud_total"),
        F.col("fp").alias("false_alarms"),
    )


def log_loss(df: DataFrame, label: str, probability: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean negative log likelihood, with probabilities kept off 0 and 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))
    return df.groupBy(*group).agg(F.avg(loss).alias("logloss"))


def metrics_report(df: DataFrame, label: str, probability: str, predicted: str) -> DataFrame:
    """The whole report as rows ``(section, metric, class, value)``.

    ``rows`` counts all rows.  A row without a prediction counts as predicted 0; rows without a
    label are in no cell of the confusion, and are counted on a line of their own if there are any.
    """
    settled = df.withColumn(predicted, F.coalesce(F.col(predicted), F.lit(0)))
    counts = confusion(settled, label, predicted)
    every = df.agg(F.count("*").alias("rows"), F.count_if(F.col(label).isNull()).alias("unlabelled"))
    curve = score_curve(df, label, probability)
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def rows(source: DataFrame, section: str, values: dict[str, Column], name: Column | None = None):
        cells = F.array(
            *[
                F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
                for k, v in values.items()
            ]
        )
        of = F.lit("all") if name is None else name
        return (
            source.select(of.alias("class"), F.explode(cells).alias("_cell"))
            .select(F.lit(section).alias("section"), "_cell.metric", "class", "_cell.value")
            .where(F.col("value").isNotNull())
        )

    overall = counts.withColumns(
        {
            "auc": roc_auc(curve).scalar(),
            "ap": average_precision(curve).scalar(),
            "rows": every.select("rows").scalar(),
            "unlabelled": F.nullif(every.select("unlabelled").scalar(), F.lit(0)),
        }
    )
    report = class_report(counts)
    parts = [
        rows(
            overall,
            "dataset",
            {
                "rows": F.col("rows"),
                "unlabelled": F.col("unlabelled"),
                "prevalence_pct": F.try_divide(100.0 * (tp + fn), total),
            },
        ),
        rows(
            overall,
            "metrics",
            {
                "precision": precision(tp, fp),
                "recall": recall(tp, fn),
                "f1": f1(tp, fp, fn),
                "auc_roc": F.col("auc"),
                "avg_precision": F.col("ap"),
            },
        ),
        rows(overall, "confusion", {c: F.col(c) for c in ("tp", "fp", "fn", "tn")}),
        rows(
            report,
            "classes",
            {c: F.col(c) for c in ("precision", "recall", "f1", "support")},
            F.col("class"),
        ),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
