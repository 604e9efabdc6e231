"""Fitted models.  Their randomness has no SQL counterpart, so SQL follows what does not depend on it:
rows per tree, differences after a reload, the statistics and the report of the whole flow."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window, functions as F

from checks import txn as b
from checks.preparation import SPLIT_SQL
from checks.registry import query, rounded
from checks.statistics import STAGE1, scratch, stage1_sql
from checks.txn import COLS, known, txn
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel, BoostSettings, early_stop
from riskloom.operators.isolation import ForestSettings, IsolationForest, IsolationForestModel
from riskloom.operators.ordering import time_split
from riskloom.plans import enrich, features
from riskloom.plans.risk import RiskEstimator, RiskModel, RiskSettings, forest_features
from riskloom.session import stage


_fitted: dict[tuple, object] = {}


def once(fit):
    """Fit once per application and folder: queries that ask the same model share it."""

    @functools.wraps(fit)
    def found(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir, fit.__name__)
        if key not in _fitted:
            _fitted[key] = fit(spark, sf_dir)
        return _fitted[key]

    return found


def enriched(spark, sf_dir):
    overall, _, core = enrich.fit_stage1(txn(spark, sf_dir), COLS)
    return enrich.global_scores(core, COLS, overall)


def forest(rows) -> IsolationForestModel:
    return IsolationForest(ForestSettings(forest_features(COLS), COLS.key)).fit(rows)


def prepared(spark, sf_dir):
    """Feature table with the time split."""
    table = features.feature_table(txn(spark, sf_dir), COLS)
    split = time_split(table, COLS.time, COLS.key)
    names = features.feature_names(table, COLS)
    return split, BoostSettings(tuple(names), COLS.label)


@once
def boosted(spark, sf_dir) -> tuple[DataFrame, BoostSettings, BoostedTreesModel]:
    """The split feature table, the settings, and the booster fitted by them."""
    split, settings = prepared(spark, sf_dir)
    split = stage(split, "prepared")
    return split, settings, BoostedTrees(settings).fit(split)


@query("iforest_fit")
def iforest_fit(spark, sf_dir):
    return forest(enriched(spark, sf_dir)).nodes


@query(
    "iforest_tree_rows",
    """SELECT t.range AS tree, least(256, (SELECT count(*) FROM events)) AS leaf_rows
    FROM range(100) t""",
)
def iforest_tree_rows(spark, sf_dir):
    """Every tree splits its rows without loss: the leaves' sizes add up to them."""
    leaves = forest(enriched(spark, sf_dir)).nodes.where("left < 0")
    return leaves.groupBy(F.col("tree").cast("long").alias("tree")).agg(F.sum("size").alias("leaf_rows"))


@query("iforest_score")
def iforest_score(spark, sf_dir):
    rows = enriched(spark, sf_dir)
    return forest(rows).transform(rows).select("pos", "is_fraud", "if_anomaly_score")


@query("boost_fit")
def boost_fit(spark, sf_dir):
    """The fitted rounds with their scores, and what the fit decided."""
    _, _, model = boosted(spark, sf_dir)
    decided = {"weight": model.weight, "rounds": model.rounds, "best_round": model.best_round}
    return rounded(model.curve.withColumns({n: F.lit(v) for n, v in decided.items()}))


@query("training_curve")
def training_curve(spark, sf_dir):
    return rounded(boosted(spark, sf_dir)[2].curve)


@query("boost_predict")
def boost_predict(spark, sf_dir):
    table, settings, model = boosted(spark, sf_dir)
    scored = model.transform(table)
    return scored.select(COLS.key, "split", COLS.label, settings.output)


@query("model_store")
def model_store(spark, sf_dir):
    """Scores by the fitted models and by the same models saved and loaded."""
    table, settings, booster = boosted(spark, sf_dir)
    grown = forest(enriched(spark, sf_dir))
    path = scratch(spark, "models")
    grown.save(f"{path}/forest")
    booster.save(f"{path}/booster")
    again = BoostedTreesModel.load(spark, f"{path}/booster").transform(table)
    again = again.select(COLS.key, F.col(settings.output).alias("loaded"))
    both = booster.transform(table).select(COLS.key, settings.output).join(again, COLS.key)
    nodes = IsolationForestModel.load(spark, f"{path}/forest").nodes
    return both.withColumn("nodes", nodes.agg(F.count("*").alias("nodes")).scalar())


@query(
    "boost_rounds",
    f"""SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
      round(CAST(count(*) FILTER (WHERE is_fraud = 0 AND split = 'train') AS DOUBLE)
        / count(*) FILTER (WHERE is_fraud = 1 AND split = 'train'), 6) AS weight,
      0 AS rises, 0 AS missing_rounds, 0 AS weak_splits, 0 AS light_sides, 0 AS late_rounds FROM ({SPLIT_SQL})""",
)
def boost_rounds(spark, sf_dir):
    """What holds of any fit by rounds: the rows and weight it saw, a loss that falls with every tree,
    a tree per round, no split below its bounds, and no round after the stop."""
    table, settings, model = boosted(spark, sf_dir)
    before = F.lag("objective").over(Window.orderBy("round"))  # a row per round
    curve = model.curve.withColumn("rise", (F.col("objective") > before).cast("int"))
    stop = early_stop(model.curve, settings.patience)
    split, inner = F.col("split"), F.col("feature") >= 0
    line = table.agg(F.count_if(split == "train").alias("train_rows"), F.count_if(split == "val").alias("val_rows"))
    trees = model.nodes.agg(F.count_distinct("tree")).scalar()
    return rounded(
        line.withColumns(
            {
                "weight": F.lit(model.weight),
                "rises": curve.agg(F.coalesce(F.sum("rise"), F.lit(0))).scalar(),
                "missing_rounds": F.lit(model.rounds) - trees,
                "weak_splits": model.nodes.agg(F.count_if(inner & (F.col("gain") < settings.min_gain))).scalar(),
                "light_sides": model.nodes.agg(
                    F.count_if((F.col("node") > 0) & (F.col("hessian") < settings.min_weight))
                ).scalar(),
                "late_rounds": model.curve.agg(F.max("round")).scalar() - stop.select("stop_round").scalar(),
            }
        )
    )


def difference(one, other, name: str):
    """One row: rows met on both sides, the largest difference of their scores, and rows in range."""
    both = one.select(COLS.key, name).join(other.withColumnRenamed(name, "_again"), COLS.key)
    gap = F.round(F.max(F.abs(F.col(name) - F.col("_again"))), 9) + F.lit(0.0)
    return both.agg(
        F.count("*").alias("rows"), gap.alias("largest_difference"), F.count_if(F.col(name).between(-1, 1)).alias("within")
    )


@query("iforest_walk", "SELECT count(*) AS rows, 0.0 AS largest_difference, count(*) AS within FROM events")
def iforest_walk(spark, sf_dir):
    """Every score by the packed walk and by the node table walked in joins, some features null."""
    rows = enriched(spark, sf_dir)
    fitted = forest(rows)
    some = rows.withColumn("amt", F.when(F.col("pos") % 10 != 3, F.col("amt")))
    output = fitted.settings.output
    return difference(fitted.transform(some), fitted.transform_by_joins(some, [COLS.key]), output)


@query(
    "boost_walk",
    """SELECT count(*) AS rows, 0.0 AS largest_difference, count(*) AS within,
      count(*) FILTER (WHERE event_id % 10 = 3) AS with_nulls FROM events""",
)
def boost_walk(spark, sf_dir):
    """Every probability by the packed walk and by the node table walked in joins, some features null."""
    table, settings, model = boosted(spark, sf_dir)
    known_ = F.col(COLS.key).cast("long") % 10 != 3
    some = table.withColumns({f: F.when(known_, F.col(f)) for f in settings.features[:4]})
    line = difference(model.transform(some), model.transform_by_joins(some, [COLS.key]), settings.output)
    nulls = some.agg(F.count_if(F.col(settings.features[0]).isNull())).scalar()
    return line.withColumn("with_nulls", nulls)


def risk_model(rows) -> RiskModel:
    return RiskEstimator(RiskSettings(COLS)).fit(rows)


@once
def whole_model(spark, sf_dir) -> RiskModel:
    """The flow fitted on every transaction."""
    return risk_model(txn(spark, sf_dir))


@once
def past_model(spark, sf_dir) -> RiskModel:
    """The flow fitted on the past."""
    return risk_model(known(txn(spark, sf_dir)))


@query("fit_pipeline")
def fit_pipeline(spark, sf_dir):
    """The enriched table that the whole fit leaves behind."""
    return whole_model(spark, sf_dir).enriched


@query("score_pipeline")
def score_pipeline(spark, sf_dir):
    """Fit on the past, save, load, and score every transaction."""
    rows = txn(spark, sf_dir)
    path = scratch(spark, "risk")
    past_model(spark, sf_dir).save(path)
    return RiskModel.load(spark, path).transform(rows)


@query("models_reloaded", "SELECT count(*) AS rows, 0.0 AS largest_difference, count(*) AS within FROM events")
def models_reloaded(spark, sf_dir):
    """Scores of the fitted flow and of the flow saved and loaded, on every transaction."""
    rows = txn(spark, sf_dir)
    path = scratch(spark, "risk")
    model = whole_model(spark, sf_dir)
    model.save(path)
    names = ["pos", "if_anomaly_score", "fraud_probability"]
    before, after = (m.transform(rows).select(*names) for m in (model, RiskModel.load(spark, path)))
    after = after.select("pos", *[F.col(n).alias(f"{n}_after") for n in names[1:]])
    gap = F.greatest(*[F.abs(F.col(n) - F.col(f"{n}_after")) for n in names[1:]])
    return before.join(after, "pos").agg(
        F.count("*").alias("rows"),
        F.max(gap).alias("largest_difference"),
        F.count_if(F.col("fraud_probability").between(0, 1)).alias("within"),
    )


@query("fitted_statistics", stage1_sql("txn"))
def fitted_statistics(spark, sf_dir):
    """The statistics that the whole fit leaves in its table."""
    enriched_rows = whole_model(spark, sf_dir).enriched
    return rounded(enriched_rows.select("pos", "daily_txn_count", *STAGE1, "classical_outlier_flag"))


@query(
    "score_report",
    b.sql(
        """SELECT count(*) AS rows, round(100.0 * sum(is_fraud) / count(*), 6) AS prevalence_pct,
          CAST(sum(is_fraud) AS BIGINT) AS frauds, CAST(count(*) - sum(is_fraud) AS BIGINT) AS others,
          count(*) AS summary_rows FROM txn"""
    ),
)
def score_report(spark, sf_dir):
    """Score every transaction with a flow fitted on the past, and report, as the label is there."""
    rows = txn(spark, sf_dir)
    _, summary, report = past_model(spark, sf_dir).score_and_report(rows)
    at = {
        name: F.sum(F.when((F.col("section") == section) & F.col("metric").isin(*metrics), F.col("value")))
        for name, section, metrics in (
            ("rows", "dataset", ["rows"]),
            ("prevalence_pct", "dataset", ["prevalence_pct"]),
            ("frauds", "confusion", ["tp", "fn"]),
            ("others", "confusion", ["tn", "fp"]),
        )
    }
    line = report.agg(*[v.alias(k) for k, v in at.items()])
    whole = ["rows", "frauds", "others"]
    line = line.withColumns({n: F.col(n).cast("long") for n in whole})
    return rounded(line, "prevalence_pct").withColumn("summary_rows", summary.select("rows").scalar())


@query(
    "score_report_twice",
    """SELECT unnest(['auc_roc', 'avg_precision', 'f1', 'precision', 'recall']) AS metric, 0.0 AS difference""",
)
def score_report_twice(spark, sf_dir):
    """The report's metrics of the scored batch less the same metrics in plain SQL over its rows."""
    rows = txn(spark, sf_dir)
    scored, _, report = past_model(spark, sf_dir).score_and_report(rows)
    scored.createOrReplaceTempView("_scored")
    plain = spark.sql("""WITH at AS (
        SELECT fraud_probability AS p, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg
        FROM _scored GROUP BY fraud_probability),
      upto AS (
        SELECT *, sum(pos) OVER w AS tp, sum(pos + neg) OVER w AS called, (sum(neg) OVER w) - neg / 2 AS above
        FROM at WINDOW w AS (ORDER BY p DESC)),
      flagged AS (
        SELECT sum(is_fraud * fraud_prediction) AS tp, sum(fraud_prediction) AS called, sum(is_fraud) AS pos FROM _scored)
      SELECT stack(5,
        'auc_roc', 1 - (SELECT sum(pos * above) / (sum(pos) * sum(neg)) FROM upto),
        'avg_precision', (SELECT sum(pos * tp / called) / sum(pos) FROM upto),
        'f1', 2D * tp / (called + pos), 'precision', tp / called, 'recall', tp / pos) AS (metric, plain)
      FROM flagged""")
    both = report.where("section = 'metrics'").join(plain, "metric")
    return rounded(both.select("metric", (F.col("value") - F.col("plain")).alias("difference")))
