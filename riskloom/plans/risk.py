"""The whole flow: fit every statistic and model on one table, score another."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.scores import threshold_flag
from riskloom.operators.boosting import BoostedTrees, BoostedTreesModel, BoostSettings
from riskloom.operators.encoding import map_sizes
from riskloom.operators.evaluation import best_f1_threshold, metrics_report, score_curve
from riskloom.operators.isolation import ForestSettings, IsolationForest, IsolationForestModel
from riskloom.operators.ordering import time_split
from riskloom.operators.quality import flag_rate
from riskloom.plans.enrich import fit_stage1, global_scores, stage1_score
from riskloom.plans.features import build_features, clean, feature_names, fit_codes, reference_time
from riskloom.plans.manifest import Stages, fingerprint
from riskloom.schema import TxnColumns, nan_to_null
from riskloom.session import stage
from riskloom.sources.profiles import Profiles

PROBABILITY = "fraud_probability"
PREDICTION = "fraud_prediction"


def forest_features(cols: TxnColumns) -> tuple[str, ...]:
    # What the forest sees, in this order.
    return (
        cols.amount,
        "distance_km",
        "daily_txn_count",
        "global_amt_zscore",
        "user_amt_zscore",
        "user_dist_zscore",
        "user_velocity_zscore",
        "mahalanobis_dist",
    )


def entity_freq(cols: TxnColumns) -> str | None:
    return f"{cols.entity}_freq" if cols.entity in cols.freq_coded else None


@dataclass(frozen=True)
class RiskSettings:
    """``fit_scope`` 'all' fits the statistics on every row, 'train' on the train split only."""

    cols: TxnColumns = field(default_factory=TxnColumns)
    fit_scope: str = "all"
    forest: dict = field(default_factory=dict)
    boost: dict = field(default_factory=dict)


class RiskEstimator(Estimator):
    """Fits all statistics and models.

    With ``folder`` every finished stage is kept there with an entry in a manifest: a fit that was
    cut short and is started again on the same rows and settings goes on after its last stage.
    ``stages`` tells which were written and which reused.
    """

    def __init__(self, settings: RiskSettings = RiskSettings(), folder: str | None = None):
        super().__init__()
        self.settings = settings
        self.folder = folder
        self.stages: Stages | None = None

    def _fit(self, df: DataFrame) -> RiskModel:
        cols, spark = self.settings.cols, df.sparkSession
        inputs = fingerprint(df, self.settings) if self.folder else ""
        self.stages = stages = Stages(spark, inputs, self.folder)
        # repeated rows and ids are gone before the split, so none stands on both sides of it;
        # stored once, as the cuts, the statistics and the rows are read from it
        cleaned = stages.table(lambda: clean(nan_to_null(df), cols), "clean")
        # columns that nothing reads are stored this once and come back with the result
        unread = [c for c in cols.unused if c in cleaned.columns]
        split = time_split(cleaned.drop(*unread), cols.time, cols.key)
        scope = None if self.settings.fit_scope == "all" else F.col("split") == "train"
        # the entity's frequency comes with its profile and needs no join of its own
        overall, entities, core = fit_stage1(split, cols, scope, entity_freq(cols), stages.table)
        enriched = global_scores(core, cols, overall)

        def fitted_on(rows: DataFrame) -> DataFrame:
            return rows if scope is None else rows.where(scope)

        forest_settings = ForestSettings(forest_features(cols), cols.key, **self.settings.forest)
        forest = stages.model(
            "forest", lambda: IsolationForest(forest_settings).fit(fitted_on(enriched)), IsolationForestModel.load
        )
        enriched = stages.table(lambda: forest.transform(enriched), "enriched")

        codes = stages.table(lambda: fit_codes(fitted_on(core), cols, [cols.entity]), "code-map")
        built = build_features(enriched, cols, codes)
        features = tuple(feature_names(built, cols, ["split"]))
        boost_settings = BoostSettings(features, cols.label, **{"key": cols.key, **self.settings.boost})
        booster = stages.model("booster", lambda: BoostedTrees(boost_settings).fit(built), BoostedTreesModel.load)
        valid = booster.transform(built.where("split = 'val'"))
        curve = score_curve(valid, cols.label, booster.settings.output)
        threshold = best_f1_threshold(curve).first()["threshold"]
        model = RiskModel(cols, Profiles(overall, entities, codes), forest, booster, threshold)
        model.enriched = enriched
        if unread:
            model.enriched = enriched.join(cleaned.select(cols.key, *unread), cols.key, "left")
        model.built = built
        return model

    def test_report(self, model: RiskModel, split: str = "test") -> DataFrame:
        """The report of a freshly fitted model on the rows that neither fit nor threshold saw."""
        cols, output = self.settings.cols, model.booster.settings.output
        scored = model.booster.transform(model.built.where(F.col("split") == split))
        flagged = scored.withColumn(PREDICTION, threshold_flag(F.col(output), model.threshold))
        return metrics_report(flagged, cols.label, output, PREDICTION)


class RiskModel(Model):
    """Applies saved statistics, forest and booster to a batch, in that order."""

    def __init__(
        self,
        cols: TxnColumns,
        profiles: Profiles,
        forest: IsolationForestModel,
        booster: BoostedTreesModel,
        threshold: float,
    ):
        super().__init__()
        self.cols = cols
        self.profiles = profiles
        self.forest = forest
        self.booster = booster
        self.threshold = threshold
        self.enriched: DataFrame | None = None
        self.built: DataFrame | None = None
        self._sizes: dict[str, int] | None = None

    def statistics(self, df: DataFrame, unseen: dict[str, float] | None = None) -> DataFrame:
        """Stage 1 scores; ``unseen`` replaces the profile values of entities without a profile."""
        profiles, freq = self.profiles, entity_freq(self.cols)
        return stage1_score(df, self.cols, profiles.overall, profiles.entities, unseen, freq)

    def anomalies(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(df)

    def predictions(self, df: DataFrame, reference: Column | None = None) -> DataFrame:
        """Add probability and prediction to a table that has the anomaly score."""
        if self._sizes is None:
            self._sizes = map_sizes(self.profiles.codes)
        kept = list(df.columns)
        # the model reads coded columns, the result keeps the original ones
        originals = {f"_raw_{c}": F.col(c) for c in (*self.cols.label_coded, self.cols.gender)}
        built = build_features(
            df.withColumns(originals), self.cols, self.profiles.codes, self._sizes, reference
        )
        scored = self.booster.transform(built)
        back = [F.col(f"_raw_{c}").alias(c) if f"_raw_{c}" in originals else F.col(c) for c in kept]
        probability = F.col(self.booster.settings.output)
        return scored.select(*back, probability.alias(PROBABILITY)).withColumn(
            PREDICTION, threshold_flag(F.col(PROBABILITY), self.threshold)
        )

    def score(
        self,
        df: DataFrame,
        reference: Column | None = None,
        unseen: dict[str, float] | None = None,
    ) -> DataFrame:
        """Score a batch.  Ages are taken at ``reference``, by default the batch's latest event."""
        df = nan_to_null(df)
        if reference is None:
            # reads one column of the raw batch, not the scored plan
            reference = reference_time(df, self.cols)
        return self.predictions(self.anomalies(self.statistics(df, unseen)), reference)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.score(df)

    def score_and_report(self, df: DataFrame, **options) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Stored scores, their summary (rows, flagged, percent, score range), and the report if the
        batch has the label."""
        scored = stage(self.score(df, **options), "scored")
        low_high = scored.agg(F.min(PROBABILITY).alias("lowest"), F.max(PROBABILITY).alias("highest"))
        summary = flag_rate(scored, PREDICTION).withColumns(
            {n: low_high.select(n).scalar() for n in ("lowest", "highest")}
        )
        return scored, summary, self.evaluate(scored) if self.cols.label in scored.columns else None

    def evaluate(self, scored: DataFrame) -> DataFrame:
        """The full report of a scored table that has the label."""
        return metrics_report(scored, self.cols.label, PROBABILITY, PREDICTION)

    def save(self, path: str) -> None:
        spark = self.profiles.entities.sparkSession
        self.profiles.save(f"{path}/profiles")
        self.forest.save(f"{path}/forest")
        self.booster.save(f"{path}/booster")
        about = {
            k: list(v) if isinstance(v, tuple) else v
            for k, v in dataclasses.asdict(self.cols).items()
        }
        about["threshold"] = float(self.threshold)
        spark.createDataFrame([about]).coalesce(1).write.mode("overwrite").json(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RiskModel:
        about = spark.read.json(f"{path}/about").first().asDict()
        threshold = about.pop("threshold")
        cols = TxnColumns(**{k: tuple(v) if isinstance(v, list) else v for k, v in about.items()})
        return RiskModel(
            cols,
            Profiles.load(spark, f"{path}/profiles"),
            IsolationForestModel.load(spark, f"{path}/forest"),
            BoostedTreesModel.load(spark, f"{path}/booster"),
            threshold,
        )
