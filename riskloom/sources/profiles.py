"""Storage of fitted statistics: global profile, entity profile, code map."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.moments import center_and_inverse
from riskloom.operators.states import day_states, merge_day_states, state_counts, state_mean_cov, state_profile
from riskloom.operators.velocity import COUNT
from riskloom.schema import TxnColumns, nan_to_null

GLOBAL_SCHEMA = (
    "mean_amt double, std_amt double, mean_dist double, std_dist double, "
    "mahala_mu array<double>, mahala_inv_cov array<array<double>>, mahala_99_pct double"
)
CODE_SCHEMA = "column string, value string, code bigint, freq bigint"


@dataclass(frozen=True)
class GlobalProfile:
    """Scalars and a k-by-k matrix of the fitted table, of fixed size."""

    mean_amt: float
    std_amt: float
    mean_dist: float
    std_dist: float
    mahala_mu: list[float]
    mahala_inv_cov: list[list[float]]
    mahala_99_pct: float

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(self).values())], GLOBAL_SCHEMA)

    @staticmethod
    def from_df(df: DataFrame) -> GlobalProfile:
        return GlobalProfile(**df.first().asDict(recursive=True))


@dataclass(frozen=True)
class ProfileStates:
    """Day states of a table, stored so that later rows are added without reading the earlier ones."""

    states: DataFrame
    cols: TxnColumns
    distance: str = "distance_km"

    @staticmethod
    def of(df: DataFrame, cols: TxnColumns, distance: str = "distance_km") -> ProfileStates:
        """States of a table that has the distance; NaN is null."""
        rows = nan_to_null(df)
        return ProfileStates(day_states(rows, cols.entity, cols.time, cols.amount, distance), cols, distance)

    def merged(self, *later: ProfileStates) -> ProfileStates:
        states = [self.states, *[x.states for x in later]]
        return ProfileStates(merge_day_states(states, self.cols.entity), self.cols, self.distance)

    def counts(self) -> DataFrame:
        return state_counts(self.states, self.cols.entity)

    def entities(self) -> DataFrame:
        return state_profile(self.states, self.cols.entity)

    def mean_cov(self) -> DataFrame:
        return state_mean_cov(self.states, self.cols.entity, [self.cols.amount, self.distance, COUNT])

    def overall(self, cut: float) -> GlobalProfile:
        """The global profile; ``cut``, a quantile of the rows' distances, is no moment and is given."""
        names = [self.cols.amount, self.distance, COUNT]
        row = self.mean_cov().first().asDict()
        center, inverse = center_and_inverse(row, names)
        deviation = [row[f"cov_{n}_{n}"] ** 0.5 for n in names[:2]]
        return GlobalProfile(center[0], deviation[0], center[1], deviation[1], center, inverse, cut)

    def save(self, path: str) -> None:
        """Write the states; a folder that is being read must not be the target."""
        self.states.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, cols: TxnColumns, distance: str = "distance_km") -> ProfileStates:
        return ProfileStates(spark.read.parquet(path), cols, distance)


@dataclass(frozen=True)
class Profiles:
    overall: GlobalProfile
    entities: DataFrame
    codes: DataFrame

    def save(self, path: str) -> None:
        spark = self.entities.sparkSession
        self.overall.to_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/global")
        self.entities.write.mode("overwrite").parquet(f"{path}/entities")
        self.codes.write.mode("overwrite").partitionBy("column").parquet(f"{path}/codes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Profiles:
        overall = spark.read.schema(GLOBAL_SCHEMA).parquet(f"{path}/global")
        codes = spark.read.schema(CODE_SCHEMA).parquet(f"{path}/codes")
        return Profiles(
            GlobalProfile.from_df(overall),
            spark.read.parquet(f"{path}/entities"),
            codes.select("column", "value", "code", "freq"),
        )
