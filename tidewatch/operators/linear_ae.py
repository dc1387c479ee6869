"""Linear autoencoder: principal components as encoder and decoder, reconstruction error as the anomaly measure.

Scaling and components are fitted by ``pyspark.ml``, whose cost per row is independent of the number of rows and
which brings only a features-by-features matrix to the driver. The error is computed with built-in expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.missing import column_means, drop_incomplete, finite_value, value
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.sources.staging import stage

ROBUST_SCALE = 1.4826  # standard deviation of a normal distribution per unit of median absolute deviation


@dataclass(frozen=True)
class LinearAutoencoderModel:
    features: list[str]
    means: dict[str, float | None]
    threshold: float
    stages: PipelineModel

    def reconstruction_error(self, df: DataFrame, output: str = "reconstruction_error") -> DataFrame:
        """Append the squared distance between the scaled row and its projection on the components."""
        absent = [c for c in self.features if c not in df.columns]
        if absent:
            raise ValueError(f"columns missing for scoring: {absent}")
        filled = df.withColumns(
            {f"__x{i}": F.coalesce(finite_value(df, c), F.lit(self.means[c] or 0.0)) for i, c in enumerate(self.features)}
        )
        coded = self.stages.transform(filled)
        # The components are orthonormal: what the code does not keep of the squared length is the error.
        error = F.greatest(_squared_length("__scaled") - _squared_length("__code"), F.lit(0.0))
        helpers = [f"__x{i}" for i in range(len(self.features))]
        return coded.withColumn(output, error).drop("__vector", "__scaled", "__code", *helpers)

    def predict(self, df: DataFrame) -> DataFrame:
        """Append the error, ``prediction`` (-1 above the threshold, 1 otherwise) and ``is_anomaly``."""
        scored = self.reconstruction_error(df)
        above = F.col("reconstruction_error") > F.lit(self.threshold)
        return scored.withColumns({"prediction": F.when(above, -1).otherwise(1), "is_anomaly": above})

    def save(self, spark: SparkSession, path: str) -> None:
        base = path.rstrip("/")
        self.stages.write().overwrite().save(f"{base}/stages")
        known = {k: v for k, v in self.means.items() if v is not None}
        spark.createDataFrame(
            [(self.features, known, self.threshold)],
            "features array<string>, means map<string,double>, threshold double",
        ).coalesce(1).write.mode("overwrite").parquet(f"{base}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearAutoencoderModel:
        base = path.rstrip("/")
        meta = spark.read.parquet(f"{base}/metadata").first()
        means = {c: (meta["means"] or {}).get(c) for c in meta["features"]}
        return LinearAutoencoderModel(
            list(meta["features"]), means, meta["threshold"], PipelineModel.load(f"{base}/stages")
        )


@dataclass(frozen=True)
class LinearAutoencoder:
    """``threshold`` is ``percentile`` (share ``quantile`` of the training error) or ``robust`` (median and MAD)."""

    encoding_dim: int = 16
    threshold: str = "percentile"
    quantile: float = 0.95
    robust_z: float = 3.5

    def fit(
        self, df: DataFrame, features: Sequence[str], *, date_col: str | None = None, validation_split: float = 0.2
    ) -> LinearAutoencoderModel:
        """Fit scaling, components and threshold on the complete rows; with ``date_col`` on the earlier ones only, so that
        the last ``validation_split`` of the rows are judged by a threshold that has not seen them."""
        if self.threshold not in ("percentile", "robust"):
            raise ValueError(f"unknown threshold: {self.threshold!r}")
        features = list(features)
        if date_col:
            df = time_split(df, date_col, validation_split)[0]
        names = [f"__x{i}" for i in range(len(features))]
        # Fitting reads the matrix several times and the features may be costly to derive.
        matrix = stage(df.select(*[finite_value(df, c).alias(n) for n, c in zip(names, features)]), "matrix")
        means = dict(zip(features, column_means(matrix, names).values()))
        clean = drop_incomplete(matrix)
        stages = Pipeline(
            stages=[
                VectorAssembler(inputCols=names, outputCol="__vector"),
                StandardScaler(inputCol="__vector", outputCol="__scaled", withMean=True, withStd=True),
                PCA(k=min(self.encoding_dim, len(features)), inputCol="__scaled", outputCol="__code"),
            ]
        ).fit(clean)
        model = LinearAutoencoderModel(features, means, float("inf"), stages)
        named = clean.toDF(*features)
        errors = model.reconstruction_error(named).select("reconstruction_error")
        return LinearAutoencoderModel(features, means, self._limit(errors), stages)

    def _limit(self, errors: DataFrame) -> float:
        column = "reconstruction_error"
        if self.threshold == "percentile":
            return exact_quantiles(errors, [column], [self.quantile])[column][0]
        median, spread = median_and_mad(errors, column)
        return median + self.robust_z * ROBUST_SCALE * spread


def median_and_mad(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    """Median, and median absolute deviation from it."""
    median = exact_quantiles(df, [column], [0.5])[column][0]
    if median is None:
        return None, None
    distance = df.select(F.abs(value(df, column) - F.lit(median)).alias("d"))
    return median, exact_quantiles(distance, ["d"], [0.5])["d"][0]


def robust_z_flags(df: DataFrame, column: str, threshold: float = 3.5) -> DataFrame:
    """Append ``robust_z`` (distance from the median in scaled MADs) and its flag ``is_anomaly``."""
    median, spread = median_and_mad(df, column)
    usable = spread and math.isfinite(median) and math.isfinite(spread)
    scaled = ROBUST_SCALE * spread if usable else None
    z = (value(df, column) - F.lit(median).cast("double")) / F.lit(scaled).cast("double")
    return df.withColumn("robust_z", z).withColumn("is_anomaly", F.coalesce(F.abs("robust_z") > threshold, F.lit(False)))


def time_split(df: DataFrame, date_col: str, validation_split: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Earlier rows for training and later rows for validation, cut at an exact quantile of time."""
    seconds = F.unix_micros(F.col(date_col).cast("timestamp"))
    cut = exact_quantiles(df.select(seconds.alias("t")), ["t"], [1.0 - validation_split])["t"][0]
    early = seconds <= F.lit(cut)
    return df.where(early), df.where(~early)


def _squared_length(vector: str) -> Column:
    return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda total, x: total + x * x)
