"""Probability calibration (C1-C5): sigmoid (logistic on the raw score) or isotonic, fitted on a
holdout, applied as a new column, reported raw vs calibrated with one grouped metric job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import binary_metrics

METHODS = ("sigmoid", "isotonic")


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"Unsupported calibration method: {method}")


def fit_calibrator(holdout: DataFrame, y: str, s: str, method: str = "isotonic", C: float = 1.0):
    """C1/C2.  Sigmoid: L2 logistic with regParam = 1 / (C n) on the raw score (lbfgs, no
    standardisation).  Isotonic: increasing fit, linear between knots, clamped outside (Spark's
    IsotonicRegressionModel), the same as clipping out of bounds."""
    _check(method)
    data = holdout.select(F.col(y).cast("double").alias("_y"), F.col(s).cast("double").alias("_s"))
    if method == "isotonic":
        return method, IsotonicRegression(featuresCol="_s", labelCol="_y", isotonic=True).fit(data)
    n = data.count()
    vec = VectorAssembler(inputCols=["_s"], outputCol="_v").transform(data)
    lr = LogisticRegression(featuresCol="_v", labelCol="_y", regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=1000)
    return method, lr.fit(vec)


def apply_calibrator(calibrator, df: DataFrame, s: str, out: str = "calibrated_probability") -> DataFrame:
    """Adds the calibrated probability column."""
    method, model = calibrator
    _check(method)
    cols = df.columns
    if method == "isotonic":
        tmp = df.withColumn("_s", F.col(s).cast("double"))
        return model.setFeaturesCol("_s").setPredictionCol(out).transform(tmp).select(*cols, out)
    tmp = VectorAssembler(inputCols=["_s"], outputCol="_v").transform(df.withColumn("_s", F.col(s).cast("double")))
    res = model.setFeaturesCol("_v").setProbabilityCol("_prob").transform(tmp)
    return res.select(*cols, vector_to_array("_prob")[1].alias(out))


def calibration_report(df: DataFrame, y: str, raw: str, calibrated: str, group_cols: Sequence[str] = ("split",),
                       threshold: float = 0.5) -> DataFrame:
    """C4: full metric bundle for raw and calibrated scores of every group in one grouped job."""
    group_cols = list(group_cols)
    stacked = df.select(*group_cols, y, F.inline(F.array(
        F.struct(F.lit("raw").alias("kind"), F.col(raw).cast("double").alias("_score")),
        F.struct(F.lit("calibrated").alias("kind"), F.col(calibrated).cast("double").alias("_score")))))
    return binary_metrics(stacked, y, "_score", threshold, group_cols + ["kind"])


def improved_brier(report: DataFrame, group_cols: Sequence[str] = ("split",)) -> DataFrame:
    """Calibrated Brier < raw Brier per group."""
    group_cols = list(group_cols)
    p = report.groupBy(*group_cols).pivot("kind", ["raw", "calibrated"]).agg(F.first("brier_score"))
    return p.select(*group_cols, F.col("raw").alias("raw_brier"), F.col("calibrated").alias("calibrated_brier"),
                    (F.col("calibrated") < F.col("raw")).alias("improved_brier"))
