"""The flagship question, end to end on Spark:

"At what threshold is the expected cost lowest, and what is it?"

cases -> data-quality flags -> features (coerce, clip, indicators) -> score
-> split -> threshold sweep + business cost on validation -> read-out on test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import metrics as K
from riskloom.operators import quality as V
from riskloom.operators import thresholds as T
from riskloom.operators.features import FeatureBuilder
from riskloom.operators.split import SplitConfig, assign_splits
from riskloom.plans.common import round_doubles
from riskloom.rules import CASES_COLUMNS as C
from riskloom.sources.cases import fixed_score, load_cases

FP_COST, FN_COST = 1.0, 5.0


def cost_threshold_question(spark: SparkSession, sf_dir: str, fp_cost: float = FP_COST,
                            fn_cost: float = FN_COST) -> DataFrame:
    raw = load_cases(spark, sf_dir).persist()  # read by the quality flags and by the feature / split branch
    flags = V.quality_flags(raw, C)
    built = FeatureBuilder.for_columns(C).transform(raw)
    scored = assign_splits(built, C.id, C.target, SplitConfig()) \
        .select(C.id, C.target, "split", fixed_score(C.utilization, C.income).alias("score")).persist()
    val = scored.where(F.col("split") == "validation")
    sweep = T.threshold_sweep(val, C.target, "score", T.candidate_grid(val, "score"))
    best = T.select_cost_threshold(T.business_cost(sweep, fp_cost, fn_cost), top=1) \
        .select(F.col("threshold"), F.col("average_cost_per_row").alias("validation_average_cost_per_row"),
                F.col("precision").alias("validation_precision"), F.col("recall").alias("validation_recall"),
                F.col("f1").alias("validation_f1"))
    test = K.binary_metrics(scored.where(F.col("split") == "test"), C.target, "score", best.select("threshold"))
    test = test.select(F.col("threshold").alias("_t"),
                       ((F.col("fp") * fp_cost + F.col("fn") * fn_cost) / F.col("row_count"))
                       .alias("test_average_cost_per_row"),
                       F.col("precision").alias("test_precision"), F.col("recall").alias("test_recall"),
                       F.col("f1").alias("test_f1"), F.col("roc_auc").alias("test_roc_auc"),
                       F.col("average_precision").alias("test_average_precision"))
    warn_rows = flags.select(sum((F.col(c) for c in flags.columns), F.lit(0)).alias("quality_warning_hits"))
    out = best.join(test, best["threshold"] == test["_t"]).drop("_t") \
        .withColumn("_one", F.lit(1)).join(warn_rows.withColumn("_one", F.lit(1)), on="_one").drop("_one")
    return round_doubles(out.withColumnRenamed("threshold", "recommended_threshold"))
