"""Model comparison and champion selection.

Records are built from grouped metric tables (one row per model and
partition) joined to a small configuration table; ranking and the champion
rule are window expressions over one row per model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import rules as R

RECORD_METRICS = ("average_precision", "roc_auc", "ks_statistic", "brier_score", "accuracy", "precision", "recall",
                  "f1")
# FIXED VALUES: champion-rule messages and rationale sentences.
MSG_NO_RECORDS = "Champion selection requires at least one model record."
SENTENCE_RANKED_FIRST = "%s ranked first on validation PR-AUC (%.4f)"
SENTENCE_STRONGEST_TEST = "%s remained strongest on test PR-AUC (%.4f)"
SENTENCE_LOWEST_BRIER = "%s showed the lowest test Brier score (%.4f)"
SENTENCE_THRESHOLDS = "The selected model already includes persisted threshold-selection and cost-analysis artifacts."
SENTENCE_INFERENCE = "The selected model is already wired into both interactive and batch inference paths."
# END FIXED VALUES


@dataclass(frozen=True)
class ModelConfig:
    """One candidate in the comparison."""

    model_key: str
    label: str
    model_family: str
    interactive_inference_supported: bool = False
    batch_inference_supported: bool = False
    designated_champion: bool = False


def config_table(spark: SparkSession, configs: list[ModelConfig]) -> DataFrame:
    return spark.createDataFrame(
        [(c.model_key, c.label, c.model_family, c.interactive_inference_supported, c.batch_inference_supported,
          c.designated_champion) for c in configs],
        "model_key string, label string, model_family string, interactive_inference_supported boolean, "
        "batch_inference_supported boolean, designated_champion boolean")


def model_records(metrics: DataFrame, configs: DataFrame, thresholds: DataFrame | None = None,
                  key: str = "model_key", split_col: str = "split") -> DataFrame:
    """One flat record per configured model: validation_* and test_* metrics, threshold context (nulls when a
    report is absent, so a model without metrics is kept and ranks last) and capability flags."""
    wide = metrics.where(F.col(split_col).isin("validation", "test")).groupBy(key).agg(*[
        F.max(F.when(F.col(split_col) == part, F.col(m))).alias(f"{part}_{m}")
        for part in ("validation", "test") for m in RECORD_METRICS])
    out = configs.join(wide, on=key, how="left")
    if thresholds is not None:
        out = out.join(thresholds, on=key, how="left")
    else:
        out = out.withColumn("f1_threshold", F.lit(None).cast("double")) \
                 .withColumn("cost_threshold", F.lit(None).cast("double"))
    return out


def rank_models(records: DataFrame) -> DataFrame:
    """R2: validation AP, test AP, test AUC, all descending (one row per model: a small window)."""
    w = Window.orderBy(F.col("validation_average_precision").desc(), F.col("test_average_precision").desc(),
                       F.col("test_roc_auc").desc(), F.col("model_key"))
    return records.withColumn("rank", F.row_number().over(w))


def champion_flags(ranked: DataFrame, ap_tolerance: float = R.CHAMPION_AP_TOLERANCE,
                   max_brier: float = R.CHAMPION_MAX_BRIER) -> DataFrame:
    """The designated model (of several, the best-ranked) wins if it is within the AP tolerance of the best on test and
    validation, supports both inference modes, has both thresholds and an acceptable test Brier;
    otherwise the best-ranked model wins.  Adds ``is_champion`` and ``designated_qualifies``."""
    if ranked.isEmpty():
        raise ValueError(MSG_NO_RECORDS)
    w = Window.partitionBy()  # one row per model
    first = F.min(F.when(F.col("designated_champion"), F.col("rank"))).over(w)
    best_val = F.max(F.when(F.col("rank") == 1, F.col("validation_average_precision"))).over(w)
    best_test = F.max(F.when(F.col("rank") == 1, F.col("test_average_precision"))).over(w)
    qualifies = (F.col("designated_champion") & (F.col("rank") == first)
                 & (F.col("test_average_precision") >= best_test - ap_tolerance)
                 & (F.col("validation_average_precision") >= best_val - ap_tolerance)
                 & F.col("interactive_inference_supported") & F.col("batch_inference_supported")
                 & F.col("f1_threshold").isNotNull() & F.col("cost_threshold").isNotNull()
                 & (F.col("test_brier_score") <= max_brier))
    x = ranked.withColumn("designated_qualifies", F.coalesce(qualifies, F.lit(False)))
    any_q = F.max(F.col("designated_qualifies").cast("int")).over(w)
    champ = F.when(any_q == 1, F.col("designated_qualifies")).otherwise(F.col("rank") == 1)
    return x.withColumn("is_champion", champ)


def comparison_table(flagged: DataFrame) -> DataFrame:
    """R4."""
    cols = ["rank", "model_key", "label", "model_family"] + \
        [f"{p}_{m}" for p in ("validation", "test") for m in ("average_precision", "roc_auc", "ks_statistic",
                                                              "brier_score")] + \
        ["f1_threshold", "cost_threshold", "interactive_inference_supported", "batch_inference_supported",
         "designated_champion", "is_champion"]
    return flagged.select(*cols)


def rationale(flagged: DataFrame) -> DataFrame:
    """The champion's sentences, each emitted only when it is true."""
    w = Window.partitionBy()
    lowest_brier = F.min("test_brier_score").over(w)
    best_test = F.max("test_average_precision").over(w)
    x = flagged.withColumn("_lb", lowest_brier).withColumn("_bt", best_test).where(F.col("is_champion"))
    sentences = F.array(
        F.when(F.col("rank") == 1, F.format_string(SENTENCE_RANKED_FIRST, F.col("label"),
                                                   F.col("validation_average_precision"))),
        F.when(F.col("test_average_precision") == F.col("_bt"),
               F.format_string(SENTENCE_STRONGEST_TEST, F.col("label"), F.col("test_average_precision"))),
        F.when(F.col("test_brier_score") == F.col("_lb"),
               F.format_string(SENTENCE_LOWEST_BRIER, F.col("label"), F.col("test_brier_score"))),
        F.when(F.col("f1_threshold").isNotNull(), F.lit(SENTENCE_THRESHOLDS)),
        F.when(F.col("interactive_inference_supported") & F.col("batch_inference_supported"),
               F.lit(SENTENCE_INFERENCE)))
    return x.select("model_key", F.posexplode(F.filter(sentences, lambda s: s.isNotNull())).alias("point", "sentence"))
