"""Warehouse layers RAW -> CURATED -> FEATURES -> SERVING.

Each layer is a projection of the previous one (no shuffle) except the
train-split medians of the features layer (one distributed exact quantile,
a two-number result joined back by broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.columns import nan_to_null, q
from riskloom.functions.cumulative import exact_quantiles
from riskloom.rules import CreditColumns

# FIXED VALUES: curated / features layer column names by role (the layer schema).
CURATED_NAMES = {
    "id": "source_row_id", "target": "target_serious_dlqin_2yrs",
    "utilization": "revolving_utilization_unsecured_lines", "age": "age_years",
    "late_30_59": "delinquency_30_59_count", "debt_ratio": "debt_ratio", "income": "monthly_income",
    "open_lines": "open_credit_lines_and_loans_count", "late_90": "times_90_days_late_count",
    "real_estate": "real_estate_loans_or_lines_count", "late_60_89": "delinquency_60_89_count",
    "dependents": "dependents_count",
}
FEATURE_NAMES = {
    "utilization": "revolving_utilization_capped", "age": "age_years_clean",
    "late_30_59": "delinquency_30_59_capped", "debt_ratio": "debt_ratio_capped", "income": "monthly_income_imputed",
    "open_lines": "open_credit_lines_and_loans_count", "late_90": "times_90_days_late_capped",
    "real_estate": "real_estate_loans_or_lines_count", "late_60_89": "delinquency_60_89_capped",
    "dependents": "dependents_count_imputed",
}
WARNING_FLAGS = ("age_implausible_flag", "revolving_utilization_gt_1_flag", "debt_ratio_gt_5_flag",
                 "monthly_income_non_positive_flag", "dependents_negative_flag", "delinquency_extreme_flag")
CURATED_SCHEMA_VERSION = "1.0.0"
# END FIXED VALUES


def row_flags(cols: CreditColumns) -> dict[str, Column]:
    """The warning rules as per-row booleans (false when the value is missing)."""
    def c(role):
        return nan_to_null(q(cols.col(role)))
    f = {
        "age_implausible_flag": (c("age") < R.AGE_MIN) | (c("age") > R.AGE_MAX),
        "revolving_utilization_gt_1_flag": c("utilization") > R.UTILIZATION_MAX,
        "debt_ratio_gt_5_flag": c("debt_ratio") > R.DEBT_RATIO_MAX,
        "monthly_income_missing_flag": c("income").isNull(),
        "monthly_income_non_positive_flag": c("income") <= 0,
        "dependents_missing_flag": c("dependents").isNull(),
        "dependents_negative_flag": c("dependents") < 0,
        "delinquency_extreme_flag": F.greatest(*[c(r) for r in R.DELINQUENCY_ROLES]) > R.DELINQUENCY_MAX,
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in f.items()}


def curate(df: DataFrame, cols: CreditColumns, split: Column | str, table_name: str = "raw_cases",
           with_audit: bool = True) -> DataFrame:
    """L1: rename, cast, lineage, row flags and warning summary."""
    split_col = F.col(split) if isinstance(split, str) else split
    flags = row_flags(cols)
    summary = F.concat_ws("; ", *[F.when(flags[k], F.lit(k.removesuffix("_flag"))) for k in WARNING_FLAGS])
    idc = q(cols.id)
    t = q(cols.target)
    valid = idc.isNotNull() & (t.isNull() | t.isin(0, 1))
    out = [
        F.concat(split_col, F.lit("-"), idc.cast("string")).alias("curated_record_id"),
        split_col.alias("source_dataset_split"),
        F.lit("RAW").alias("source_schema_name"),
        F.lit(table_name).alias("source_table_name"),
        F.lit(CURATED_SCHEMA_VERSION).alias("curated_schema_version"),
        valid.alias("is_valid_row"),
        F.greatest(*[flags[k] for k in WARNING_FLAGS]).alias("has_data_quality_warnings"),
        F.when(summary != "", summary).alias("data_quality_warning_summary"),
        idc.cast("long").alias("source_row_id"),
        t.cast("int").alias(CURATED_NAMES["target"]),
    ]
    for role in R.FEATURE_ROLES:
        dtype = "long" if role in R.INTEGER_LIKE_ROLES and role != "dependents" else "double"
        out.append(nan_to_null(q(cols.col(role))).cast(dtype).alias(CURATED_NAMES[role]))
    out += [v.alias(k) for k, v in flags.items()]
    if with_audit:
        out += [F.current_timestamp().alias("curated_at_utc")]
    return df.select(*out)


def curated_columns() -> CreditColumns:
    n = CURATED_NAMES
    return CreditColumns(id=n["id"], target=n["target"], utilization=n["utilization"], age=n["age"],
                         late_30_59=n["late_30_59"], debt_ratio=n["debt_ratio"], income=n["income"],
                         open_lines=n["open_lines"], late_90=n["late_90"], real_estate=n["real_estate"],
                         late_60_89=n["late_60_89"], dependents=n["dependents"])


def featurize(curated: DataFrame, fit_split: str = "train", pipeline_version: str = "1.0.0",
              schema_version: str = "1.0.0", with_audit: bool = True) -> DataFrame:
    """L2: capped, imputed (medians of the fit split only), indicators and 0/1 flags."""
    cc = curated_columns()
    rules = cc.clip_rules()
    impute = [cc.income, cc.dependents]
    fit = curated.where(F.col("source_dataset_split") == fit_split)
    long = fit.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value"))
                                         for c in impute])))
    med = exact_quantiles(long, "value", [0.5], ["column"]) \
        .groupBy().pivot("column", impute).agg(F.first("quantile")) \
        .select(*[F.col(c).alias(f"_med_{c}") for c in impute]).withColumn("_one", F.lit(1))
    base = curated.withColumn("_one", F.lit(1)).join(F.broadcast(med), on="_one", how="left")
    out = [F.sha2(F.concat_ws("|", F.col("curated_record_id"), F.lit(pipeline_version)), 256).alias("feature_record_id"),
           F.col("curated_record_id"), F.col("source_dataset_split"),
           F.lit(schema_version).alias("feature_schema_version"),
           F.lit(pipeline_version).alias("feature_pipeline_version"),
           F.col(CURATED_NAMES["target"]), F.col("source_row_id")]
    for role in R.FEATURE_ROLES:
        src = CURATED_NAMES[role]
        v = q(src)
        if src in rules:
            lo, hi = rules[src]
            v = F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))
            v = v.cast("long") if role in R.INTEGER_LIKE_ROLES else v
        if src in impute:
            v = F.coalesce(v.cast("double"), F.col(f"_med_{src}"))
        out.append(v.alias(FEATURE_NAMES[role]))
        if role == "income":
            out.append(q(src).isNull().cast("int").alias("monthly_income_missing_indicator"))
        if role == "dependents":
            out.append(q(src).isNull().cast("int").alias("dependents_missing_indicator"))
    for k in ("age_implausible_flag", "revolving_utilization_gt_1_flag", "debt_ratio_gt_5_flag",
              "delinquency_extreme_flag"):
        out.append(F.col(k).cast("int").alias(k))
    if with_audit:
        out.append(F.current_timestamp().alias("featured_at_utc"))
    return base.select(*out)


def prediction_records(features: DataFrame, probability: Column, model_name: str, model_version: str,
                       threshold: float, schema_version: str = "1.0.0", pipeline_version: str = "1.0.0",
                       calibrated: Column | None = None, low_cutoff: float = R.LOW_RISK_CUTOFF,
                       with_audit: bool = True) -> DataFrame:
    """Prediction audit rows keyed by the feature record."""
    p = probability.cast("double")
    t = F.lit(float(threshold))
    out = [
        F.sha2(F.concat_ws("|", F.col("feature_record_id"), F.lit(model_name), F.lit(model_version)), 256)
        .alias("prediction_id"),
        F.col("feature_record_id"), F.col("curated_record_id"), F.col("source_row_id"),
        F.lit(None).cast("string").alias("input_source_identifier"),
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        F.lit(schema_version).alias("feature_schema_version"),
        F.lit(pipeline_version).alias("feature_pipeline_version"),
        p.alias("raw_probability"),
        (calibrated.cast("double") if calibrated is not None else F.lit(None).cast("double"))
        .alias("calibrated_probability"),
        t.alias("decision_threshold"),
        (p >= t).cast("int").alias("predicted_label"),
        F.when(p < low_cutoff, F.lit(R.BAND_LOW)).when(p < t, F.lit(R.BAND_MEDIUM))
        .otherwise(F.lit(R.BAND_HIGH)).alias("risk_band"),
    ]
    if with_audit:
        out.append(F.current_timestamp().alias("scored_at_utc"))
    return features.select(*out)


def register_model_version(registry: DataFrame | None, record: DataFrame) -> DataFrame:
    """L4: append a version row; ``is_active`` marks the latest registration per model name."""
    allv = record if registry is None else registry.drop("is_active").unionByName(record)
    w = Window.partitionBy("model_name")  # one group per model: a handful of versions each
    return allv.withColumn("is_active", F.col("registered_at_utc") == F.max("registered_at_utc").over(w))


def quality_run_records(report: DataFrame, source_layer: str = "RAW", ruleset_version: str = "1.0.0") -> DataFrame:
    """One run record per dataset from a validation report (dataset, severity, rule, message)."""
    def joined(sev):
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col("severity") == sev, F.col("message")))), " | ")
    agg = report.groupBy("dataset").agg(
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"),
        joined("error").alias("error_summary"), joined("warning").alias("warning_summary"))
    return agg.select(
        F.sha2(F.concat_ws("|", F.lit(source_layer), F.col("dataset"), F.lit(ruleset_version)), 256)
        .alias("data_quality_run_id"),
        F.lit(source_layer).alias("source_layer"), F.col("dataset").alias("source_object_name"),
        F.col("dataset").alias("dataset_split"), F.lit(ruleset_version).alias("ruleset_version"),
        F.when(F.col("error_count") > 0, "failed").otherwise("passed").alias("run_status"),
        "error_count", "warning_count",
        F.when(F.col("error_summary") != "", F.col("error_summary")).alias("error_summary"),
        F.when(F.col("warning_summary") != "", F.col("warning_summary")).alias("warning_summary"))
