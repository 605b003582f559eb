"""Fail-closed batch scoring (B1-B12) as column expressions over all rows at once.

Each raw field becomes a (value, error) pair of expressions; the row's
message is the first failing rule in column order.  Good rows and the error
table come from the same lazy plan; nothing loops over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.columns import NUMERIC_PATTERN, q
from riskloom.rules import CreditColumns

# FIXED VALUES: batch-level messages (row-level ones live in riskloom.rules).
MSG_EMPTY_BATCH = "Uploaded dataframe must contain at least one row."
MSG_DUPLICATE_BATCH = "Duplicate columns are not allowed: {cols}"
MSG_MISSING_BATCH = "Missing required feature columns: {cols}"
MSG_STRICT_BATCH = "Unexpected columns are not allowed in strict mode: {cols}"
MSG_FILE_LEVEL = "Batch dataframe failed file-level validation."
MSG_ROW_LEVEL = "Batch dataframe failed row-level validation."
MSG_UNEXPECTED_FIELDS = "Unexpected applicant fields: {cols}"
MSG_EMPTY_SUMMARY = "Cannot build a batch summary for an empty scored dataframe."
# END FIXED VALUES
NORM_PREFIX = "_norm_"
INFINITY_TEXT = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
SCORE_COLUMNS = ("predicted_probability", "risk_band", "predicted_label_f1_threshold",
                 "predicted_label_cost_threshold", "f1_threshold", "cost_threshold", "selected_candidate_source")


class BatchValidationError(ValueError):
    """A rejected batch.  ``error_rows`` is a DataFrame of every bad row; ``row_errors`` previews its first ones."""

    def __init__(self, message: str, file_errors=None, row_errors=None, error_rows: DataFrame | None = None):
        super().__init__(message)
        self.error_rows = error_rows
        self.file_errors = file_errors or []
        self.row_errors = row_errors or []


def file_level_errors(columns: list[str], raw_features: Sequence[str], strict: bool = False,
                      is_empty: bool = False) -> list[str]:
    """B1 (metadata checks; emptiness is decided by the caller with ``df.isEmpty()``)."""
    errors = []
    if is_empty:
        errors.append(MSG_EMPTY_BATCH)
    seen, dups = set(), []
    for c in columns:
        if c in seen and c not in dups:
            dups.append(c)
        seen.add(c)
    if dups:
        errors.append(MSG_DUPLICATE_BATCH.format(cols=dups))
    missing = [c for c in raw_features if c not in columns]
    if missing:
        errors.append(MSG_MISSING_BATCH.format(cols=missing))
    if strict:
        extra = sorted(set(columns) - set(raw_features))
        if extra:
            errors.append(MSG_STRICT_BATCH.format(cols=extra))
    return errors


def validate_batch(df: DataFrame, raw_features: Sequence[str], strict: bool = False) -> None:
    errors = file_level_errors(df.columns, raw_features, strict, df.isEmpty())
    if errors:
        raise BatchValidationError(MSG_FILE_LEVEL, file_errors=errors)


def check_applicant_fields(fields: Sequence[str], raw_features: Sequence[str]) -> None:
    """Strict single-record mode names unexpected fields, sorted."""
    extra = sorted(set(fields) - set(raw_features))
    if extra:
        raise ValueError(MSG_UNEXPECTED_FIELDS.format(cols=extra))


def _parse_stage(raw: Column, name: str) -> list[Column]:
    """Text, blank flag and parsed number of one field, computed once per row (later rules
    reference these columns instead of re-running the regex and the cast)."""
    text = F.trim(raw.cast("string"))
    return [
        (raw.isNull() | (text == "") | (F.lower(text) == "nan")).alias(f"_blank_{name}"),
        F.lower(text).isin(*INFINITY_TEXT).alias(f"_inf_{name}"),
        F.when(text.rlike(NUMERIC_PATTERN), text.try_cast("double")).alias(f"_num_{name}"),
    ]


def normalize_field(column: str, role: str | None, clip_rules: dict, name: str) -> tuple[Column, Column]:
    """B2 for one field from its parse stage: (normalized value, error message or null)."""
    blank, infinite, parsed = F.col(f"_blank_{name}"), F.col(f"_inf_{name}"), F.col(f"_num_{name}")
    optional = role in R.OPTIONAL_INPUT_ROLES
    integer_like = role in R.INTEGER_LIKE_ROLES
    non_negative = role in R.NON_NEGATIVE_ROLES
    err = F.when(blank, F.lit(None) if optional else F.lit(R.MSG_FIELD_REQUIRED.format(col=column)))
    err = err.when(infinite | parsed.isNull(), F.lit(R.MSG_FIELD_NUMERIC.format(col=column)))
    if role == "age":
        err = err.when(parsed < R.AGE_MIN, F.lit(R.MSG_AGE_MINIMUM))
    elif non_negative:
        err = err.when(parsed < 0, F.lit(R.MSG_FIELD_NON_NEGATIVE.format(col=column)))
    value = parsed
    if integer_like:
        rounded = F.rint(parsed)  # half to even, like Python's round() (Math.rint, no BigDecimal)
        err = err.when(F.abs(parsed - rounded) > R.INTEGER_TOLERANCE, F.lit(R.MSG_FIELD_INTEGER.format(col=column)))
        value = rounded
    lower, upper = clip_rules.get(column, (None, None))
    if lower is not None:
        value = F.greatest(value, F.lit(float(lower)))
    if upper is not None:
        value = F.least(value, F.lit(float(upper)))
    value = F.when(blank, F.lit(None).cast("double")).otherwise(value)
    if integer_like:
        value = F.rint(value).cast("long")
    return value, err


def normalize_batch(df: DataFrame, cols: CreditColumns, raw_features: Sequence[str] | None = None,
                    clip_rules: dict | None = None) -> DataFrame:
    """Adds ``_norm_<feature>`` columns and ``row_error`` (first failing rule in column order)."""
    raw_features = list(raw_features or cols.features)
    clip_rules = cols.clip_rules() if clip_rules is None else clip_rules
    names = {c: f"f{i}" for i, c in enumerate(raw_features)}
    # One-row inline (a Generate node): the parse of each field is evaluated once per row instead of
    # being inlined by the optimizer into every rule that reads it.
    parsed = F.struct(*[e for c in raw_features for e in _parse_stage(q(c), names[c])])
    staged = df.select("*", F.inline(F.array(parsed)))
    values, errors = [], []
    for c in raw_features:
        v, e = normalize_field(c, cols.role_of(c), clip_rules, names[c])
        values.append(v.alias(NORM_PREFIX + c))
        errors.append(e)
    helper = [f"_{k}_{names[c]}" for c in raw_features for k in ("blank", "inf", "num")]
    return staged.select(*[q(c) for c in df.columns], *values, F.coalesce(*errors).alias("row_error")) \
        .drop(*helper)


def row_errors(normalized: DataFrame, key: str) -> DataFrame:
    """One message per bad row."""
    return normalized.where(F.col("row_error").isNotNull()).select(q(key), F.col("row_error").alias("message"))


def risk_band(p: Column, f1_threshold: Column, low_cutoff: float = R.LOW_RISK_CUTOFF) -> Column:
    """B5."""
    return F.when(p < low_cutoff, F.lit(R.BAND_LOW)).when(p < f1_threshold, F.lit(R.BAND_MEDIUM)) \
        .otherwise(F.lit(R.BAND_HIGH))


def enrich(scored: DataFrame, probability: Column, f1_threshold: float, cost_threshold: float,
           source: str, input_columns: Sequence[str], low_cutoff: float = R.LOW_RISK_CUTOFF) -> DataFrame:
    """B4 + B6: raw input columns followed by the seven score columns."""
    p = probability.cast("double")
    t1, t2 = F.lit(float(f1_threshold)), F.lit(float(cost_threshold))
    return scored.select(*[q(c) for c in input_columns],
                         p.alias("predicted_probability"),
                         risk_band(p, t1, low_cutoff).alias("risk_band"),
                         (p >= t1).cast("int").alias("predicted_label_f1_threshold"),
                         (p >= t2).cast("int").alias("predicted_label_cost_threshold"),
                         t1.alias("f1_threshold"), t2.alias("cost_threshold"),
                         F.lit(source).alias("selected_candidate_source"))


def batch_summary(scored: DataFrame) -> DataFrame:
    """One aggregate plus a distributed exact median (linear, like pandas).  Empty input raises
    at run time."""
    from riskloom.functions.cumulative import exact_quantiles
    # read by the median's passes and by the aggregate: kept instead of scoring every row anew for each
    scored = scored.select("predicted_probability", "risk_band", "predicted_label_f1_threshold", "predicted_label_cost_threshold",
                           "selected_candidate_source", "f1_threshold", "cost_threshold").persist()
    n = F.count(F.lit(1))
    high = F.count_if(F.col("risk_band") == R.BAND_HIGH)
    med = exact_quantiles(scored, "predicted_probability", [0.5]) \
        .select(F.col("quantile").alias("median_predicted_probability"), F.lit(1).alias("_one"))
    agg = scored.agg(
        F.when(n == 0, F.raise_error(F.lit(MSG_EMPTY_SUMMARY))).otherwise(n).alias("uploaded_row_count"),
        n.alias("scored_row_count"),
        F.avg("predicted_probability").alias("average_predicted_probability"),
        high.alias("high_risk_row_count"),
        (high / n).alias("high_risk_share"),
        F.sum("predicted_label_f1_threshold").alias("flagged_f1_threshold_count"),
        F.sum("predicted_label_cost_threshold").alias("flagged_cost_threshold_count"),
        F.first("selected_candidate_source").alias("selected_candidate_source"),
        F.first("f1_threshold").alias("f1_threshold"),
        F.first("cost_threshold").alias("cost_threshold"))
    cols = ["uploaded_row_count", "scored_row_count", "average_predicted_probability", "median_predicted_probability",
            "high_risk_row_count", "high_risk_share", "flagged_f1_threshold_count", "flagged_cost_threshold_count",
            "selected_candidate_source", "f1_threshold", "cost_threshold"]
    return agg.withColumn("_one", F.lit(1)).join(med, on="_one", how="left").select(*cols)


def band_distribution(scored: DataFrame) -> DataFrame:
    """B8."""
    return scored.groupBy("risk_band").agg(F.count(F.lit(1)).alias("count"))


def preview(df: DataFrame, key: str, n: int = 50) -> DataFrame:
    """First ``n`` rows by key (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(q(key)).limit(n)


def score_batch(df: DataFrame, cols: CreditColumns, score_fn, f1_threshold: float, cost_threshold: float,
                source: str, key: str | None = None, strict: bool = False, fail_closed: bool = True):
    """B1-B7 end to end.  ``score_fn(normalized_df) -> probability Column`` (model or rule).
    Returns (enriched rows, summary); with ``fail_closed`` any bad row rejects the batch."""
    raw = list(cols.features)
    validate_batch(df, raw, strict)
    norm = normalize_batch(df, cols, raw).persist()
    if fail_closed:
        bad = norm.where(F.col("row_error").isNotNull())
        if not bad.isEmpty():
            k = key or cols.id
            every = row_errors(norm, k)
            raise BatchValidationError(MSG_ROW_LEVEL, row_errors=[r.asDict() for r in preview(every, k).collect()], error_rows=every)
    good = norm.where(F.col("row_error").isNull())
    enriched = enrich(good, score_fn(good), f1_threshold, cost_threshold, source, df.columns)
    return enriched, batch_summary(enriched)
