"""A raw scoring upload derived from the ``cases`` relation.

Values arrive as text, as in an uploaded CSV; a few rows carry the bad
inputs the scoring rules must catch (blank optional field, non-numeric
text, a fraction in a count, a negative ratio, NaN in a required field,
infinity).  Doubles are written with six decimals so every engine renders
the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.rules import CASES_COLUMNS as C
from riskloom.sources.cases import load_cases

# (feature, every k-th case, injected text)
INJECTIONS = (
    ("dependents", 97, ""),
    ("income", 89, "abc"),
    ("late_90", 83, "1.5"),
    ("debt_ratio", 79, "-0.5"),
    ("utilization", 73, "NaN"),
    ("open_lines", 71, "inf"),
)
DOUBLE_FEATURES = ("utilization", "debt_ratio", "income", "dependents")


def as_text(col: str, is_double: bool):
    x = F.col(col)
    if is_double:
        r = F.floor(x * 1000000.0 + 0.5) / 1000000.0
        return r.cast("decimal(18,6)").cast("string")
    return x.cast("string")


def build_applications(cases: DataFrame) -> DataFrame:
    cols = [C.id]
    exprs = [F.col(C.id)]
    for f in C.features:
        text = as_text(f, f in DOUBLE_FEATURES)
        for feat, k, bad in INJECTIONS:
            if feat == f:
                text = F.when(F.col(C.id) % k == 0, F.lit(bad)).otherwise(text)
        exprs.append(text.alias(f))
        cols.append(f)
    exprs.append(F.concat(F.lit("C"), F.col(C.id).cast("string")).alias("customer_ref"))
    return cases.select(*exprs)


def load_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_applications(load_cases(spark, sf_dir))


def applications_sql(cases_rel: str = "cases") -> str:
    parts = ["case_id"]
    for f in C.features:
        if f in DOUBLE_FEATURES:
            text = (f"CAST(CAST(floor({f} * 1000000.0 + 0.5) / 1000000.0 AS DECIMAL(18,6)) AS VARCHAR)")
        else:
            text = f"CAST({f} AS VARCHAR)"
        for feat, k, bad in INJECTIONS:
            if feat == f:
                text = f"CASE WHEN case_id % {k} = 0 THEN '{bad}' ELSE {text} END"
        parts.append(f"{text} AS {f}")
    parts.append("concat('C', CAST(case_id AS VARCHAR)) AS customer_ref")
    return f"SELECT {', '.join(parts)} FROM {cases_rel}"
