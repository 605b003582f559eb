"""Registered queries: one per operator group of the blueprint, each with its oracle SQL.

Every query reads the driver's tables (through the derived ``cases``
relation or directly) over whole tables; no row caps except where a top-k
is the operator itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.operators import contracts as CT
from riskloom.operators import metrics as K
from riskloom.operators import profile as E
from riskloom.operators import quality as V
from riskloom.operators import split as P
from riskloom.operators import thresholds as T
from riskloom.plans import sql as S
from riskloom.plans.common import C, cases, round_doubles, scored_cases, split_cases
from riskloom.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


FEATURES = list(C.features)
DOUBLE_FEATURES = ["utilization", "debt_ratio", "income", "dependents"]

# ---------------------------------------------------------------- S1: cases
_CASES_ORACLE = S.with_cases(S.round_select(
    "cases", ["case_id", "target", "age", "late_30_59", "open_lines", "late_90", "real_estate", "late_60_89"],
    DOUBLE_FEATURES))


@register("cases", _CASES_ORACLE)
def q_cases(spark, sf):
    return round_doubles(cases(spark, sf))


# ---------------------------------------------------------------- V10 / V11 / V3
_FLAG_NAMES = ["age_below_18_count", "age_above_100_count", "revolving_utilization_above_1_count",
               "debt_ratio_above_5_count", "monthly_income_non_positive_count", "dependents_negative_count",
               "delinquency_above_20__late_30_59", "delinquency_above_20__late_60_89",
               "delinquency_above_20__late_90"]
_FLAG_SQL = {
    "age_below_18_count": "age < 18", "age_above_100_count": "age > 100",
    "revolving_utilization_above_1_count": "utilization > 1.0", "debt_ratio_above_5_count": "debt_ratio > 5.0",
    "monthly_income_non_positive_count": "income <= 0", "dependents_negative_count": "dependents < 0",
    "delinquency_above_20__late_30_59": "late_30_59 > 20", "delinquency_above_20__late_60_89": "late_60_89 > 20",
    "delinquency_above_20__late_90": "late_90 > 20",
}


def _flags_sql(rel: str = "cases") -> str:
    return "SELECT " + ", ".join(f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
                                 for name, cond in _FLAG_SQL.items()) + f" FROM {rel}"


@register("quality_flags", S.with_cases(_flags_sql()))
def q_quality_flags(spark, sf):
    return V.quality_flags(cases(spark, sf), C)


def _warnings_sql(flags_rel: str) -> str:
    d = ("concat('Detected rows with unusually large delinquency counts in: ', "
         "array_to_string(list_sort(list_filter(["
         "CASE WHEN delinquency_above_20__late_30_59 > 0 THEN 'late_30_59' END, "
         "CASE WHEN delinquency_above_20__late_60_89 > 0 THEN 'late_60_89' END, "
         "CASE WHEN delinquency_above_20__late_90 > 0 THEN 'late_90' END], lambda x: x IS NOT NULL)), ', '), '.')")
    rows = [
        ("age_below_18_count", "age_below_18_count",
         "CASE WHEN age_below_18_count > 0 THEN concat('Detected ', age_below_18_count, ' rows with age below 18.') END"),
        ("age_above_100_count", "age_above_100_count",
         "CASE WHEN age_above_100_count > 0 THEN concat('Detected ', age_above_100_count, ' rows with age above 100.') END"),
        ("revolving_utilization_above_1_count", "revolving_utilization_above_1_count",
         f"CASE WHEN revolving_utilization_above_1_count > 0 THEN '{R.MSG_UTILIZATION}' END"),
        ("debt_ratio_above_5_count", "debt_ratio_above_5_count",
         f"CASE WHEN debt_ratio_above_5_count > 0 THEN '{R.MSG_DEBT_RATIO}' END"),
        ("monthly_income_non_positive_count", "monthly_income_non_positive_count",
         f"CASE WHEN monthly_income_non_positive_count > 0 THEN '{R.MSG_INCOME}' END"),
        ("dependents_negative_count", "dependents_negative_count",
         f"CASE WHEN dependents_negative_count > 0 THEN '{R.MSG_DEPENDENTS}' END"),
        ("delinquency_count_above_20",
         "delinquency_above_20__late_30_59 + delinquency_above_20__late_60_89 + delinquency_above_20__late_90",
         f"CASE WHEN delinquency_above_20__late_30_59 + delinquency_above_20__late_60_89 "
         f"+ delinquency_above_20__late_90 > 0 THEN {d} END"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST({cnt} AS BIGINT) AS count, {msg} AS message FROM {flags_rel}"
        for rule, cnt, msg in rows)


@register("quality_warnings", S.with_cases(_warnings_sql("flags"), f"flags AS ({_flags_sql()})"))
def q_quality_warnings(spark, sf):
    return V.warning_rows(V.quality_flags(cases(spark, sf), C), C)


_ALL_CASE_COLS = ["case_id", "target", "utilization", "age", "late_30_59", "debt_ratio", "income", "open_lines",
                  "late_90", "real_estate", "late_60_89", "dependents"]


@register("missing_counts", S.with_cases(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing_count FROM cases"
    for c in sorted(_ALL_CASE_COLS))))
def q_missing_counts(spark, sf):
    return V.missing_counts(cases(spark, sf))


# ---------------------------------------------------------------- V4-V9, V15
def _validation_inputs(spark, sf):
    df = cases(spark, sf)
    contracts = CT.contracts_for(C)
    test_df = df.withColumn(C.target, F.lit(None).cast("int"))
    return {"train": (df, contracts["train"]), "test": (test_df, contracts["test"])}


def _validation_sql() -> str:
    w = _warnings_sql("flags")
    return f"""
SELECT 'train' AS dataset, 'warning' AS severity, 'id_not_unique' AS rule, '{R.MSG_ID_NOT_UNIQUE}' AS message
FROM cases HAVING count(DISTINCT case_id) + least(count(*) - count(case_id), 1) <> count(*)
UNION ALL
SELECT 'train', 'error', 'target_not_binary', '{R.MSG_TARGET_NOT_BINARY}'
FROM cases HAVING sum(CASE WHEN target IS NOT NULL AND target NOT IN (0, 1) THEN 1 ELSE 0 END) > 0
UNION ALL
SELECT 'train', 'error', 'empty', '{R.MSG_EMPTY_FILE}' FROM cases HAVING count(*) = 0
UNION ALL
SELECT 'train', 'warning', rule, message FROM ({w}) wt WHERE message IS NOT NULL
UNION ALL
SELECT 'test', 'warning', 'id_not_unique', '{R.MSG_ID_NOT_UNIQUE}'
FROM cases HAVING count(DISTINCT case_id) + least(count(*) - count(case_id), 1) <> count(*)
UNION ALL
SELECT 'test', 'warning', 'target_placeholder', '{R.MSG_TARGET_PLACEHOLDER}'
UNION ALL
SELECT 'test', 'error', 'empty', '{R.MSG_EMPTY_FILE}' FROM cases HAVING count(*) = 0
UNION ALL
SELECT 'test', 'warning', rule, message FROM ({w}) wt2 WHERE message IS NOT NULL
"""


@register("validation_report", S.with_cases(_validation_sql(), f"flags AS ({_flags_sql()})"))
def q_validation_report(spark, sf):
    rep = V.validation_report(_validation_inputs(spark, sf), C)
    return rep.select("dataset", "severity", "rule", "message")


@register("validation_status", S.with_cases(
    "SELECT CASE WHEN sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) > 0 THEN 'failed' ELSE 'passed' END AS status,"
    " CAST(sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,"
    " CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_count FROM rep",
    f"flags AS ({_flags_sql()}), rep AS ({_validation_sql()})"))
def q_validation_status(spark, sf):
    return V.report_status(V.validation_report(_validation_inputs(spark, sf), C))


@register("target_summary", S.with_cases(
    "SELECT CAST(target AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS count, "
    + S.rnd6("CAST(sum(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END)) OVER () AS DOUBLE) "
             "/ CAST(sum(count(*)) OVER () AS DOUBLE)") + " AS positive_rate "
    "FROM cases WHERE target IS NOT NULL GROUP BY target"))
def q_target_summary(spark, sf):
    return round_doubles(V.target_summary(cases(spark, sf), C.target))


# ---------------------------------------------------------------- E1-E8 profiling
def _long_sql(columns: list[str], rel: str = "cases") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM {rel}" for c in columns)


@register("eda_shape", S.with_cases(
    "SELECT CAST(sum(_n) AS BIGINT) AS row_count, CAST(11 AS BIGINT) AS column_count, "
    "CAST(coalesce(sum(_n - 1), 0) AS BIGINT) AS duplicate_row_count FROM ("
    "SELECT count(*) AS _n FROM cases GROUP BY " + ", ".join(c for c in _ALL_CASE_COLS if c != "case_id") + ") g"))
def q_eda_shape(spark, sf):
    """E1 + E2 over the case attributes (the key is left out so duplicates can exist)."""
    return E.shape(cases(spark, sf).drop(C.id))


@register("eda_target", S.with_cases(
    "SELECT CAST(target AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS count, "
    "CAST(sum(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END)) OVER () AS BIGINT) AS positive_count, "
    "CAST(sum(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END)) OVER () AS BIGINT) AS negative_count, "
    + S.rnd6("CAST(sum(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END)) OVER () AS DOUBLE) / "
             "CAST(sum(count(*)) OVER () AS DOUBLE)") + " AS positive_rate FROM cases GROUP BY target"))
def q_eda_target(spark, sf):
    return round_doubles(E.target_counts(cases(spark, sf), C.target))


@register("eda_missingness", S.with_cases(
    "SELECT col AS \"column\", missing_count, " + S.rnd6("CAST(missing_count AS DOUBLE) / rows") + " AS missing_rate "
    "FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST(count(*) - count({c}) AS BIGINT) AS missing_count, CAST(count(*) AS DOUBLE) AS rows "
        f"FROM cases" for c in _ALL_CASE_COLS) + ") m WHERE missing_count > 0"))
def q_eda_missingness(spark, sf):
    return round_doubles(E.missingness(cases(spark, sf)))


_SUMMARY_P = list(E.SUMMARY_PERCENTILES)


def _numeric_summary_sql() -> str:
    qs = S.quantile_sql("long_cases", "col", "value", _SUMMARY_P)
    pcols = ", ".join(f"max(CASE WHEN q_index = {i} THEN quantile END) AS {E._pname(p)}"
                      for i, p in enumerate(_SUMMARY_P))
    names = ["mean", "std", "min"] + [E._pname(p) for p in _SUMMARY_P] + ["max"]
    return S.with_cases(
        "SELECT m.col AS \"column\", " + S.rnd6("m.cnt") + " AS count, "
        + ", ".join(f"{S.rnd6(n if n not in ('mean', 'std', 'min', 'max') else 'm.' + n)} AS {n}" for n in names)
        + f" FROM (SELECT col, count(value) AS cnt, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, "
        f"max(value) AS max FROM long_cases GROUP BY col) m LEFT JOIN (SELECT col, {pcols} FROM {qs} qq GROUP BY col) p "
        "ON m.col = p.col",
        f"long_cases AS ({_long_sql(_ALL_CASE_COLS)})")


@register("eda_numeric_summary", _numeric_summary_sql())
def q_eda_numeric_summary(spark, sf):
    return round_doubles(E.numeric_summary(cases(spark, sf)))


_EXTREME_COLS = [c for c in _ALL_CASE_COLS if c not in ("case_id", "target")]


def _extremes_sql() -> str:
    qs = S.quantile_sql("long_cases", "col", "value", [0.25, 0.75, 0.99])
    return S.with_cases(
        "SELECT l.col AS \"column\", " + S.rnd6("min(l.value)") + " AS min, " + S.rnd6("max(b.p99)") + " AS p99, "
        + S.rnd6("max(l.value)") + " AS max, CAST(sum(CASE WHEN l.value < b.q1 - 1.5 * (b.q3 - b.q1) OR "
        "l.value > b.q3 + 1.5 * (b.q3 - b.q1) THEN 1 ELSE 0 END) AS BIGINT) AS iqr_outlier_count, "
        + S.rnd6("CAST(sum(CASE WHEN l.value < b.q1 - 1.5 * (b.q3 - b.q1) OR l.value > b.q3 + 1.5 * (b.q3 - b.q1) "
                 "THEN 1 ELSE 0 END) AS DOUBLE) / count(*)") + " AS iqr_outlier_rate "
        f"FROM long_cases l JOIN (SELECT col, max(CASE WHEN q_index = 0 THEN quantile END) AS q1, "
        f"max(CASE WHEN q_index = 1 THEN quantile END) AS q3, max(CASE WHEN q_index = 2 THEN quantile END) AS p99 "
        f"FROM {qs} qq GROUP BY col) b ON l.col = b.col WHERE l.value IS NOT NULL GROUP BY l.col",
        f"long_cases AS ({_long_sql(_EXTREME_COLS)})")


@register("eda_extremes", _extremes_sql())
def q_eda_extremes(spark, sf):
    return round_doubles(E.extreme_values(cases(spark, sf), exclude=[C.id, C.target]))


def _suspicious_sql() -> str:
    parts = [
        ("age_non_positive_count", "age <= 0"), ("age_below_18_count", "age < 18"),
        ("age_above_100_count", "age > 100"), ("revolving_utilization_above_1_count", "utilization > 1"),
        ("debt_ratio_above_5_count", "debt_ratio > 5"),
        ("monthly_income_non_positive_count", "coalesce(income, 0.0) <= 0"),
        ("dependents_negative_count", "coalesce(dependents, 0.0) < 0"),
    ]
    for c in C.delinquency:
        parts += [(f"{c}_above_20_count", f"{c} > 20"), (f"{c}_above_50_count", f"{c} > 50")]
    return S.with_cases("SELECT " + ", ".join(f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
                                              for n, cond in parts) + " FROM cases")


@register("eda_suspicious", _suspicious_sql())
def q_eda_suspicious(spark, sf):
    return E.suspicious_values(cases(spark, sf), C)


def _full_summary_sql() -> str:
    sections = [
        ("shape", "eda_shape", None, ["row_count", "column_count", "duplicate_row_count"]),
        ("target", "eda_target", "value", ["count", "positive_count", "negative_count", "positive_rate"]),
        ("missingness", "eda_missingness", "column", ["missing_count", "missing_rate"]),
        ("numeric", "eda_numeric_summary", "column",
         ["count", "mean", "std", "min", *[E._pname(p) for p in _SUMMARY_P], "max"]),
        ("extremes", "eda_extremes", "column", ["min", "p99", "max", "iqr_outlier_count", "iqr_outlier_rate"]),
        ("suspicious", "eda_suspicious", None,
         ["age_non_positive_count", "age_below_18_count", "age_above_100_count", "revolving_utilization_above_1_count",
          "debt_ratio_above_5_count", "monthly_income_non_positive_count", "dependents_negative_count",
          *[f"{c}_above_{n}_count" for c in C.delinquency for n in (20, 50)]]),
    ]
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, " + (f'CAST(t."{item}" AS VARCHAR)' if item else "CAST(NULL AS VARCHAR)")
        + f" AS item, s.statistic, CAST(s.value AS DOUBLE) AS value FROM ({ORACLE[name]}) t, LATERAL (VALUES "
        + ", ".join(f"('{n}', CAST(t.\"{n}\" AS DOUBLE))" for n in names) + ") s(statistic, value)"
        for section, name, item, names in sections)


@register("eda_full_summary", _full_summary_sql())
def q_eda_full_summary(spark, sf):
    return round_doubles(E.full_summary(cases(spark, sf), C))


_HIST_BINS = {"age": 40, "income": 40, "debt_ratio": 40, "utilization": 40,
              "late_30_59": 30, "late_60_89": 30, "late_90": 30}


def _histogram_sql() -> str:
    qs = S.quantile_sql("long_h", "col", "value", [0.99])
    nb = "CASE " + " ".join(f"WHEN col = '{c}' THEN {n}" for c, n in _HIST_BINS.items()) + " END"
    return S.with_cases(f"""
SELECT col AS "column", CAST(bin AS INTEGER) AS bin,
       {S.rnd6("CASE WHEN bin >= nb THEN hi ELSE bin * ((hi - lo) / nb) + lo END")} AS bin_left,
       {S.rnd6("CASE WHEN bin + 1 >= nb THEN hi ELSE (bin + 1) * ((hi - lo) / nb) + lo END")} AS bin_right,
       CAST(count(*) AS BIGINT) AS count
FROM (
  SELECT col, x, lo, hi, nb,
         CASE WHEN x >= (CASE WHEN i1 + 1 >= nb THEN hi ELSE (i1 + 1) * ((hi - lo) / nb) + lo END) AND i1 <> nb - 1
              THEN i1 + 1 ELSE i1 END AS bin
  FROM (
    SELECT col, x, lo, hi, nb,
           CASE WHEN x < (CASE WHEN i0 >= nb THEN hi ELSE i0 * ((hi - lo) / nb) + lo END) THEN i0 - 1 ELSE i0 END AS i1
    FROM (
      SELECT c.col, c.x, r.lo, r.hi, c.nb,
             CASE WHEN floor((c.x - r.lo) * (c.nb / (r.hi - r.lo))) >= c.nb THEN c.nb - 1
                  ELSE floor((c.x - r.lo) * (c.nb / (r.hi - r.lo))) END AS i0
      FROM clipped c JOIN (
        SELECT col, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                    CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
        FROM clipped GROUP BY col) r ON c.col = r.col
    ) a
  ) b
) d
GROUP BY col, bin, lo, hi, nb
""", f"long_h AS ({_long_sql(list(_HIST_BINS))}), "
     f"clipped AS (SELECT l.col, least(l.value, p.quantile) AS x, CAST({nb.replace('col', 'l.col')} AS DOUBLE) AS nb "
     f"FROM long_h l JOIN {qs} p ON l.col = p.col WHERE l.value IS NOT NULL)")


@register("eda_histogram", _histogram_sql())
def q_eda_histogram(spark, sf):
    return round_doubles(E.histogram(cases(spark, sf), list(_HIST_BINS), _HIST_BINS))


# ---------------------------------------------------------------- P1 / P4 split
@register("split_assignment", S.with_cases("SELECT case_id, target, split FROM split_cases", S.split_cte()))
def q_split_assignment(spark, sf):
    return split_cases(spark, sf).select(C.id, C.target, "split")


@register("split_metadata", S.with_cases(
    "SELECT split, CAST(count(*) AS BIGINT) AS row_count, CAST(count(target) AS BIGINT) AS non_null_count, "
    "CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_count, "
    "CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_count, "
    + S.rnd6("CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(target)")
    + " AS positive_rate FROM split_cases GROUP BY split", S.split_cte()))
def q_split_metadata(spark, sf):
    return round_doubles(P.split_metadata(split_cases(spark, sf), C.target))


# ---------------------------------------------------------------- F2-F8 features (fit on train)
_CLIP = {c: b for c, b in C.clip_rules().items()}
_FEAT_OUT = FEATURES + ["income_missing", "dependents_missing"]


def _built_sql(rel: str) -> str:
    exprs = []
    for c in FEATURES:
        v = f"CAST({c} AS DOUBLE)"
        if c in _CLIP:
            lo, hi = _CLIP[c]
            v = f"CASE WHEN {v} IS NULL THEN NULL ELSE least(greatest({v}, CAST({lo!r} AS DOUBLE)), CAST({hi!r} AS DOUBLE)) END"
        exprs.append(f"{v} AS {c}")
    exprs += ["CAST(CASE WHEN income IS NULL THEN 1 ELSE 0 END AS INTEGER) AS income_missing",
              "CAST(CASE WHEN dependents IS NULL THEN 1 ELSE 0 END AS INTEGER) AS dependents_missing"]
    return f"SELECT case_id, target, split, {', '.join(exprs)} FROM {rel}"


def _feature_matrix_sql() -> str:
    qs = S.quantile_sql("(" + _long_sql(_FEAT_OUT, "(SELECT * FROM built WHERE split = 'train')") + ")", "col",
                        "value", [0.5])
    med = ", ".join(f"max(CASE WHEN col = '{c}' THEN quantile END) AS m_{c}" for c in _FEAT_OUT)
    imputed = ", ".join(f"coalesce(CAST(b.{c} AS DOUBLE), md.m_{c}) AS {c}" for c in _FEAT_OUT)
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _FEAT_OUT)
    scaled = ", ".join(S.r6(f"(i.{c} - st.a_{c}) / (CASE WHEN st.s_{c} IS NULL OR st.s_{c} = 0 THEN 1.0 ELSE st.s_{c} END)", c)
                       for c in _FEAT_OUT)
    return S.with_cases(
        f"SELECT i.case_id, i.split, {scaled} FROM imputed i, stats st",
        S.split_cte() + f",\nbuilt AS ({_built_sql('split_cases')}),\n"
        f"medians AS (SELECT {med} FROM {qs} qq),\n"
        f"imputed AS (SELECT b.case_id, b.split, {imputed} FROM built b, medians md),\n"
        f"stats AS (SELECT {stats} FROM imputed WHERE split = 'train')")


def feature_frame(spark, sf) -> DataFrame:
    """F2-F8 fitted on the train split, applied to every split (no vector column)."""
    from riskloom.operators.features import preprocessing
    df = split_cases(spark, sf)
    train = df.where(F.col("split") == "train").persist()  # fit input read by two estimators
    model = preprocessing(C, output_col=None).fit(train)
    return model.transform(df)


@register("feature_matrix", _feature_matrix_sql())
def q_feature_matrix(spark, sf):
    out = feature_frame(spark, sf)
    return round_doubles(out.select(C.id, "split", *[F.col(c).cast("double").alias(c) for c in _FEAT_OUT]))


# ---------------------------------------------------------------- I1 / I3 class weights
@register("class_weights", S.with_cases(
    "SELECT CAST(pos AS BIGINT) AS positive_count, CAST(neg AS BIGINT) AS negative_count, "
    + S.rnd6("CAST(neg AS DOUBLE) / pos") + " AS scale_pos_weight, "
    + S.rnd6("CAST(pos + neg AS DOUBLE) / (2.0 * pos)") + " AS balanced_weight_positive, "
    + S.rnd6("CAST(pos + neg AS DOUBLE) / (2.0 * neg)") + " AS balanced_weight_negative "
    "FROM (SELECT sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS neg "
    "FROM split_cases WHERE split = 'train') t", S.split_cte()))
def q_class_weights(spark, sf):
    from riskloom.operators.imbalance import class_weight_summary
    return round_doubles(class_weight_summary(split_cases(spark, sf).where(F.col("split") == "train"), C.target))


# ---------------------------------------------------------------- K2-K13 metrics
def _metrics_oracle(group: str | None, src: str = "scored", threshold: str = "CAST(0.5 AS DOUBLE)") -> str:
    keep = ([group] if group else []) + S.METRIC_LONGS
    return S.round_select(S.metrics_sql(src, group, threshold), keep, S.METRIC_DOUBLES)


@register("metrics_by_split", S.with_cases(_metrics_oracle("split"), S.scored_cte()))
def q_metrics_by_split(spark, sf):
    return round_doubles(K.binary_metrics(scored_cases(spark, sf), C.target, "score", 0.5, ["split"]))


def _curve_rt_sql() -> str:
    return ("SELECT split, s, pos, neg, "
            "CAST(sum(pos) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_pos, "
            "CAST(sum(neg) OVER (PARTITION BY split ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_neg, "
            "CAST(sum(pos) OVER (PARTITION BY split) AS DOUBLE) AS tot_pos, CAST(sum(neg) OVER (PARTITION BY split) AS DOUBLE) AS tot_neg, "
            "lead(pos) OVER (PARTITION BY split ORDER BY s DESC) AS next_pos, lead(neg) OVER (PARTITION BY split ORDER BY s DESC) AS next_neg, "
            "row_number() OVER (PARTITION BY split ORDER BY s DESC) AS rn "
            "FROM (SELECT split, score AS s, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, "
            "CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg FROM scored GROUP BY split, score) g")


@register("pr_curve", S.with_cases(
    "SELECT split, " + S.rnd6("s") + " AS threshold, " + S.rnd6("cum_pos / (cum_pos + cum_neg)") + " AS precision, "
    + S.rnd6("coalesce(cum_pos / nullif(tot_pos, 0), 1.0)") + " AS recall FROM rt "
    "UNION ALL SELECT DISTINCT split, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM rt",
    S.scored_cte() + f",\nrt AS ({_curve_rt_sql()})"))
def q_pr_curve(spark, sf):
    return round_doubles(K.precision_recall_curve(scored_cases(spark, sf), C.target, "score", ["split"]))


@register("roc_curve", S.with_cases(
    "SELECT split, " + S.rnd6("s") + " AS threshold, " + S.rnd6("cum_neg / tot_neg") + " AS false_positive_rate, "
    + S.rnd6("cum_pos / tot_pos") + " AS true_positive_rate FROM rt "
    "WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg "
    "UNION ALL SELECT DISTINCT split, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM rt",
    S.scored_cte() + f",\nrt AS ({_curve_rt_sql()})"))
def q_roc_curve(spark, sf):
    return round_doubles(K.roc_curve(scored_cases(spark, sf), C.target, "score", ["split"]))


# ---------------------------------------------------------------- T1-T7 thresholds
_GRID_P = T.grid_probs(R.DEFAULT_MAX_CANDIDATES)


def _grid_sql() -> str:
    qs = S.quantile_sql("(SELECT 'v' AS g, score FROM scored WHERE split = 'validation')", "g", "score", _GRID_P)
    fixed = " UNION ALL ".join(f"SELECT CAST({v!r} AS DOUBLE)" for v in R.FIXED_THRESHOLD_CANDIDATES)
    return (f"SELECT DISTINCT least(1.0, greatest(0.0, t)) AS threshold FROM "
            f"(SELECT quantile AS t FROM {qs} qq UNION ALL {fixed}) u")


@register("threshold_grid", S.with_cases("SELECT " + S.rnd6("threshold") + " AS threshold FROM grid",
                                         S.scored_cte() + f",\ngrid AS ({_grid_sql()})"))
def q_threshold_grid(spark, sf):
    val = scored_cases(spark, sf).where(F.col("split") == "validation")
    return round_doubles(T.candidate_grid(val, "score"))


def _sweep_sql(rel: str = "scored", split: str = "validation") -> str:
    return f"""SELECT threshold, CAST(N - fp AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(P - tp AS BIGINT) AS fn,
  CAST(tp AS BIGINT) AS tp, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
  coalesce(tp / nullif(P, 0), 0.0) AS recall, coalesce(2.0 * tp / nullif(2.0 * tp + fp + (P - tp), 0), 0.0) AS f1,
  (tp + N - fp) / (P + N) AS accuracy, CAST(P + N AS BIGINT) AS row_count
FROM (SELECT g.threshold, CAST(coalesce(sum(CASE WHEN v.score >= g.threshold AND v.target = 1 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS tp,
             CAST(coalesce(sum(CASE WHEN v.score >= g.threshold AND v.target = 0 THEN 1 ELSE 0 END), 0) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN v.target = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS P,
             CAST(sum(CASE WHEN v.target = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS N
      FROM grid g, (SELECT * FROM {rel} WHERE split = '{split}') v GROUP BY g.threshold) c"""


_SWEEP_DOUBLES = ["threshold", "precision", "recall", "f1", "accuracy"]
_SWEEP_LONGS = ["tn", "fp", "fn", "tp", "row_count"]


def _val_sweep(spark, sf):
    val = scored_cases(spark, sf).where(F.col("split") == "validation")
    return T.threshold_sweep(val, C.target, "score", T.candidate_grid(val, "score"))


@register("threshold_sweep", S.with_cases(S.round_select(f"({_sweep_sql()})", _SWEEP_LONGS, _SWEEP_DOUBLES),
                                          S.scored_cte() + f",\ngrid AS ({_grid_sql()})"))
def q_threshold_sweep(spark, sf):
    return round_doubles(_val_sweep(spark, sf))


@register("threshold_leaderboard", S.with_cases(
    S.round_select("(SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC, recall DESC, threshold ASC) AS INTEGER) AS rank, "
                   "f1 AS objective_value, CAST(count(*) OVER () AS BIGINT) AS candidate_count, "
                   "CAST(count(*) OVER () AS BIGINT) AS feasible_candidate_count, 'constraints_satisfied' AS status "
                   f"FROM ({_sweep_sql()}) sw) r0 WHERE rank <= 10)",
                   _SWEEP_LONGS + ["rank", "candidate_count", "feasible_candidate_count", "status"],
                   _SWEEP_DOUBLES + ["objective_value"]),
    S.scored_cte() + f",\ngrid AS ({_grid_sql()})"))
def q_threshold_leaderboard(spark, sf):
    return round_doubles(T.select_threshold(_val_sweep(spark, sf), "f1", top=10))


@register("cost_leaderboard", S.with_cases(
    S.round_select("(SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY average_cost_per_row ASC, recall DESC, threshold ASC) "
                   "AS INTEGER) AS rank FROM (SELECT *, CAST(fp * 1.0 + fn * 5.0 AS DOUBLE) AS total_cost, "
                   "CAST(fp * 1.0 + fn * 5.0 AS DOUBLE) / row_count AS average_cost_per_row "
                   f"FROM ({_sweep_sql()}) sw) c) r0 WHERE rank <= 10)",
                   _SWEEP_LONGS + ["rank"], _SWEEP_DOUBLES + ["total_cost", "average_cost_per_row"]),
    S.scored_cte() + f",\ngrid AS ({_grid_sql()})"))
def q_cost_leaderboard(spark, sf):
    return round_doubles(T.select_cost_threshold(T.business_cost(_val_sweep(spark, sf), 1.0, 5.0), top=10))


# ---------------------------------------------------------------- B1-B9 batch scoring
from riskloom.functions.columns import NUMERIC_PATTERN  # noqa: E402
from riskloom.operators import scoring as B  # noqa: E402
from riskloom.sources.applications import applications_sql, load_applications  # noqa: E402
from riskloom.sources.cases import FIXED_SCORE_SQL, fixed_score  # noqa: E402

# FIXED VALUES: the decision thresholds and candidate source of the reference's published artifacts.
F1_THRESHOLD = 0.19962999820709218
COST_THRESHOLD = 0.13704658508300782
SOURCE = "reference_candidate"
_APP_COLS = ["case_id", *FEATURES, "customer_ref"]


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _norm_sql(c: str) -> tuple[str, str]:
    role = C.role_of(c)
    text = f"trim(CAST({c} AS VARCHAR))"
    blank = f"({c} IS NULL OR {text} = '' OR lower({text}) = 'nan')"
    parsed = f"(CASE WHEN regexp_matches({text}, '{NUMERIC_PATTERN}') THEN TRY_CAST({text} AS DOUBLE) END)"
    infinite = f"(lower({text}) IN ({', '.join(_lit(t) for t in B.INFINITY_TEXT)}))"
    optional = role in R.OPTIONAL_INPUT_ROLES
    req = "NULL" if optional else _lit(R.MSG_FIELD_REQUIRED.format(col=c))
    err = f"CASE WHEN {blank} THEN {req} WHEN {infinite} OR {parsed} IS NULL THEN {_lit(R.MSG_FIELD_NUMERIC.format(col=c))} "
    if role == "age":
        err += f"WHEN {parsed} < 18 THEN {_lit(R.MSG_AGE_MINIMUM)} "
    elif role in R.NON_NEGATIVE_ROLES:
        err += f"WHEN {parsed} < 0 THEN {_lit(R.MSG_FIELD_NON_NEGATIVE.format(col=c))} "
    value = parsed
    if role in R.INTEGER_LIKE_ROLES:
        err += (f"WHEN abs({parsed} - round_even({parsed}, 0)) > 1e-9 "
                f"THEN {_lit(R.MSG_FIELD_INTEGER.format(col=c))} ")
        value = f"round_even({parsed}, 0)"
    err += "END"
    lo, hi = _CLIP.get(c, (None, None))
    if lo is not None:
        value = f"greatest({value}, CAST({lo!r} AS DOUBLE))"
    if hi is not None:
        value = f"least({value}, CAST({hi!r} AS DOUBLE))"
    value = f"CASE WHEN {blank} THEN NULL ELSE {value} END"
    if role in R.INTEGER_LIKE_ROLES:
        value = f"CAST(round_even({value}, 0) AS BIGINT)"
    return value, err


def _normalized_sql() -> str:
    vals, errs = zip(*[_norm_sql(c) for c in FEATURES])
    cols = ", ".join(f"{v} AS n_{c}" for v, c in zip(vals, FEATURES))
    return f"SELECT *, {cols}, coalesce({', '.join(errs)}) AS row_error FROM apps"


def _batch_ctes() -> str:
    score = ("CAST(floor(least(1.0, greatest(0.0, 0.3 * n_utilization + CASE WHEN n_income < 1000 THEN 0.5 ELSE 0.0 END))"
             " * 1000.0 + 0.5) / 1000.0 AS DOUBLE)")
    t1, t2 = f"CAST({F1_THRESHOLD!r} AS DOUBLE)", f"CAST({COST_THRESHOLD!r} AS DOUBLE)"
    enriched = (f"SELECT {', '.join(_APP_COLS)}, p AS predicted_probability, "
                f"CASE WHEN p < 0.1 THEN 'Low' WHEN p < {t1} THEN 'Medium' ELSE 'High' END AS risk_band, "
                f"CAST(CASE WHEN p >= {t1} THEN 1 ELSE 0 END AS INTEGER) AS predicted_label_f1_threshold, "
                f"CAST(CASE WHEN p >= {t2} THEN 1 ELSE 0 END AS INTEGER) AS predicted_label_cost_threshold, "
                f"{t1} AS f1_threshold, {t2} AS cost_threshold, '{SOURCE}' AS selected_candidate_source "
                f"FROM (SELECT *, {score} AS p FROM normalized WHERE row_error IS NULL) g")
    return (f"apps AS ({applications_sql()}),\nnormalized AS ({_normalized_sql()}),\n"
            f"enriched AS ({enriched})")


def batch_enriched(spark, sf) -> DataFrame:
    apps = load_applications(spark, sf)
    norm = B.normalize_batch(apps, C)
    good = norm.where(F.col("row_error").isNull())
    p = fixed_score(B.NORM_PREFIX + C.utilization, B.NORM_PREFIX + C.income)
    return B.enrich(good, p, F1_THRESHOLD, COST_THRESHOLD, SOURCE, apps.columns)


@register("batch_row_errors", S.with_cases("SELECT case_id, row_error AS message FROM normalized "
                                           "WHERE row_error IS NOT NULL", _batch_ctes()))
def q_batch_row_errors(spark, sf):
    return B.row_errors(B.normalize_batch(load_applications(spark, sf), C), C.id)


_ENRICHED_DOUBLES = ["predicted_probability", "f1_threshold", "cost_threshold"]


@register("batch_scored", S.with_cases(
    S.round_select("enriched", _APP_COLS + ["risk_band", "predicted_label_f1_threshold",
                                            "predicted_label_cost_threshold", "selected_candidate_source"],
                   _ENRICHED_DOUBLES), _batch_ctes()))
def q_batch_scored(spark, sf):
    return round_doubles(batch_enriched(spark, sf))


def _batch_summary_sql() -> str:
    med = S.quantile_sql("(SELECT 'm' AS g, predicted_probability FROM enriched)", "g", "predicted_probability", [0.5])
    return ("SELECT CAST(count(*) AS BIGINT) AS uploaded_row_count, CAST(count(*) AS BIGINT) AS scored_row_count, "
            + S.rnd6("avg(predicted_probability)") + " AS average_predicted_probability, "
            + S.rnd6(f"(SELECT quantile FROM {med} mq)") + " AS median_predicted_probability, "
            "CAST(sum(CASE WHEN risk_band = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_row_count, "
            + S.rnd6("CAST(sum(CASE WHEN risk_band = 'High' THEN 1 ELSE 0 END) AS DOUBLE) / count(*)")
            + " AS high_risk_share, CAST(sum(predicted_label_f1_threshold) AS BIGINT) AS flagged_f1_threshold_count, "
            "CAST(sum(predicted_label_cost_threshold) AS BIGINT) AS flagged_cost_threshold_count, "
            "min(selected_candidate_source) AS selected_candidate_source, "
            + S.rnd6("min(f1_threshold)") + " AS f1_threshold, " + S.rnd6("min(cost_threshold)")
            + " AS cost_threshold FROM enriched")


@register("batch_summary", S.with_cases(_batch_summary_sql(), _batch_ctes()))
def q_batch_summary(spark, sf):
    return round_doubles(B.batch_summary(batch_enriched(spark, sf)))


@register("batch_band_distribution", S.with_cases(
    "SELECT risk_band, CAST(count(*) AS BIGINT) AS count FROM enriched GROUP BY risk_band", _batch_ctes()))
def q_batch_band_distribution(spark, sf):
    return B.band_distribution(batch_enriched(spark, sf))


@register("batch_preview", S.with_cases(
    S.round_select("(SELECT * FROM enriched ORDER BY case_id LIMIT 50)",
                   _APP_COLS + ["risk_band", "predicted_label_f1_threshold", "predicted_label_cost_threshold",
                                "selected_candidate_source"], _ENRICHED_DOUBLES), _batch_ctes()))
def q_batch_preview(spark, sf):
    """The preview is a top-k by key (the limit is the operator)."""
    return round_doubles(B.preview(batch_enriched(spark, sf), C.id, 50))


@register("flagship_cost_threshold")
def q_flagship(spark, sf):
    from riskloom.plans.flagship import cost_threshold_question
    return cost_threshold_question(spark, sf)


# ---------------------------------------------------------------- L1-L3, V18, V19 layers
from riskloom.operators import layers as L  # noqa: E402

_FLAG_DEFS = {
    "age_implausible_flag": "age < 18 OR age > 100",
    "revolving_utilization_gt_1_flag": "utilization > 1.0",
    "debt_ratio_gt_5_flag": "debt_ratio > 5.0",
    "monthly_income_missing_flag": "income IS NULL",
    "monthly_income_non_positive_flag": "income <= 0",
    "dependents_missing_flag": "dependents IS NULL",
    "dependents_negative_flag": "dependents < 0",
    "delinquency_extreme_flag": "greatest(late_30_59, late_60_89, late_90) > 20",
}


def _curated_sql(rel: str = "split_cases") -> str:
    flags = {k: f"coalesce(({v}), false)" for k, v in _FLAG_DEFS.items()}
    summary = "concat_ws('; ', " + ", ".join(f"CASE WHEN {flags[k]} THEN '{k.removesuffix('_flag')}' END"
                                             for k in L.WARNING_FLAGS) + ")"
    cols = [
        "concat(split, '-', CAST(case_id AS VARCHAR)) AS curated_record_id", "split AS source_dataset_split",
        "'RAW' AS source_schema_name", "'raw_cases' AS source_table_name",
        f"'{L.CURATED_SCHEMA_VERSION}' AS curated_schema_version",
        "(case_id IS NOT NULL AND (target IS NULL OR target IN (0, 1))) AS is_valid_row",
        "(" + " OR ".join(flags[k] for k in L.WARNING_FLAGS) + ") AS has_data_quality_warnings",
        f"nullif({summary}, '') AS data_quality_warning_summary",
        "CAST(case_id AS BIGINT) AS source_row_id", f"CAST(target AS INTEGER) AS {L.CURATED_NAMES['target']}",
    ]
    for role in R.FEATURE_ROLES:
        dtype = "BIGINT" if role in R.INTEGER_LIKE_ROLES and role != "dependents" else "DOUBLE"
        cols.append(f"CAST({C.col(role)} AS {dtype}) AS {L.CURATED_NAMES[role]}")
    cols += [f"{v} AS {k}" for k, v in flags.items()]
    return f"SELECT {', '.join(cols)} FROM {rel}"


_CURATED_DOUBLES = [L.CURATED_NAMES[r] for r in ("utilization", "debt_ratio", "income", "dependents")]


def curated_frame(spark, sf):
    return L.curate(split_cases(spark, sf), C, "split", with_audit=False)


@register("curated_cases", S.with_cases(
    "SELECT * EXCLUDE (" + ", ".join(_CURATED_DOUBLES) + "), "
    + ", ".join(S.r6(c, c) for c in _CURATED_DOUBLES) + f" FROM ({_curated_sql()}) cu", S.split_cte()))
def q_curated_cases(spark, sf):
    return round_doubles(curated_frame(spark, sf))


def _features_layer_sql() -> str:
    cn, fn = L.CURATED_NAMES, L.FEATURE_NAMES
    qs = S.quantile_sql(f"(SELECT 'i' AS col, {cn['income']} AS value FROM curated WHERE source_dataset_split = 'train' "
                        f"UNION ALL SELECT 'd', {cn['dependents']} FROM curated WHERE source_dataset_split = 'train')",
                        "col", "value", [0.5])
    cols = ["sha256(concat_ws('|', curated_record_id, '1.0.0')) AS feature_record_id", "curated_record_id",
            "source_dataset_split", "'1.0.0' AS feature_schema_version", "'1.0.0' AS feature_pipeline_version",
            cn["target"], "source_row_id"]
    rules = L.curated_columns().clip_rules()
    for role in R.FEATURE_ROLES:
        src = cn[role]
        v = src
        if src in rules:
            lo, hi = rules[src]
            v = f"CASE WHEN {src} IS NULL THEN NULL ELSE least(greatest({src}, {lo!r}), {hi!r}) END"
            v = f"CAST({v} AS BIGINT)" if role in R.INTEGER_LIKE_ROLES else f"CAST({v} AS DOUBLE)"
        if role == "income":
            v = f"coalesce(CAST({src} AS DOUBLE), m.mi)"
        if role == "dependents":
            v = f"coalesce(CAST({src} AS DOUBLE), m.md)"
        name = fn[role]
        cols.append(S.r6(v, name) if role in ("utilization", "debt_ratio", "income", "dependents") else f"{v} AS {name}")
        if role == "income":
            cols.append(f"CAST(CASE WHEN {src} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS monthly_income_missing_indicator")
        if role == "dependents":
            cols.append(f"CAST(CASE WHEN {src} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS dependents_missing_indicator")
    for k in ("age_implausible_flag", "revolving_utilization_gt_1_flag", "debt_ratio_gt_5_flag",
              "delinquency_extreme_flag"):
        cols.append(f"CAST({k} AS INTEGER) AS {k}")
    return (f"SELECT {', '.join(cols)} FROM curated, (SELECT max(CASE WHEN col = 'i' THEN quantile END) AS mi, "
            f"max(CASE WHEN col = 'd' THEN quantile END) AS md FROM {qs} qq) m")


def features_layer_frame(spark, sf):
    return L.featurize(curated_frame(spark, sf), with_audit=False)


@register("features_layer", S.with_cases(_features_layer_sql(),
                                         S.split_cte() + f",\ncurated AS ({_curated_sql()})"))
def q_features_layer(spark, sf):
    return round_doubles(features_layer_frame(spark, sf))


def _predictions_sql() -> str:
    fn = L.FEATURE_NAMES
    p = (f"CAST(floor(least(1.0, greatest(0.0, 0.3 * {fn['utilization']} + CASE WHEN {fn['income']} < 1000 "
         f"THEN 0.5 ELSE 0.0 END)) * 1000.0 + 0.5) / 1000.0 AS DOUBLE)")
    t = f"CAST({F1_THRESHOLD!r} AS DOUBLE)"
    return (f"SELECT sha256(concat_ws('|', feature_record_id, 'fixed_rule', '1')) AS prediction_id, feature_record_id, "
            f"curated_record_id, source_row_id, CAST(NULL AS VARCHAR) AS input_source_identifier, "
            f"'fixed_rule' AS model_name, '1' AS model_version, '1.0.0' AS feature_schema_version, "
            f"'1.0.0' AS feature_pipeline_version, {S.rnd6('p')} AS raw_probability, "
            f"CAST(NULL AS DOUBLE) AS calibrated_probability, {S.rnd6(t)} AS decision_threshold, "
            f"CAST(CASE WHEN p >= {t} THEN 1 ELSE 0 END AS INTEGER) AS predicted_label, "
            f"CASE WHEN p < 0.1 THEN 'Low' WHEN p < {t} THEN 'Medium' ELSE 'High' END AS risk_band "
            f"FROM (SELECT *, {p} AS p FROM feats) f")


@register("prediction_audit", S.with_cases(
    _predictions_sql(),
    S.split_cte() + f",\ncurated AS ({_curated_sql()}),\nfeats AS ({_features_layer_sql()})"))
def q_prediction_audit(spark, sf):
    feats = features_layer_frame(spark, sf)
    fn = L.FEATURE_NAMES
    p = fixed_score(fn["utilization"], fn["income"])
    return round_doubles(L.prediction_records(feats, p, "fixed_rule", "1", F1_THRESHOLD, with_audit=False))


@register("quality_runs", S.with_cases(
    "SELECT sha256(concat_ws('|', 'RAW', dataset, '1.0.0')) AS data_quality_run_id, 'RAW' AS source_layer, "
    "dataset AS source_object_name, dataset AS dataset_split, '1.0.0' AS ruleset_version, "
    "CASE WHEN sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) > 0 THEN 'failed' ELSE 'passed' END AS run_status, "
    "CAST(sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count, "
    "CAST(sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_count, "
    "nullif(array_to_string(list_sort(list(CASE WHEN severity = 'error' THEN message END)), ' | '), '') AS error_summary, "
    "nullif(array_to_string(list_sort(list(CASE WHEN severity = 'warning' THEN message END)), ' | '), '') AS warning_summary "
    "FROM rep GROUP BY dataset", f"flags AS ({_flags_sql()}), rep AS ({_validation_sql()})"))
def q_quality_runs(spark, sf):
    return L.quality_run_records(V.validation_report(_validation_inputs(spark, sf), C))


# ---------------------------------------------------------------- M1-M15 models (rows-only checks)
from riskloom.operators import calibration as CAL  # noqa: E402
from riskloom.functions.permute import permuted_rank_sql as P_SQL  # noqa: E402
from riskloom.operators import importance as X  # noqa: E402
from riskloom.operators import models as M  # noqa: E402
from riskloom.operators.features import preprocessing  # noqa: E402
from riskloom.operators.imbalance import class_weight_summary, with_balanced_weights, with_repeated_rows, with_weight_column  # noqa: E402


def _train_frame(spark, sf):
    df = split_cases(spark, sf)
    train = df.where(F.col("split") == "train").persist()
    return df, M.sized_for_iterations(train, train.count()).persist()


#: The model that each registered learner query of an application has fitted: metrics and importance share one.
_FITTED: dict[tuple, PipelineModel] = {}


def trained_model(spark, sf, kind: str):
    """(all rows with their split, the model): fitted once for an application, folder and kind."""
    at = (spark.sparkContext.applicationId, sf, kind)
    if at not in _FITTED:
        df, model = _fitted_model(spark, sf, kind)
        _FITTED[at] = model
        return df, model
    return split_cases(spark, sf), _FITTED[at]


def _fitted_model(spark, sf, kind: str):
    df, train = _train_frame(spark, sf)
    prep = preprocessing(C, output_col="features")
    n_in = len(FEATURES) + 2
    if kind == "logistic":
        summary = class_weight_summary(train, C.target)
        weighted = with_balanced_weights(train, C.target, summary)
        est = M.logistic("features", C.target, n_weight=float(train.count()), weight_col="weight")
        return df, M.fit(prep, est, weighted)
    if kind == "boosting":
        ratio = class_weight_summary(train, C.target).first()["scale_pos_weight"]
        weighted = with_weight_column(train, C.target, ratio)
        params = M.BoostingParams()
        model = M.fit(prep, params.estimator("features", C.target, weight_col="weight"), weighted)
        return df, M.stop_early(model, df.where(F.col("split") == "validation"), params.early_stopping_rounds, "weight")
    if kind == "neural":
        ratio = class_weight_summary(train, C.target).first()["scale_pos_weight"]
        # imputing and scaling are fitted on the rows themselves, only the network sees the copies: it packs the two columns it reads
        # into blocks that it holds itself, so the copies aren't held besides
        fitted = prep.fit(train)
        copies = fitted.transform(with_repeated_rows(train, C.target, ratio, C.id)).select("features", C.target)
        network = M.neural("features", C.target, n_inputs=n_in).fit(copies)
        return df, PipelineModel([*fitted.stages, network])
    raise ValueError(kind)


def _model_metrics(spark, sf, kind):
    df, model = trained_model(spark, sf, kind)
    scored = M.predict_proba(model, df, keep=[C.id, C.target, "split"], out="score")
    return round_doubles(K.binary_metrics(scored, C.target, "score", 0.5, ["split"]))


@register("model_logistic_metrics")
def q_model_logistic(spark, sf):
    """M1 + M4 + M15: balanced-weight logistic baseline evaluated on every split."""
    return _model_metrics(spark, sf, "logistic")


@register("model_boosting_metrics")
def q_model_boosting(spark, sf):
    """M2 + M15: boosted trees with the ratio weight, cut at the best of 600 rounds on the validation split."""
    return _model_metrics(spark, sf, "boosting")


@register("model_neural_metrics")
def q_model_neural(spark, sf):
    """M3 + M15: 64-32 perceptron on positives repeated by the ratio weight."""
    return _model_metrics(spark, sf, "neural")


@register("model_boosting_importance")
def q_model_importance(spark, sf):
    """M7: gain / weight / cover per feature from the saved trees."""
    _, model = trained_model(spark, sf, "boosting")
    return round_doubles(M.tree_importance(model, FEATURES + ["income_missing", "dependents_missing"]))


@register("model_scores")
def q_model_scores(spark, sf):
    """M5 + M6: [id], probability, label at the F1 threshold, for the test split."""
    df, model = trained_model(spark, sf, "logistic")
    return round_doubles(M.score_records(model, df.where(F.col("split") == "test"), F1_THRESHOLD, C.id))


# ---------------------------------------------------------------- C1-C5 calibration
def calibrated_scores(spark, sf, method: str = "isotonic"):
    """Holdout (P5: 20 % of train, stratified) fits the calibrator on the raw score."""
    sc = scored_cases(spark, sf)
    train = sc.where(F.col("split") == "train")
    held = P.assign_splits(train, C.id, C.target, P.SplitConfig(), split_col="part", holdout_only=0.2,
                           labels=("holdout", "unused", "fit"))
    cal = CAL.fit_calibrator(held.where(F.col("part") == "holdout"), C.target, "score", method)
    return CAL.apply_calibrator(cal, sc, "score", "calibrated")


@register("calibration_report")
def q_calibration_report(spark, sf):
    """Raw vs isotonic-calibrated metric bundle on every split (one grouped job)."""
    return round_doubles(CAL.calibration_report(calibrated_scores(spark, sf), C.target, "score", "calibrated"))


@register("calibration_sigmoid_brier")
def q_calibration_sigmoid(spark, sf):
    """C1 + C5: sigmoid calibration; improved-Brier flag per split."""
    rep = CAL.calibration_report(calibrated_scores(spark, sf, "sigmoid"), C.target, "score", "calibrated")
    return round_doubles(CAL.improved_brier(rep))


# ---------------------------------------------------------------- M9 / M12 / C4 candidate chain and calibration by refit
from riskloom.operators import selection as SEL  # noqa: E402

_CHAINS: dict[tuple, tuple] = {}
#: Tuned penalties of the chain's search; every combination is drawn.
PENALTIES = {"C": [0.01, 0.1, 1.0, 10.0]}


def logistic_chain(spark, sf):
    """(all rows with their split, the chain): fitted once for an application and folder, as report and calibration share it."""
    at = (spark.sparkContext.applicationId, sf)
    df = split_cases(spark, sf)
    if at not in _CHAINS:
        held = df.persist()
        _CHAINS[at] = SEL.candidate_chain(
            spark, held.where(F.col("split") == "train"), held.where(F.col("split") == "validation"),
            SEL.logistic_learner(preprocessing(C, output_col="features")), C.id, C.target, FEATURES, PENALTIES, 4)
        held.unpersist()
    return df, _CHAINS[at]


@register("candidate_chain")
def q_candidate_chain(spark, sf):
    """M9 + M12: reference, ratio weight, oversampled rows and best tuned penalty of the logistic model, one row a stage: parameters,
    training summary, validation average precision, incumbent after it.  Boosted trees go through the same chain
    (``selection.boosting_learner``); seven fits of 600 rounds are more than a registered query may take."""
    return round_doubles(logistic_chain(spark, sf)[1].ledger)


@register("calibration_refit_report")
def q_calibration_refit(spark, sf):
    """C4: the chain's winner refitted on train minus a stratified holdout, calibrated there; raw and calibrated metrics of
    holdout, validation and test."""
    df, chain = logistic_chain(spark, sf)
    done = SEL.calibrate_by_refit(df.where(F.col("split") == "train"), df.where(F.col("split") != "train"),
                                  df.where(F.col("split") == "validation"), chain.winner.recipe,
                                  SEL.logistic_learner(preprocessing(C, output_col="features")), C.id, C.target, FEATURES)
    return round_doubles(SEL.refit_report(done, C.target))


# ---------------------------------------------------------------- X1 / X2 importance
def _fixed_rule(frame):
    return fixed_score(C.utilization, C.income)


def _importance_ctes(groups: list[list[str]], repeats: int, seed: int) -> str:
    """``imp``: (feature_name, r, importance, permuted, baseline) of the validation rows under the fixed rule."""
    used = list(dict.fromkeys(c for g in groups for c in g))
    variants = " UNION ALL ".join(
        f"SELECT '{'+'.join(g)}' AS f, m.stream AS r, m.target, "
        + ", ".join(f"{'g' if c in g else 'm'}.{c} AS {c}" for c in (C.utilization, C.income))
        + " FROM met m JOIN val g ON g.rank = m.giver" for g in groups)
    metric = lambda src, by: f"(SELECT * FROM {S.metrics_sql(src, by)})"
    return (S.split_cte() + f""",
val AS (SELECT row_number() OVER (ORDER BY case_id) - 1 AS rank, target, {', '.join(dict.fromkeys([*used, C.utilization, C.income]))}
  FROM split_cases WHERE split = 'validation'),
met AS (SELECT v.*, p.stream, p.rank AS giver FROM {P_SQL('val', '(SELECT count(*) FROM val)', seed, repeats)} p JOIN val v ON v.rank = p.image),
variants AS ({variants}),
scored_variants AS (SELECT f, r, target, {FIXED_SCORE_SQL} AS score FROM variants),
scored_val AS (SELECT target, {FIXED_SCORE_SQL} AS score FROM val),
imp AS (SELECT x.f AS feature_name, x.r, x.average_precision AS permuted, b.average_precision AS baseline,
    b.average_precision - x.average_precision AS importance
  FROM {metric('scored_variants', 'f, r')} x, {metric('scored_val', None)} b)""")


def _importance_sql(groups: list[list[str]], repeats: int, seed: int, body: str) -> str:
    return S.with_cases(body, _importance_ctes(groups, repeats, seed))


_MEAN_IMPORTANCE = f"SELECT feature_name, {S.r6('avg(importance)', 'mean_importance')}, {S.r6('stddev_pop(importance)', 'std_importance')}, " \
    f"{S.r6('avg(permuted)', 'mean_permuted_metric')} FROM imp GROUP BY feature_name"


@register("permutation_importance", _importance_sql([[f] for f in FEATURES], 5, 42, _MEAN_IMPORTANCE.replace(
    " FROM imp", f", {S.r6('max(baseline)', 'baseline_metric_value')} FROM imp")))
def q_permutation_importance(spark, sf):
    """10 features x 5 repeats of the validation rows, scored by the fixed rule, one job."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation").select(C.id, C.target) \
        .join(cases(spark, sf).drop(C.target), on=C.id)
    imp = X.permutation_importance(val, C.id, C.target, FEATURES, _fixed_rule, repeats=5, seed=42)
    return round_doubles(imp.select("feature_name", "mean_importance", "std_importance", "mean_permuted_metric",
                                    "baseline_metric_value"))


# ---------------------------------------------------------------- R1-R6 comparison
from riskloom.operators import compare as CMP  # noqa: E402
from riskloom.operators import monitoring as D  # noqa: E402

# Three deterministic scoring rules stand in for three trained models, so the whole comparison has an oracle.
RULES = {
    "rule_a": ("0.3 * utilization + CASE WHEN income < 1000 THEN 0.5 ELSE 0.0 END",
               lambda: F.lit(0.3) * F.col("utilization")
               + F.when(F.col("income") < 1000, F.lit(0.5)).otherwise(F.lit(0.0))),
    "rule_b": ("0.3 * utilization + CASE WHEN income < 1000 THEN 0.5 ELSE 0.0 END + 0.01 * least(late_90, 20)",
               lambda: F.lit(0.3) * F.col("utilization")
               + F.when(F.col("income") < 1000, F.lit(0.5)).otherwise(F.lit(0.0))
               + F.lit(0.01) * F.least(F.col("late_90"), F.lit(20))),
    "rule_c": ("0.6 * utilization", lambda: F.lit(0.6) * F.col("utilization")),
}
CONFIGS = [CMP.ModelConfig("rule_a", "Utilization and income rule", "rule"),
           CMP.ModelConfig("rule_b", "Rule with delinquency", "rule", True, True, True),
           CMP.ModelConfig("rule_c", "Utilization-only rule", "rule")]


def _rule_score(expr: Column) -> Column:
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), expr))
    return (F.floor(clipped * F.lit(1000.0) + F.lit(0.5)) / F.lit(1000.0)).cast("double")


def _rule_sql(expr: str) -> str:
    return f"CAST(floor(least(1.0, greatest(0.0, {expr})) * 1000.0 + 0.5) / 1000.0 AS DOUBLE)"


def multi_model_scores(spark, sf) -> DataFrame:
    df = split_cases(spark, sf)
    entries = [F.struct(F.lit(k).alias("model_key"), _rule_score(fn()).alias("score")) for k, (_, fn) in RULES.items()]
    return df.select(C.id, C.target, "split", F.inline(F.array(*entries)))


def comparison_flagged(spark, sf) -> DataFrame:
    sc = multi_model_scores(spark, sf)
    metrics = K.binary_metrics(sc, C.target, "score", 0.5, ["model_key", "split"])
    val = sc.where(F.col("split") == "validation")
    sweep = T.threshold_sweep(val, C.target, "score", T.candidate_grid(val, "score", ["model_key"]), ["model_key"])
    f1 = T.select_threshold(sweep, "f1", ["model_key"], top=1).select("model_key", F.col("threshold").alias("f1_threshold"))
    cost = T.select_cost_threshold(T.business_cost(sweep, 1.0, 5.0), ["model_key"], top=1) \
        .select("model_key", F.col("threshold").alias("cost_threshold"))
    records = CMP.model_records(metrics, CMP.config_table(spark, CONFIGS), f1.join(cost, on="model_key"))
    return CMP.champion_flags(CMP.rank_models(records))


def _comparison_sql(last: str | None = None) -> str:
    scores = " UNION ALL ".join(f"SELECT case_id, target, split, '{k}' AS model_key, {_rule_sql(e)} AS score "
                                f"FROM split_cases" for k, (e, _) in RULES.items())
    grp = "(SELECT *, concat(model_key, '|', split) AS grp FROM sc)"
    met = S.metrics_sql(grp, "grp")
    qs = S.quantile_sql("(SELECT model_key, score FROM sc WHERE split = 'validation')", "model_key", "score", _GRID_P)
    fixed = ", ".join(f"({v!r})" for v in R.FIXED_THRESHOLD_CANDIDATES)
    grid = (f"SELECT DISTINCT model_key, least(1.0, greatest(0.0, t)) AS threshold FROM "
            f"(SELECT model_key, quantile AS t FROM {qs} qq UNION ALL SELECT m.model_key, CAST(f.v AS DOUBLE) "
            f"FROM (SELECT DISTINCT model_key FROM sc) m, (VALUES {fixed}) f(v)) u")
    sweep = ("SELECT model_key, threshold, tp, fp, P - tp AS fn, N - fp AS tn, P + N AS n, "
             "coalesce(tp / nullif(P, 0), 0.0) AS recall, "
             "coalesce(2.0 * tp / nullif(2.0 * tp + fp + (P - tp), 0), 0.0) AS f1 FROM ("
             "SELECT g.model_key, g.threshold, "
             "CAST(sum(CASE WHEN v.score >= g.threshold AND v.target = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, "
             "CAST(sum(CASE WHEN v.score >= g.threshold AND v.target = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, "
             "CAST(sum(CASE WHEN v.target = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS P, "
             "CAST(sum(CASE WHEN v.target = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS N "
             "FROM grid g JOIN (SELECT * FROM sc WHERE split = 'validation') v ON g.model_key = v.model_key "
             "GROUP BY g.model_key, g.threshold) x")
    th = ("SELECT a.model_key, a.threshold AS f1_threshold, b.threshold AS cost_threshold FROM "
          "(SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY f1 DESC, recall DESC, threshold) AS r FROM sweep) a "
          "JOIN (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY (fp * 1.0 + fn * 5.0) / n, recall DESC, "
          "threshold) AS r FROM sweep) b ON a.model_key = b.model_key AND a.r = 1 AND b.r = 1")
    cfg = " UNION ALL ".join(
        f"SELECT '{c.model_key}' AS model_key, '{c.label}' AS label, '{c.model_family}' AS model_family, "
        f"{str(c.interactive_inference_supported).upper()} AS interactive_inference_supported, "
        f"{str(c.batch_inference_supported).upper()} AS batch_inference_supported, "
        f"{str(c.designated_champion).upper()} AS designated_champion" for c in CONFIGS)
    wide = ", ".join(f"max(CASE WHEN split_part(grp, '|', 2) = '{p}' THEN {m} END) AS {p}_{m}"
                     for p in ("validation", "test") for m in ("average_precision", "roc_auc", "ks_statistic",
                                                              "brier_score"))
    rec = (f"SELECT c.*, w.* EXCLUDE (model_key), t.f1_threshold, t.cost_threshold FROM cfg c "
           f"JOIN (SELECT split_part(grp, '|', 1) AS model_key, {wide} FROM met GROUP BY 1) w ON c.model_key = w.model_key "
           f"LEFT JOIN th t ON c.model_key = t.model_key")
    ranked = ("SELECT *, CAST(row_number() OVER (ORDER BY validation_average_precision DESC, test_average_precision DESC, "
              "test_roc_auc DESC, model_key) AS INTEGER) AS rank FROM rec")
    qual = ("SELECT *, coalesce(designated_champion AND test_average_precision >= bt - 0.02 AND "
            "validation_average_precision >= bv - 0.02 AND interactive_inference_supported AND batch_inference_supported "
            "AND f1_threshold IS NOT NULL AND cost_threshold IS NOT NULL AND test_brier_score <= 0.06, false) AS dq "
            "FROM (SELECT *, max(CASE WHEN rank = 1 THEN validation_average_precision END) OVER () AS bv, "
            "max(CASE WHEN rank = 1 THEN test_average_precision END) OVER () AS bt FROM ranked) z")
    dbl = [f"{p}_{m}" for p in ("validation", "test") for m in ("average_precision", "roc_auc", "ks_statistic",
                                                                "brier_score")] + ["f1_threshold", "cost_threshold"]
    final = ("SELECT rank, model_key, label, model_family, " + ", ".join(S.r6(c, c) for c in dbl)
             + ", interactive_inference_supported, batch_inference_supported, designated_champion, "
             "CASE WHEN max(CAST(dq AS INTEGER)) OVER () = 1 THEN dq ELSE rank = 1 END AS is_champion FROM qual")
    return S.with_cases(last or final, S.split_cte() + f",\nsc AS ({scores}),\nmet AS (SELECT * FROM {met} mm),\n"
                        f"grid AS ({grid}),\nsweep AS ({sweep}),\nth AS ({th}),\ncfg AS ({cfg}),\nrec AS ({rec}),\n"
                        f"ranked AS ({ranked}),\nqual AS ({qual})")


_LEDGER_SQL = (
    "SELECT a.stage, a.source, " + S.r6("a.metric", "metric") + ", (SELECT arg_max(b.source, b.metric * 1e9 - b.stage * 1e-3) FROM l b "
    "WHERE b.stage <= a.stage) AS incumbent, NOT EXISTS (SELECT 1 FROM l b WHERE b.stage < a.stage AND b.metric >= a.metric) AS replaced FROM l a")


@register("candidate_ledger", _comparison_sql(_LEDGER_SQL).replace("qual AS (", "l AS (SELECT CAST(CASE split_part(grp, '|', 1) " + " ".join(
    f"WHEN '{k}' THEN {i}" for i, k in enumerate(RULES)) + " END AS INTEGER) AS stage, split_part(grp, '|', 1) AS source, average_precision "
    "AS metric FROM met WHERE split_part(grp, '|', 2) = 'validation'),\nqual AS (", 1))
def q_candidate_ledger(spark, sf):
    """M12's fold: the fixed rules as candidates in stage order, the incumbent replaced only by a strictly better one."""
    metrics = K.binary_metrics(multi_model_scores(spark, sf), C.target, "score", 0.5, ["model_key", "split"])
    stages = spark.createDataFrame([(i, k) for i, k in enumerate(RULES)], "stage int, model_key string")
    ledger = metrics.where(F.col("split") == "validation").join(F.broadcast(stages), "model_key").select(
        "stage", F.col("model_key").alias("source"), F.col("average_precision").alias("metric"))
    return round_doubles(SEL.with_incumbents(ledger))


@register("model_comparison", _comparison_sql())
def q_model_comparison(spark, sf):
    """Records, ranking and the champion rule over three scoring rules (grouped metrics and a
    grouped threshold search, one job each)."""
    return round_doubles(CMP.comparison_table(comparison_flagged(spark, sf)))


def _rationale_sql() -> str:
    said = [("rank = 1", CMP.SENTENCE_RANKED_FIRST, "validation_average_precision"),
            ("test_average_precision = best_test", CMP.SENTENCE_STRONGEST_TEST, "test_average_precision"),
            ("test_brier_score = least_brier", CMP.SENTENCE_LOWEST_BRIER, "test_brier_score"),
            ("f1_threshold IS NOT NULL", CMP.SENTENCE_THRESHOLDS, None),
            ("interactive_inference_supported AND batch_inference_supported", CMP.SENTENCE_INFERENCE, None)]
    rows = " UNION ALL ".join(
        f"SELECT model_key, {i} AS k, " + (f"printf('{text}', label, {value})" if value else f"'{text}'")
        + f" AS sentence FROM flagged WHERE is_champion AND {condition}" for i, (condition, text, value) in enumerate(said))
    return _comparison_sql(
        "SELECT model_key, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS point, sentence FROM (WITH flagged AS ("
        "SELECT *, CASE WHEN max(CAST(dq AS INTEGER)) OVER () = 1 THEN dq ELSE rank = 1 END AS is_champion, "
        "max(test_average_precision) OVER () AS best_test, min(test_brier_score) OVER () AS least_brier FROM qual) "
        + rows + ") said")


@register("comparison_rationale", _rationale_sql())
def q_comparison_rationale(spark, sf):
    """The champion's rationale sentences, only those that hold."""
    return CMP.rationale(comparison_flagged(spark, sf))


# ---------------------------------------------------------------- D1-D14 second wave
@register("calibration_curve", S.with_cases(
    "SELECT split, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS count, "
    + S.rnd6("avg(score)") + " AS mean_predicted, " + S.rnd6("avg(CAST(target AS DOUBLE))")
    + " AS observed_rate FROM scored GROUP BY split, CAST(least(floor(score * 10), 9) AS INTEGER)", S.scored_cte()))
def q_calibration_curve(spark, sf):
    """D1."""
    return round_doubles(D.calibration_curve(scored_cases(spark, sf), C.target, "score", 10, ["split"]))


@register("gains_table", S.with_cases(
    "SELECT decile, CAST(rows AS BIGINT) AS rows, CAST(positives AS BIGINT) AS positives, "
    + S.rnd6("min_score") + " AS min_score, " + S.rnd6("max_score") + " AS max_score, "
    "CAST(cum_pos AS BIGINT) AS cumulative_positives, " + S.rnd6("CAST(cum_pos AS DOUBLE) / P") + " AS cumulative_gain, "
    + S.rnd6("(CAST(positives AS DOUBLE) / rows) / (CAST(P AS DOUBLE) / N)") + " AS lift, "
    + S.rnd6("(CAST(cum_pos AS DOUBLE) / cum_rows) / (CAST(P AS DOUBLE) / N)") + " AS cumulative_lift "
    "FROM (SELECT *, sum(positives) OVER (ORDER BY decile) AS cum_pos, sum(rows) OVER (ORDER BY decile) AS cum_rows, "
    "sum(positives) OVER () AS P, sum(rows) OVER () AS N FROM ("
    "SELECT CAST(floor((rn - 1) * 10 / n) AS INTEGER) AS decile, count(*) AS rows, sum(target) AS positives, "
    "min(score) AS min_score, max(score) AS max_score FROM (SELECT *, row_number() OVER (ORDER BY score DESC, case_id) AS rn, "
    "count(*) OVER () AS n FROM scored WHERE split = 'validation') r GROUP BY 1) d) x", S.scored_cte()))
def q_gains_table(spark, sf):
    """Deciles by exact rank on the validation split."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation")
    return round_doubles(D.gains_table(val, C.target, "score", C.id, 10))


_TARGET_PRECISIONS = [0.3, 0.5, 0.7]


@register("recall_at_precision", S.with_cases(
    "SELECT CAST(t AS DOUBLE) AS target_precision, " + S.rnd6("max(recall)") + " AS max_recall, "
    + S.rnd6("arg_min(s, (-recall, s))") + " AS threshold FROM (SELECT s, cum_pos / (cum_pos + cum_neg) AS precision, "
    "cum_pos / tot_pos AS recall FROM rt WHERE split = 'validation') p, (VALUES "
    + ", ".join(f"({v!r})" for v in _TARGET_PRECISIONS) + ") tp(t) WHERE precision >= t GROUP BY t",
    S.scored_cte() + f",\nrt AS ({_curve_rt_sql()})"))
def q_recall_at_precision(spark, sf):
    """D3."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation")
    return round_doubles(D.recall_at_precision(val, C.target, "score", _TARGET_PRECISIONS))


_PSI_SPLIT = "2024-01-16 00:00:00"


def _events(spark, sf):
    from riskloom.sources.tables import read_table
    return read_table(spark, sf, "events")


def _psi_sql() -> str:
    qs = S.quantile_sql(f"(SELECT event_type, value FROM events WHERE ts < TIMESTAMP '{_PSI_SPLIT}')", "event_type",
                        "value", [i / 10 for i in range(1, 10)])
    return f"""
WITH cuts AS (SELECT event_type, list(quantile ORDER BY q_index) AS c FROM {qs} qq GROUP BY event_type),
binned AS (
  SELECT e.event_type, CASE WHEN e.ts < TIMESTAMP '{_PSI_SPLIT}' THEN 'base' ELSE 'current' END AS period,
         CAST(len(list_filter(c.c, lambda x: e.value > x)) AS INTEGER) AS bin
  FROM events e JOIN cuts c ON e.event_type = c.event_type WHERE e.value IS NOT NULL),
counts AS (
  SELECT event_type, bin, CAST(sum(CASE WHEN period = 'base' THEN 1 ELSE 0 END) AS BIGINT) AS base_count,
         CAST(sum(CASE WHEN period = 'current' THEN 1 ELSE 0 END) AS BIGINT) AS current_count
  FROM binned GROUP BY event_type, bin),
shares AS (
  SELECT *, greatest(CAST(base_count AS DOUBLE) / sum(base_count) OVER (PARTITION BY event_type), 1e-6) AS bs,
            greatest(CAST(current_count AS DOUBLE) / sum(current_count) OVER (PARTITION BY event_type), 1e-6) AS cs
  FROM counts)
SELECT event_type, {S.rnd6('sum((cs - bs) * ln(cs / bs))')} AS psi, CAST(sum(base_count) AS BIGINT) AS base_rows,
       CAST(sum(current_count) AS BIGINT) AS current_rows
FROM shares GROUP BY event_type"""


@register("psi_drift", _psi_sql())
def q_psi_drift(spark, sf):
    """Population stability of ``events.value`` per event type, first vs second half of the month."""
    ev = _events(spark, sf)
    # events.ts is stored as wall-clock time (no UTC adjustment): compare with a wall-clock literal
    split = F.col("ts") < F.lit(_PSI_SPLIT).cast(ev.schema["ts"].dataType)
    t = D.psi(ev.where(split), ev.where(~split), "value", 10, ["event_type"])
    return round_doubles(t.groupBy("event_type").agg(F.sum("psi_term").alias("psi"),
                                                     F.sum("base_count").cast("long").alias("base_rows"),
                                                     F.sum("current_count").cast("long").alias("current_rows")))


_BANDS = [("very_low", None, 0.05), ("low", 0.05, 0.10), ("medium", 0.10, 0.20), ("high", 0.20, 0.40),
          ("very_high", 0.40, None)]


def _bands_sql(col: str) -> str:
    parts = []
    for name, lo, hi in _BANDS:
        cond = " AND ".join([f"{col} >= {lo!r}"] * (lo is not None) + [f"{col} < {hi!r}"] * (hi is not None)) or "TRUE"
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


@register("custom_risk_bands", S.with_cases(
    f"SELECT split, {_bands_sql('score')} AS band, CAST(count(*) AS BIGINT) AS count, "
    + S.rnd6("avg(CAST(target AS DOUBLE))") + f" AS observed_rate FROM scored GROUP BY split, {_bands_sql('score')}",
    S.scored_cte()))
def q_custom_risk_bands(spark, sf):
    """Configurable bands as one CASE expression (no join needed)."""
    sc = scored_cases(spark, sf).withColumn("band", D.band_expression(F.col("score"), _BANDS))
    return round_doubles(sc.groupBy("split", "band").agg(F.count(F.lit(1)).alias("count"),
                                                         F.avg(F.col(C.target).cast("double")).alias("observed_rate")))


def _cohort_sql() -> str:
    long = " UNION ALL ".join(f"SELECT CAST(target AS VARCHAR) || '|' || '{c}' AS grp, CAST({c} AS DOUBLE) AS value "
                              f"FROM cases" for c in FEATURES)
    qs = S.quantile_sql("long_c", "grp", "value", [0.5])
    return S.with_cases(
        "SELECT CAST(split_part(m.grp, '|', 1) AS INTEGER) AS cohort, split_part(m.grp, '|', 2) AS \"column\", "
        "CAST(m.cnt AS BIGINT) AS count, " + S.rnd6("m.mean") + " AS mean, " + S.rnd6("q.quantile") + " AS median "
        f"FROM (SELECT grp, count(value) AS cnt, avg(value) AS mean FROM long_c GROUP BY grp) m "
        f"LEFT JOIN {qs} q ON m.grp = q.grp", f"long_c AS ({long})")


@register("cohort_profile", _cohort_sql())
def q_cohort_profile(spark, sf):
    """Feature profile of positives vs negatives."""
    return round_doubles(D.cohort_profile(cases(spark, sf), C.target, FEATURES))


def _treatment_sql() -> str:
    parts = []
    for c, (lo, hi) in _CLIP.items():
        parts.append(f"SELECT '{c}' AS \"column\", 'capped' AS treatment, "
                     f"CAST(sum(CASE WHEN {c} < {lo!r} OR {c} > {hi!r} THEN 1 ELSE 0 END) AS BIGINT) AS rows FROM cases")
    for c in ("income", "dependents"):
        parts.append(f"SELECT '{c}', 'imputed', CAST(count(*) - count({c}) AS BIGINT) FROM cases")
    return S.with_cases(" UNION ALL ".join(parts))


@register("treatment_audit", _treatment_sql())
def q_treatment_audit(spark, sf):
    """D6."""
    return D.treatment_audit(cases(spark, sf), _CLIP, [C.income, C.dependents])


@register("joint_delinquency", S.with_cases(
    "SELECT CAST(sum(CASE WHEN late_30_59 > 20 OR late_60_89 > 20 OR late_90 > 20 THEN 1 ELSE 0 END) AS BIGINT) "
    "AS any_column_over_limit, CAST(sum(CASE WHEN late_30_59 > 20 AND late_60_89 > 20 AND late_90 > 20 THEN 1 ELSE 0 END) "
    "AS BIGINT) AS all_columns_over_limit, CAST(count(*) AS BIGINT) AS row_count FROM cases"))
def q_joint_delinquency(spark, sf):
    """D7."""
    return D.joint_delinquency(cases(spark, sf), list(C.delinquency))


_CORR_COLS = FEATURES


@register("correlation_overview", S.with_cases(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {S.rnd6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS pearson "
    f"FROM cases" for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:])))
def q_correlation_overview(spark, sf):
    """D8 (Pearson, one aggregate for all pairs)."""
    return round_doubles(D.correlation_matrix(cases(spark, sf), _CORR_COLS))


def _spearman_ctes() -> str:
    ranks = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) "
                      f"+ (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 END AS {c}" for c in _CORR_COLS)
    rho = " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS rho FROM ranks"
                             for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:])
    return f"ranks AS (SELECT {ranks} FROM cases),\nrho AS ({rho})"


def _spearman(spark, sf):
    return D.correlation_matrix(D.spearman_ranks(cases(spark, sf), C.id, _CORR_COLS), _CORR_COLS)


@register("spearman_overview", S.with_cases(f"SELECT column_a, column_b, {S.r6('rho', 'pearson')} FROM rho", _spearman_ctes()))
def q_spearman_overview(spark, sf):
    """D8 (Spearman): exact average ranks, then Pearson of ranks."""
    return round_doubles(_spearman(spark, sf))


#: |rho| from which two columns are one cluster in the registered query: the derived cases' columns are weakly related.
CLUSTER_RHO = 0.5


@register("spearman_clusters", S.with_cases(
    "SELECT \"column\", cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size FROM (SELECT a AS \"column\", min(b) AS cluster FROM reach GROUP BY a)",
    _spearman_ctes() + f""",
links AS (SELECT column_a AS a, column_b AS b FROM rho WHERE abs(rho) >= {CLUSTER_RHO} UNION ALL SELECT column_b, column_a FROM rho WHERE abs(rho) >= {CLUSTER_RHO}),
reach AS (WITH RECURSIVE r AS (SELECT x AS a, x AS b FROM (VALUES {', '.join(f"('{c}')" for c in _CORR_COLS)}) v(x)
  UNION SELECT r.a, l.b FROM r JOIN links l ON l.a = r.b) SELECT * FROM r)"""))
def q_spearman_clusters(spark, sf):
    """Columns that hang together by Spearman's rho."""
    return D.correlation_clusters(_spearman(spark, sf), "pearson", _CORR_COLS, CLUSTER_RHO)


_IMPORTANCE_GROUPS = [[C.utilization], [C.income, C.dependents], list(C.delinquency), [C.age, C.debt_ratio]]


@register("grouped_permutation_importance", _importance_sql(_IMPORTANCE_GROUPS, 5, 7, _MEAN_IMPORTANCE))
def q_grouped_permutation(spark, sf):
    """Columns shuffled together (income with its missingness partner dependents, the delinquency trio)."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation").select(C.id, C.target) \
        .join(cases(spark, sf).drop(C.target), on=C.id)
    imp = X.permutation_importance(val, C.id, C.target, _IMPORTANCE_GROUPS, _fixed_rule, seed=7)
    return round_doubles(imp.select("feature_name", "mean_importance", "std_importance", "mean_permuted_metric"))


# ---------------------------------------------------------------- column-generic checks on other tables
_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_summary_sql() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in _LI_COLS)
    qs = S.quantile_sql("long_li", "col", "value", _SUMMARY_P)
    pcols = ", ".join(f"max(CASE WHEN q_index = {i} THEN quantile END) AS {E._pname(p)}" for i, p in enumerate(_SUMMARY_P))
    names = ["mean", "std", "min"] + [E._pname(p) for p in _SUMMARY_P] + ["max"]
    return (f"WITH long_li AS ({long}) SELECT m.col AS \"column\", " + S.rnd6("m.cnt") + " AS count, "
            + ", ".join(f"{S.rnd6(n if n not in ('mean', 'std', 'min', 'max') else 'm.' + n)} AS {n}" for n in names)
            + " FROM (SELECT col, count(value) AS cnt, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, "
            f"max(value) AS max FROM long_li GROUP BY col) m LEFT JOIN (SELECT col, {pcols} FROM {qs} qq GROUP BY col) p "
            "ON m.col = p.col")


@register("lineitem_numeric_summary", _lineitem_summary_sql())
def q_lineitem_summary(spark, sf):
    """E5 on another table (600k rows at sf0.1): the profiler is column-generic."""
    from riskloom.sources.tables import read_table
    return round_doubles(E.numeric_summary(read_table(spark, sf, "lineitem"), _LI_COLS))


@register("document_quality_metrics", """
SELECT """ + S.r6("ap_num / P", "average_precision") + ", " + S.r6("auc_num / (P * N)", "roc_auc") + ", "
          + S.r6("ks", "ks_statistic") + """, CAST(P + N AS BIGINT) AS row_count FROM (
  SELECT max(tot_pos) AS P, max(tot_neg) AS N, sum(neg * (cum_pos - pos + pos / 2.0)) AS auc_num,
         sum(pos * (cum_pos / (cum_pos + cum_neg))) AS ap_num, max(abs(cum_pos / tot_pos - cum_neg / tot_neg)) AS ks
  FROM (SELECT *, CAST(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_pos,
               CAST(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_neg,
               CAST(sum(pos) OVER () AS DOUBLE) AS tot_pos, CAST(sum(neg) OVER () AS DOUBLE) AS tot_neg
        FROM (SELECT CAST(floor(least(1.0, d.n_chars / 20000.0) * 1000.0 + 0.5) / 1000.0 AS DOUBLE) AS s,
                     sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN l.quality = 0 THEN 1 ELSE 0 END) AS neg
              FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1) g) r) a""")
def q_document_quality_metrics(spark, sf):
    """K6-K8 on another table pair: labels.quality against a length score of documents."""
    from riskloom.sources.tables import read_table
    lab = read_table(spark, sf, "labels")
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    s = (F.floor(F.least(F.lit(1.0), F.col("n_chars") / 20000.0) * 1000.0 + 0.5) / 1000.0).cast("double")
    df = lab.join(doc, on="doc_id").select(F.col("quality").alias("y"), s.alias("s"))
    m = K.binary_metrics(df, "y", "s")
    return round_doubles(m.select("average_precision", "roc_auc", "ks_statistic", "row_count"))


# ---------------------------------------------------------------- I4-I7 SMOTE
def smote_train(spark, sf):
    from riskloom.operators.imbalance import smote
    train = split_cases(spark, sf).where(F.col("split") == "train").drop("split")
    return smote(train, C.id, C.target, FEATURES, k_neighbors=5, seed=42)


@register("smote_distribution", S.with_cases(
    "SELECT CAST(target AS INTEGER) AS target, CAST(cnt AS BIGINT) AS count_before, "
    "CAST(CASE WHEN target = 1 THEN max(cnt) OVER () ELSE cnt END AS BIGINT) AS count_after, "
    + S.rnd6("CAST(cnt AS DOUBLE) / sum(cnt) OVER ()") + " AS rate_before, "
    + S.rnd6("CAST(CASE WHEN target = 1 THEN max(cnt) OVER () ELSE cnt END AS DOUBLE) / (2.0 * max(cnt) OVER ())")
    + " AS rate_after FROM (SELECT target, count(*) AS cnt FROM split_cases WHERE split = 'train' GROUP BY target) t",
    S.split_cte()))
def q_smote_distribution(spark, sf):
    """Class counts before and after oversampling the train split."""
    from riskloom.operators.imbalance import oversampled_distribution
    dist = oversampled_distribution(split_cases(spark, sf).where(F.col("split") == "train"), C.target)
    return round_doubles(dist.select(F.col("target").cast("int").alias("target"), "count_before", "count_after",
                                     "rate_before", "rate_after"))


@register("smote_synthetic_rows")
def q_smote_rows(spark, sf):
    """The synthetic rows (negative ids) appended after the original train rows."""
    rows, _ = smote_train(spark, sf)
    return round_doubles(rows.where(F.col(C.id) < 0))


@register("ks_row_level_by_split", S.with_cases(
    "SELECT split, " + S.rnd6("max(abs(cp / tp - cn / tn))") + " AS ks_statistic_row_level FROM ("
    "SELECT split, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) OVER w AS DOUBLE) AS cp, "
    "CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) OVER w AS DOUBLE) AS cn, "
    "CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY split) AS DOUBLE) AS tp, "
    "CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY split) AS DOUBLE) AS tn FROM scored "
    "WINDOW w AS (PARTITION BY split ORDER BY score DESC, case_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r "
    "GROUP BY split", S.scored_cte()))
def q_ks_row_level(spark, sf):
    """K8 row-by-row variant (tie order = key order)."""
    return round_doubles(K.ks_row_level(scored_cases(spark, sf), C.target, "score", C.id, ["split"]))


@register("top_importances", _importance_sql([[f] for f in FEATURES], 5, 5, f"""SELECT feature_name, {S.r6('mean_importance', 'mean_importance')},
  CAST(row_number() OVER (ORDER BY mean_importance DESC, feature_name) AS INTEGER) AS rank
  FROM (SELECT feature_name, {S.r6('avg(importance)', 'mean_importance')} FROM imp GROUP BY feature_name) QUALIFY rank <= 3"""))
def q_top_importances(spark, sf):
    """The three largest permutation importances (a top-k is the operator)."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation").select(C.id, C.target) \
        .join(cases(spark, sf).drop(C.target), on=C.id)
    imp = X.permutation_importance(val, C.id, C.target, FEATURES, _fixed_rule, seed=5)
    # importances equal to six digits are ties, in order of their names
    return X.top_importances(round_doubles(imp.select("feature_name", "mean_importance")), "mean_importance", 3)


# ---------------------------------------------------------------- D4, D10, D13, M9-M14 (rows-only)
@register("bootstrap_intervals")
def q_bootstrap_intervals(spark, sf):
    """95 % Poisson-bootstrap intervals of the validation metrics (200 replicates, one job)."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation")
    return round_doubles(D.bootstrap_metrics(val, C.target, "score", C.id, seed=42))


@register("calibration_distribution_shift")
def q_calibration_shift(spark, sf):
    """Raw vs isotonic-calibrated probability histograms and mean absolute difference."""
    cal = calibrated_scores(spark, sf).where(F.col("split") == "validation")
    return round_doubles(D.distribution_shift(cal, "score", "calibrated", 20))


@register("importance_stability", _importance_sql([[f] for f in FEATURES], 6, 1, f"""
SELECT run_a, run_b, {S.r6('corr(rank_a, rank_b)', 'rank_correlation')}, {S.r6('sum(CASE WHEN rank_a <= 5 AND rank_b <= 5 THEN 1 ELSE 0 END) / 5.0', 'top_k_overlap')}
FROM (SELECT a.run AS run_a, b.run AS run_b, CAST(a.rank AS DOUBLE) AS rank_a, CAST(b.rank AS DOUBLE) AS rank_b
  FROM ranked_runs a JOIN ranked_runs b ON a.feature_name = b.feature_name AND a.run < b.run) GROUP BY run_a, run_b""").replace(
    "\nSELECT run_a", f""",
ranked_runs AS (SELECT feature_name, run, row_number() OVER (PARTITION BY run ORDER BY mean_importance DESC, feature_name) AS rank FROM (
  SELECT feature_name, CAST(r // 2 AS INTEGER) AS run, {S.r6('sum(importance) / 2.0', 'mean_importance')} FROM imp GROUP BY feature_name, r // 2))
SELECT run_a""", 1))
def q_importance_stability(spark, sf):
    """Top-5 overlap and rank correlation of permutation importances across three seeds."""
    val = scored_cases(spark, sf).where(F.col("split") == "validation").select(C.id, C.target) \
        .join(cases(spark, sf).drop(C.target), on=C.id)
    # three runs = three disjoint pairs of repeats of one permutation job (each repeat has its own permutation)
    imp = X.permutation_importance(val, C.id, C.target, FEATURES, _fixed_rule, repeats=6, seed=1)
    runs = round_doubles(imp.select("feature_name", F.posexplode(F.array(*[
        (F.col("importance_values")[2 * j] + F.col("importance_values")[2 * j + 1]) / 2.0 for j in range(3)]))
        .alias("run", "mean_importance"))).persist()  # a 30-row table read three times below
    return round_doubles(D.importance_stability(runs, "run", "feature_name", "mean_importance", 5))


@register("model_reload_check")
def q_model_reload_check(spark, sf):
    """M10 + S9: save the pipeline to the shared checkpoint folder, reload, score validation."""
    import os
    import uuid

    from riskloom.session import ensure_checkpoint_dir
    df, model = trained_model(spark, sf, "logistic")
    path = os.path.join(ensure_checkpoint_dir(spark), f"reload-{uuid.uuid4().hex}")
    return round_doubles(M.reload_check(model, df.where(F.col("split") == "validation"), path))


@register("random_search_leaderboard")
def q_random_search(spark, sf):
    """Seeded random search over the logistic penalty (12 draws: all 8 combinations); each fit is a Spark job; leaderboard
    by validation average precision (ties -> earlier candidate)."""
    df, train = _train_frame(spark, sf)
    n = float(train.count())
    # imputing and scaling are the same for every candidate: fitted once, their vectors are held for all fits
    prepared = preprocessing(C, output_col="features").fit(train)
    held, judged = (prepared.transform(part).select(C.target, "split", "features").persist()
                    for part in (train, df.where(F.col("split") == "validation")))

    def make(params):
        return M.logistic("features", C.target, n_weight=n, C=params["C"], max_iter=params["max_iter"])

    def evaluate(model, data):
        sc = M.predict_proba(model, data, keep=[C.target], out="p")
        return K.binary_metrics(sc, C.target, "p").first()["average_precision"]

    rows = M.random_search(held, judged, make, evaluate, {"C": [0.01, 0.1, 1.0, 10.0], "max_iter": [50, 200]},
                           n_iter=12, seed=42, split_col="split")
    board = spark.createDataFrame([(r["index"], float(r["params"]["C"]), int(r["params"]["max_iter"]), r["metric"],
                                    r["error"]) for r in rows],
                                  "stage int, C double, max_iter int, validation_average_precision double, error string")
    return round_doubles(board).orderBy(F.desc_nulls_last("validation_average_precision"), "stage")


# ---------------------------------------------------------------- V12 / V13 file checksums, D5 data checks
def file_checksums_frame(spark, sf):
    from riskloom.sources.checksums import file_checksums
    return file_checksums(spark, sf)


@register("file_checksums", "SELECT regexp_extract(filename, '[^/]+$', 0) AS name, sha256(content) AS sha256, "
          "CAST(size AS BIGINT) AS size_bytes FROM read_blob('/root/testdata/sf0.01/*.parquet')")
def q_file_checksums(spark, sf):
    """SHA-256 of every source file (one row per file; a large file is hashed in turns, each by a task that reads a bounded
    stretch of it and takes up the state of the turn before)."""
    return file_checksums_frame(spark, sf)


@register("content_fingerprints")
def q_content_fingerprints(spark, sf):
    """Row count and sum of row hashes of every table, whatever its size or number of files."""
    from riskloom.sources.tables import TABLE_NAMES, read_table
    parts = [V.content_fingerprint(read_table(spark, sf, name)).select(F.lit(name).alias("name"), "row_count", "fingerprint")
             for name in TABLE_NAMES]
    return reduce(DataFrame.unionAll, parts)


@register("dataset_fingerprint", "SELECT sha256(string_agg(name || ':' || h, '' ORDER BY name)) AS dataset_fingerprint "
          "FROM (SELECT regexp_extract(filename, '[^/]+$', 0) AS name, sha256(content) AS h "
          "FROM read_blob('/root/testdata/sf0.01/*.parquet')) f")
def q_dataset_fingerprint(spark, sf):
    """sha256 over name:hash in name order."""
    return V.dataset_fingerprint(file_checksums_frame(spark, sf))


def _data_checks_sql() -> str:
    parts = []
    for c in FEATURES:
        t = f"trim(CAST({c} AS VARCHAR))"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL OR {t} = '' OR lower({t}) = 'nan' THEN 1 ELSE 0 END) "
            f"AS BIGINT) AS missing_count, CAST(sum(CASE WHEN lower({t}) IN ('inf', '+inf', '-inf', 'infinity', '+infinity', "
            f"'-infinity') THEN 1 ELSE 0 END) AS BIGINT) AS infinite_count, CAST(sum(CASE WHEN NOT ({c} IS NULL OR {t} = '' "
            f"OR lower({t}) = 'nan' OR lower({t}) IN ('inf', '+inf', '-inf', 'infinity', '+infinity', '-infinity')) AND NOT "
            f"regexp_matches({t}, '{NUMERIC_PATTERN}') THEN 1 ELSE 0 END) AS BIGINT) AS unparseable_count, "
            f"{S.rnd6(f'CAST(sum(CASE WHEN {c} IS NULL OR {t} = {chr(39)}{chr(39)} OR lower({t}) = {chr(39)}nan{chr(39)} THEN 1 ELSE 0 END) AS DOUBLE) / count(*)')} "
            f"AS missing_rate FROM apps")
    return S.with_cases(" UNION ALL ".join(parts), f"apps AS ({applications_sql()})")


@register("upload_data_checks", _data_checks_sql())
def q_upload_data_checks(spark, sf):
    """Per raw column of the upload: missing (blank / NaN), infinite and unparseable counts, missing rate."""
    apps = load_applications(spark, sf)
    exprs = []
    for c in FEATURES:
        t = F.trim(F.col(c).cast("string"))
        missing = F.col(c).isNull() | (t == "") | (F.lower(t) == "nan")
        inf = F.lower(t).isin(*B.INFINITY_TEXT)
        bad = ~(missing | inf) & ~t.rlike(NUMERIC_PATTERN)
        exprs.append(F.struct(F.lit(c).alias("column"), F.count_if(missing).alias("missing_count"),
                              F.count_if(inf).alias("infinite_count"), F.count_if(bad).alias("unparseable_count"),
                              (F.count_if(missing) / F.count(F.lit(1))).alias("missing_rate")))
    return round_doubles(apps.agg(F.array(*exprs).alias("a")).select(F.inline("a")))


@register("upload_duplicate_ids", S.with_cases(
    "SELECT CAST(count(*) - count(DISTINCT case_id) AS BIGINT) AS duplicate_id_rows, CAST(count(*) AS BIGINT) AS row_count "
    "FROM apps", f"apps AS ({applications_sql()})"))
def q_upload_duplicate_ids(spark, sf):
    """Rows whose identifier repeats an earlier one (exact distinct count: a two-level aggregate)."""
    apps = load_applications(spark, sf)
    return apps.agg((F.count(F.lit(1)) - F.count_distinct(C.id)).alias("duplicate_id_rows"),
                    F.count(F.lit(1)).alias("row_count"))


_BEST_F1_SQL = (f"SELECT threshold FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, recall DESC, threshold) AS r "
                f"FROM ({_sweep_sql()}) sw) x WHERE r = 1")


@register("threshold_test_readout", S.with_cases(
    "SELECT *, 'constraints_satisfied' AS status FROM (" + S.round_select(
        S.metrics_sql("(SELECT * FROM scored WHERE split = 'test')", None,
                      threshold=f"CAST(({_BEST_F1_SQL}) AS DOUBLE)"), S.METRIC_LONGS, S.METRIC_DOUBLES) + ") t",
    S.scored_cte() + f",\ngrid AS ({_grid_sql()})"))
def q_threshold_test_readout(spark, sf):
    """T5: F1-optimal threshold chosen on validation, full metric bundle read out on test."""
    return round_doubles(T.threshold_report(scored_cases(spark, sf), C.target, "score", objective="f1"))


# ---------------------------------------------------------------- S1, S8, V1, V2, V5: the upload against its contract
def _upload_contract() -> CT.SourceContract:
    from pyspark.sql.types import LongType, StructType
    return CT.SourceContract("upload", StructType([CT.column(C.id, LongType(), "id"), *CT.feature_fields(C)]))


def _typed_apps_sql() -> str:
    """The text upload by its contract's types; odd_<column> where a value is there but not of the type."""
    missing = ", ".join(f"'{t}'" for t in CT.MISSING_TEXTS)
    parts = [C.id, "customer_ref"]
    for c in FEATURES:
        there = f"({c} IS NOT NULL AND lower(trim({c})) NOT IN ({missing}))"
        number = (f"CASE WHEN regexp_matches(trim({c}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
                  f"THEN TRY_CAST(trim({c}) AS DOUBLE) END")
        if c not in DOUBLE_FEATURES:
            number = f"CASE WHEN {number} = floor({number}) THEN CAST({number} AS BIGINT) END"
        parts += [f"{number} AS {c}", f"({there} AND ({number}) IS NULL) AS odd_{c}"]
    return f"SELECT {', '.join(parts)} FROM apps"


def _upload_report_sql() -> str:
    kinds = {c: "double" if c in DOUBLE_FEATURES else "bigint" for c in FEATURES}
    odd = " UNION ALL ".join(
        "SELECT 'upload' AS dataset, 'error' AS severity, 'unreadable_values' AS rule, '"
        + V.MSG_UNREADABLE.format(col=c, kind=kinds[c]).replace("'", "''") + f"' AS message FROM typed_apps HAVING bool_or(odd_{c})"
        for c in FEATURES)
    return f"""{odd}
UNION ALL SELECT 'upload', 'error', 'unexpected_columns', '{R.MSG_UNEXPECTED_COLUMNS}'
UNION ALL SELECT 'upload', 'warning', 'id_not_unique', '{R.MSG_ID_NOT_UNIQUE}' FROM typed_apps
HAVING count(DISTINCT case_id) + max(CASE WHEN case_id IS NULL THEN 1 ELSE 0 END) <> count(*)
UNION ALL SELECT 'upload', 'error', 'empty', '{R.MSG_EMPTY_FILE}' FROM typed_apps HAVING count(*) = 0
UNION ALL SELECT 'upload', 'warning', rule, message FROM ({_warnings_sql("flags")}) w WHERE message IS NOT NULL"""


@register("raw_contract_report", S.with_cases(
    _upload_report_sql(),
    f"apps AS ({applications_sql()}), typed_apps AS ({_typed_apps_sql()}), flags AS ({_flags_sql('typed_apps')})"))
def q_raw_contract_report(spark, sf):
    report = V.validation_messages(load_applications(spark, sf), _upload_contract(), C)
    return report.select("dataset", "severity", "rule", "message")


@register("typed_applications", S.with_cases(
    S.round_select("typed_apps", [C.id, "customer_ref", *[c for c in FEATURES if c not in DOUBLE_FEATURES]], DOUBLE_FEATURES),
    f"apps AS ({applications_sql()}), typed_apps AS ({_typed_apps_sql()})"))
def q_typed_applications(spark, sf):
    return round_doubles(files.typed(load_applications(spark, sf), C))


# ---------------------------------------------------------------- D11 labels that arrive late
from riskloom.operators import late_labels as LL  # noqa: E402
from riskloom.sources.tables import read_table  # noqa: E402

MATURITY_DAYS = (30, 90, 180)
_LATE_SQL = (
    "WITH e AS (SELECT max(o_orderdate) AS evaluated FROM orders), "
    "l AS (SELECT l_orderkey AS k, l_shipdate AS t, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label FROM lineitem "
    "WHERE l_orderkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY ALL), "
    "s AS (SELECT o_orderkey, o_orderdate AS scored_at, floor(least(o_totalprice / 500000.0, 1.0) * 1024.0 + 0.5) / 1024.0 AS score, "
    "CAST(days AS INTEGER) AS window_days, o_orderdate + to_days(CAST(days AS INTEGER)) <= evaluated AS matured, "
    "least(o_orderdate + to_days(CAST(days AS INTEGER)), evaluated) AS until "
    f"FROM orders, e, (SELECT unnest({list(MATURITY_DAYS)}) AS days) WHERE o_orderdate <= evaluated), "
    "j AS (SELECT s.*, l.label, l.t AS labelled_at FROM s ASOF LEFT JOIN l ON s.o_orderkey = l.k AND s.until >= l.t) ")


def late_labels(spark, sf) -> DataFrame:
    """Orders as scored cases (a fixed score of the price), the return flags of their lines as labels that arrive when a line ships;
    evaluated at the last order's date."""
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("scored_at"),
        (F.floor(F.least(F.col("o_totalprice") / 500000.0, F.lit(1.0)) * 1024.0 + 0.5) / 1024.0).alias("score"))  # a binary fraction: sums are exact
    lines = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").cast("timestamp").alias("labelled_at"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))
    evaluated = F.lit(orders.agg(F.max("scored_at")).first()[0]).cast("timestamp")
    return LL.labels_by_maturity(orders, lines, "o_orderkey", "scored_at", "score", "labelled_at", "label", evaluated, MATURITY_DAYS)


@register("late_labels_as_of", _LATE_SQL + "SELECT o_orderkey, window_days, matured, label, labelled_at FROM j")
def q_late_labels(spark, sf):
    """The newest label of every scored order when each maturity window ended."""
    return late_labels(spark, sf).select("o_orderkey", "window_days", "matured", "label", "labelled_at")


@register("late_label_vintages", _LATE_SQL + "SELECT CAST(date_trunc('month', scored_at) AS DATE) AS vintage, window_days, count(*) AS row_count, "
          "count_if(matured) AS matured_count, count(label) AS labelled_count, "
          + S.r6("1.0 - count(label) / count(*)", "unlabelled_share") + ", " + S.r6("sum(label) / nullif(count(label), 0)", "positive_rate") + ", "
          + S.r6("avg(CASE WHEN label IS NOT NULL THEN score END)", "mean_score") + ", " + S.r6("avg((score - label) * (score - label))", "brier_score")
          + ", " + S.r6("avg(score - label)", "calibration_gap") + " FROM j GROUP BY ALL")
def q_late_label_vintages(spark, sf):
    """Metrics by month of scoring and maturity window, with the share not yet labelled."""
    return round_doubles(LL.vintage_report(late_labels(spark, sf), "scored_at", "score", "label"))
