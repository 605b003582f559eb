"""Batch scoring rules and data-quality messages."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import contracts as CT
from riskloom.operators import quality as V
from riskloom.operators import scoring as B
from riskloom.rules import CreditColumns

COLS = CreditColumns(id="id", target="y", utilization="util", age="age", late_30_59="l30", debt_ratio="debt",
                     income="income", open_lines="open", late_90="l90", real_estate="re", late_60_89="l60",
                     dependents="dep")
FEATS = list(COLS.features)


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} string" for c in FEATS) + ", ref string")


def test_fake_scores_bands(spark):
    rows = [(1, "0.45", "42", "0", "0.32", "6500", "8", "0", "1", "0", "2", "A001"),
            (2, "0.80", "60", "3", "0.52", "6500", "8", "1", "1", "0", "2", "A002")]
    df = batch(spark, rows)
    norm = B.normalize_batch(df, COLS)
    p = F.when(F.col("_norm_l90") == 0, F.lit(0.05)).otherwise(F.lit(0.35))
    enriched = B.enrich(norm, p, 0.20, 0.14, "src", df.columns)
    got = {r.id: r for r in enriched.collect()}
    assert got[1].risk_band == "Low" and got[2].risk_band == "High"
    assert got[1].predicted_label_f1_threshold == 0 and got[2].predicted_label_cost_threshold == 1
    s = B.batch_summary(enriched).first()
    assert s.average_predicted_probability == pytest.approx(0.20)
    assert s.median_predicted_probability == pytest.approx(0.20)
    assert s.high_risk_share == 0.5


def test_row_rules(spark):
    rows = [(1, "0.5", "150", "0", "9", "", "8", "0", "1", "0", " ", "a"),     # clipped, blanks ok
            (2, "0.5", "17", "0", "0.3", "1", "8", "0", "1", "0", "1", "b"),   # age < 18
            (3, "abc", "40", "0", "0.3", "1", "8", "0", "1", "0", "1", "c"),   # non numeric
            (4, "0.5", "40", "1.5", "0.3", "1", "8", "0", "1", "0", "1", "d"),  # not integer-like
            (5, "0.5", "40", "0", "-1", "1", "8", "0", "1", "0", "1", "e"),    # negative
            (6, "0.5", "40", "0", "0.3", "1", "inf", "0", "1", "0", "1", "f"),  # infinity
            (7, "NaN", "40", "0", "0.3", "1", "8", "0", "1", "0", "1", "g")]   # NaN required
    norm = B.normalize_batch(batch(spark, rows), COLS)
    got = {r.id: r for r in norm.collect()}
    assert got[1].row_error is None and got[1]._norm_age == 100 and got[1]._norm_debt == 5.0
    assert got[1]._norm_income is None and got[1]._norm_dep is None
    assert got[2].row_error == "Field 'age' must be at least 18."
    assert got[3].row_error == "Field 'util' must be numeric."
    assert got[4].row_error == "Field 'l30' must be integer-like."
    assert got[5].row_error == "Field 'debt' must be non-negative."
    assert got[6].row_error == "Field 'open' must be numeric."
    assert got[7].row_error == "Field 'util' is required."


def test_fail_closed(spark):
    rows = [(1, "0.5", "40", "0", "0.3", "1", "8", "0", "1", "0", "1", "a"),
            (2, "0.5", "17", "0", "0.3", "1", "8", "0", "1", "0", "1", "b")]
    with pytest.raises(B.BatchValidationError) as err:
        B.score_batch(batch(spark, rows), COLS, lambda d: F.lit(0.1), 0.2, 0.14, "s", key="id")
    assert err.value.row_errors[0]["id"] == 2


def test_file_level_errors():
    errs = B.file_level_errors(["a", "a"], ["a", "b"], strict=True, is_empty=True)
    assert len(errs) == 3


def test_quality_warnings(spark):
    df = spark.createDataFrame([(1, 0, 1.5, 16.0, 25.0, 6.0, 0.0, 1.0, 0.0, 0.0, 30.0, -1.0)],
                               "id long, y int, util double, age double, l30 double, debt double, income double, "
                               "open double, l90 double, re double, l60 double, dep double")
    msgs = {r.rule: r.message for r in V.warning_rows(V.quality_flags(df, COLS), COLS).collect()}
    assert msgs["age_below_18_count"] == "Detected 1 rows with age below 18."
    assert msgs["delinquency_count_above_20"] == "Detected rows with unusually large delinquency counts in: l30, l60."
    assert msgs["dependents_negative_count"] == "Detected rows with negative dependent counts."


def test_validation_report_status(spark):
    df = spark.createDataFrame([(1, 2, 0.1), (1, 0, 0.2)], "id long, y int, util double")
    contract = CT.SourceContract("train", T.StructType([
        CT.column("id", T.LongType(), "id"), CT.column("y", T.IntegerType(), "target", labels="binary"),
        CT.column("util", T.DoubleType())]))
    rep = V.validation_report({"train": (df, contract)}, COLS)
    rules = {r.rule for r in rep.collect()}
    assert {"id_not_unique", "target_not_binary"} <= rules
    assert V.report_status(rep).first().status == "failed"


def test_model_registry_active_latest(spark):
    from riskloom.operators.layers import register_model_version
    reg = spark.createDataFrame([("m", "1", "2026-01-01")], "model_name string, model_version string, registered_at_utc string")
    new = spark.createDataFrame([("m", "2", "2026-02-01")], "model_name string, model_version string, registered_at_utc string")
    out = {r.model_version: r.is_active for r in register_model_version(reg, new).collect()}
    assert out == {"1": False, "2": True}


def test_champion_rule(spark):
    from riskloom.operators import compare as CMP
    cfg = CMP.config_table(spark, [CMP.ModelConfig("baseline", "B", "lr"),
                                   CMP.ModelConfig("xgboost", "X", "gbt", True, True, True),
                                   CMP.ModelConfig("torch", "T", "mlp")])
    vals = {"baseline": (.3224, .8278, .5130, .0534, .3303, .8311, .5071, .0531),
            "xgboost": (.4195, .8711, .5930, .0485, .4122, .8717, .5899, .0485),
            "torch": (.3976, .8723, .5904, .1494, .3959, .8692, .5847, .1494)}
    rows = []
    for k, v in vals.items():
        for i, part in enumerate(("validation", "test")):
            ap, auc, ks, br = v[4 * i:4 * i + 4]
            rows.append((k, part, ap, auc, ks, br, 0.0, 0.0, 0.0, 0.0))
    met = spark.createDataFrame(rows, "model_key string, split string, average_precision double, roc_auc double, "
                                "ks_statistic double, brier_score double, accuracy double, precision double, "
                                "recall double, f1 double")
    th = spark.createDataFrame([("xgboost", 0.19963, 0.13705)], "model_key string, f1_threshold double, cost_threshold double")
    flagged = CMP.champion_flags(CMP.rank_models(CMP.model_records(met, cfg, th)))
    got = {r.model_key: (r.rank, r.is_champion) for r in flagged.collect()}
    assert got == {"xgboost": (1, True), "torch": (2, False), "baseline": (3, False)}
