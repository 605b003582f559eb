"""Sources, sinks and the streaming scorer (reference fixture F-RAW-TRAIN with its original names)."""
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import contracts as CT
from riskloom.operators import quality as V
from riskloom.operators import scoring as B
from riskloom.rules import CreditColumns
from riskloom.sources import files as S
from riskloom.streaming import scoring as ST

GMSC = CreditColumns(
    id="Unnamed: 0", target="SeriousDlqin2yrs", utilization="RevolvingUtilizationOfUnsecuredLines", age="age",
    late_30_59="NumberOfTime30-59DaysPastDueNotWorse", debt_ratio="DebtRatio", income="MonthlyIncome",
    open_lines="NumberOfOpenCreditLinesAndLoans", late_90="NumberOfTimes90DaysLate",
    real_estate="NumberRealEstateLoansOrLines", late_60_89="NumberOfTime60-89DaysPastDueNotWorse",
    dependents="NumberOfDependents")
HEADER = ",".join([GMSC.id, GMSC.target, *GMSC.features])
ROWS = ["1,0,0.15,45,0,0.32,5000,8,0,1,0,2", "2,1,0.91,38,1,0.67,3200,5,1,0,0,1"]


def write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return str(path)


def test_train_contract_passes(spark, tmp_path):
    p = write(tmp_path / "train.csv", [HEADER, *ROWS])
    contract = CT.contracts_for(GMSC)["train"]
    df = S.load_validated(spark, p, contract, GMSC)
    assert df.count() == 2
    assert dict(df.dtypes)["age"] == "bigint" and dict(df.dtypes)["MonthlyIncome"] == "double"
    rep = V.validation_messages(df, contract, GMSC).collect()
    assert [r for r in rep if r.severity == "error"] == []
    counts = {r.value: r["count"] for r in V.target_summary(df, GMSC.target).collect()}
    assert counts == {0: 1, 1: 1}


def test_test_file_with_target_is_error(spark, tmp_path):
    p = write(tmp_path / "test.csv", [HEADER, "3,1,0.40,41,0,0.25,6100,7,0,1,0,0"])
    contract = CT.contracts_for(GMSC)["test"]
    with pytest.raises(ValueError, match="should be unlabeled"):
        S.load_validated(spark, p, contract, GMSC)


def test_duplicate_header_and_empty(spark, tmp_path):
    with pytest.raises(ValueError, match="Duplicate"):
        S.read_text_csv(spark, write(tmp_path / "dup.csv", ["a,a", "1,2"]))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(ValueError, match="empty"):
        S.read_text_csv(spark, str(empty))


@pytest.mark.parametrize("column, value, message", [
    (GMSC.target, "0.5", "outside"), (GMSC.target, "abc", "outside"), ("age", "30.9", "'age' holds values"),
    ("MonthlyIncome", "Infinity", "'MonthlyIncome' holds values"), ("DebtRatio", "1d", "'DebtRatio' holds values")])
def test_values_that_are_not_of_the_type_are_errors(spark, tmp_path, column, value, message):
    row = ROWS[0].split(",")
    row[HEADER.split(",").index(column)] = value
    p = write(tmp_path / "train.csv", [HEADER, ",".join(row), ROWS[1]])
    with pytest.raises(ValueError, match=message):
        S.load_validated(spark, p, CT.contracts_for(GMSC)["train"], GMSC)


def test_missing_texts_and_whole_numbers(spark, tmp_path):
    p = write(tmp_path / "train.csv", [HEADER, "9007199254740993,0,NA,45.0,3e1,nan,,8,0,1,0,null", ROWS[1]])
    r = S.load_validated(spark, p, CT.contracts_for(GMSC)["train"], GMSC).orderBy(F.desc(GMSC.id)).first()
    assert (r[GMSC.id], r.age, r[GMSC.late_30_59]) == (9007199254740993, 45, 30)
    assert r[GMSC.utilization] is None and r.MonthlyIncome is None and r.NumberOfDependents is None


def test_header_by_quoting_rules_and_another_order(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", ['"a, b",c', "1,2"])
    assert S.read_text_csv(spark, str(folder)).columns == ["a, b", "c"]
    write(folder / "b.csv", ['c,"a, b"', "3,4"])
    with pytest.raises(Exception, match="(?i)header"):
        S.read_text_csv(spark, str(folder)).collect()


def test_unreadable_table_gives_a_row(spark):
    """An error where the source must exist, a warning where not."""
    for name, severity in (("train", "error"), ("sample_submission", "warning")):
        rows = V.table_messages(spark, "no_such_table", CT.contracts_for(GMSC)[name], GMSC).collect()
        assert [(r.dataset, r.severity, r.rule) for r in rows] == [(name, severity, "source_unreadable")]


def test_column_status():
    contract = CT.contracts_for(GMSC)["test"]
    status = dict(CT.column_status([GMSC.id, "age", "age", "other"], contract))
    assert (status[GMSC.id], status["age"], status["other"]) == ("expected", "repeated", "unexpected")
    assert (status[GMSC.target], status["DebtRatio"]) == ("absent", "missing")


def test_optional_source_absent(spark, tmp_path):
    assert S.load_optional(spark, str(tmp_path / "missing.csv")) is None


def test_json_sidecar_roundtrip(spark, tmp_path):
    payload = {"raw_feature_columns": list(GMSC.features), "clipping_rules": {"age": {"lower": 18.0, "upper": 100.0}}}
    S.write_json_document(spark, payload, str(tmp_path / "feature_schema"))
    assert S.read_json_document(spark, str(tmp_path / "feature_schema")) == payload


def test_lineage_columns(spark, tmp_path):
    p = write(tmp_path / "train.csv", [HEADER, *ROWS])
    df = S.with_lineage(S.read_text_csv(spark, p))
    r = df.first()
    assert r.source_file_name == "train.csv" and r.row_fingerprint is not None


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    feats = ",".join(GMSC.features)
    write(folder / "part1.csv", [f"id,{feats}", "1,0.45,42,0,0.32,6500,8,0,1,0,2", "2,0.80,17,3,0.52,6500,8,1,1,0,2",
                                 "3,0.80,60,3,0.52,,8,1,1,0,"])
    stream = ST.read_uploads(spark, str(folder), ["id", *GMSC.features])
    good, bad = ST.score_stream(stream, GMSC, lambda d: F.lit(0.3), 0.2, 0.14, "src")
    q1 = ST.start(good, str(tmp_path / "out"), str(tmp_path / "ck1"), trigger_once=True)
    q2 = ST.start(bad, str(tmp_path / "bad"), str(tmp_path / "ck2"), trigger_once=True)
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == ["1", "3"]
    assert [r.message for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["Field 'age' must be at least 18."]
    batch = B.normalize_batch(spark.read.option("header", True).schema(ST.text_schema(["id", *GMSC.features]))
                              .csv(str(folder)), GMSC)
    assert batch.where("row_error IS NULL").count() == 2


def test_table_source_contract(spark, tmp_path):
    """A catalog table goes through the same contract gate."""
    p = write(tmp_path / "train.csv", [HEADER, *ROWS])
    S.typed(S.read_text_csv(spark, p), GMSC).createOrReplaceTempView("raw_train")
    df = S.load_validated(spark, "raw_train", CT.contracts_for(GMSC)["train"], GMSC, fmt="table")
    assert df.count() == 2
    with pytest.raises(ValueError, match="Unsupported source format"):
        S.load_validated(spark, p, CT.contracts_for(GMSC)["train"], GMSC, fmt="xml")


def test_learning_curve_and_importance(spark):
    """M7 + M8 on a tiny boosted model."""
    from riskloom.operators import models as M
    from riskloom.operators.features import preprocessing
    rows = [(i, int(i % 3 == 0), 0.1 + 0.02 * i, 30.0 + i, float(i % 4), 0.2, 3000.0 + 10 * i, 5.0, float(i % 3 == 0),
             1.0, 0.0, 1.0) for i in range(60)]
    schema = ", ".join([f"`{GMSC.id}` long", f"`{GMSC.target}` int"] + [f"`{c}` double" for c in GMSC.features])
    df = spark.createDataFrame(rows, schema)
    est = M.BoostingParams(n_estimators=5, max_depth=2).estimator("features", GMSC.target)
    model = M.fit(preprocessing(GMSC), est, df)
    curve = M.learning_curve(model, df)
    assert len(curve) == 5 and curve[-1] <= curve[0]
    imp = {r.feature: r for r in M.tree_importance(model, list(GMSC.features) + ["a", "b"]).collect()}
    assert imp[GMSC.late_90].weight > 0
    with pytest.raises(ValueError, match="no Spark equivalent"):
        M.BoostingParams(extra={"reg_alpha": 1.0}).estimator("f", "y")
