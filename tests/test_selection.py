"""Candidate chain (M9, M12) and calibration by refit (C4)."""
import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import models as M
from riskloom.operators import selection as SEL
from riskloom.plans import registry as R

SF = "/root/testdata/sf0.001"
C = R.C


@pytest.fixture(scope="module")
def parts(spark):
    df = R.split_cases(spark, SF).persist()
    return {p: df.where(F.col("split") == p) for p in ("train", "validation", "test")} | {"all": df}


def plain_fold(rows, maximize):
    """Stage by stage: replaced only if strictly better; nothing known never wins."""
    out, best, name = [], None, None
    for _, source, metric in rows:
        good = metric is not None and not math.isnan(metric)
        better = good and (best is None or (metric > best if maximize else metric < best))
        if better:
            best, name = metric, source
        out.append((source, name, better))
    return out


@pytest.mark.parametrize("maximize", [True, False])
def test_incumbents_equal_the_fold(spark, maximize):
    rng = random.Random(3)
    for _ in range(6):
        rows = [(i, f"s{i}", rng.choice([None, float("nan"), 0.1, 0.2, 0.3, -0.1])) for i in range(7)]
        df = spark.createDataFrame(rng.sample(rows, len(rows)), "stage int, source string, metric double")
        got = SEL.with_incumbents(df, "metric", maximize).orderBy("stage").collect()
        assert [(r.source, r.incumbent, r.replaced) for r in got] == plain_fold(rows, maximize)


def test_chain_of_boosted_candidates(spark, parts):
    base = M.BoostingParams(n_estimators=12, early_stopping_rounds=3, max_depth=2)
    learner = SEL.boosting_learner(R.preprocessing(C, output_col="features"), base)
    chain = SEL.candidate_chain(spark, parts["train"], parts["validation"], learner, C.id, C.target, R.FEATURES,
                                {"max_depth": [1, 3], "reg_alpha_": [0]}, 1)
    rows = chain.ledger.orderBy("stage").collect()
    assert [r.source for r in rows] == [SEL.REFERENCE, SEL.WEIGHTED, SEL.OVERSAMPLED]  # the search's only draw fails: an unknown setting
    failed = chain.search.collect()
    assert len(failed) == 1 and failed[0].error and failed[0].metric is None
    train = parts["train"]
    n, rate = train.count(), train.agg(F.avg((F.col(C.target) == 1).cast("double"))).first()[0]
    assert rows[0].row_count == rows[1].row_count == n and abs(rows[0].positive_rate - rate) < 1e-12
    assert rows[2].train_variant == "smote" and rows[2].row_count > n and abs(rows[2].positive_rate - 0.5) < 1e-12
    assert all(r.eval_row_count == parts["validation"].count() and 0 <= r.best_iteration < 12 and r.best_score > 0 for r in rows)
    assert [(r.source, r.incumbent, r.replaced) for r in rows] == plain_fold([(r.stage, r.source, r.metric) for r in rows], True)
    assert chain.winner.recipe.source == rows[-1].incumbent
    assert chain.winner.model.stages[-1].getNumTrees == chain.winner.summary["best_iteration"] + 1


def test_a_failed_candidate_is_a_row(spark, parts):
    def estimator(params, features, target, weight, rows):
        if params.get("scale_pos_weight") or not params:
            raise ValueError("no such weight")
        return M.logistic(features, target, n_weight=float(rows), C=params["C"], max_iter=20, weight_col=weight)

    learner = SEL.Learner(estimator, R.preprocessing(C, output_col="features"))
    chain = SEL.candidate_chain(spark, parts["train"], parts["validation"], learner, C.id, C.target, R.FEATURES, {"C": [0.1, 1.0]}, 2)
    rows = chain.ledger.orderBy("stage").collect()
    assert [bool(r.error) for r in rows] == [True, True, True, False] and [r.incumbent for r in rows] == [None] * 3 + [SEL.TUNED]
    assert chain.search.count() == 2 and chain.winner.recipe.params["C"] in (0.1, 1.0)
    with pytest.raises(ValueError, match=SEL.MSG_NO_CANDIDATE):
        SEL.candidate_chain(spark, parts["train"], parts["validation"], learner, C.id, C.target, R.FEATURES)


def test_candidates_are_made_side_by_side_and_folded_in_order(spark):
    """The weighted and the tuned candidate wait for each other: one after another they would never meet."""
    import threading
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    meet = [threading.Barrier(2, timeout=60)]

    def estimator(params, features, target, weight, rows):
        if params and meet:
            meet[0].wait()
        return M.logistic(features, target, n_weight=float(rows), C=params.get("C", 1.0), max_iter=20, weight_col=weight)

    df = spark.range(90).selectExpr("id", "cast(id % 5 = 0 as int) as y", "cast(id % 7 + id % 5 as double) as x", "cast(id % 11 as double) as z")
    learner = SEL.Learner(estimator, Pipeline(stages=[VectorAssembler(inputCols=["x", "z"], outputCol="features")]))
    chain = SEL.candidate_chain(spark, df.where("id < 60"), df.where("id >= 60"), learner, "id", "y", ["x", "z"], {"C": [0.1]}, 1)
    rows = chain.ledger.orderBy("stage").collect()
    assert [(r.source, r.error) for r in rows] == [(s, None) for s in (SEL.REFERENCE, SEL.WEIGHTED, SEL.OVERSAMPLED, SEL.TUNED)]
    assert rows[0].row_count == 60 and rows[2].positive_rate == 0.5
    meet.clear()
    one = SEL.candidate_chain(spark, df.where("id < 60"), df.where("id >= 60"), learner, "id", "y", ["x", "z"], {"C": [0.1]}, 1, side_by_side=1)
    assert [(r.source, r.params, round(r.metric, 6), r.incumbent) for r in rows] == [
        (r.source, r.params, round(r.metric, 6), r.incumbent) for r in one.ledger.orderBy("stage").collect()]


def test_calibration_refit_never_fits_the_holdout(spark, parts):
    learner = SEL.logistic_learner(R.preprocessing(C, output_col="features"), max_iter=30)
    done = SEL.calibrate_by_refit(parts["train"], parts["all"].where(F.col("split") != "train"), parts["validation"],
                                  SEL.Recipe(2, SEL.OVERSAMPLED, oversample=True), learner, C.id, C.target, R.FEATURES)
    held = done.scores.where(F.col("split") == SEL.HOLDOUT)
    train = {r[0]: r[1] for r in parts["train"].select(C.id, C.target).collect()}
    out = {r[C.id]: r[C.target] for r in held.select(C.id, C.target).collect()}
    fitted = {r[0] for r in done.fit_rows.select(C.id).collect()}
    assert out.items() <= train.items() and not fitted & set(out)
    assert {i for i in fitted if i >= 0} == set(train) - set(out)  # synthetic rows have negative ids
    assert len(out) == math.ceil(0.2 * len(train)) and abs(sum(out.values()) / len(out) - sum(train.values()) / len(train)) < 0.01
    assert done.model.summary["positive_rate"] == 0.5
    report = SEL.refit_report(done, C.target).collect()
    assert {(r.split, r.kind) for r in report} == {(p, k) for p in (SEL.HOLDOUT, "validation", "test") for k in ("raw", "calibrated")}
    brier = {(r.split, r.kind): r.brier_score for r in report}
    assert brier[SEL.HOLDOUT, "calibrated"] < brier[SEL.HOLDOUT, "raw"]
    grid = spark.createDataFrame([(x / 10,) for x in range(11)], "threshold double")
    mapped = [r.calibrated_threshold for r in SEL.calibrated_thresholds(done.calibrator, grid).orderBy("threshold").collect()]
    assert mapped == sorted(mapped) and all(0 <= x <= 1 for x in mapped)


def test_random_search_prepares_rows_once(spark, monkeypatch):
    """one fit of imputing and scaling for all candidates."""
    from riskloom.operators import features
    from riskloom.plans.registry import QUERIES
    calls = []
    real = features.exact_medians
    monkeypatch.setattr(features, "exact_medians", lambda df, cols: calls.append(1) or real(df, cols))
    rows = QUERIES["random_search_leaderboard"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 8 and all(r.error is None for r in rows) and len(calls) == 1
