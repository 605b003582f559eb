"""Registered queries do the operators' whole job: training budgets, early stopping, class balance."""
import inspect

import pytest
from pyspark.sql import functions as F

from riskloom.operators import imbalance as I
from riskloom.operators import importance as X
from riskloom.operators import models as M
from riskloom.operators import monitoring as D
from riskloom.plans import registry as R

SF = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


@pytest.mark.parametrize("kind, rounds", [("logistic", 1000), ("boosting", 600)])
def test_learner_queries_train_with_the_operators_defaults(spark, monkeypatch, kind, rounds):
    def fit(preprocessing, estimator, train):
        raise Seen(estimator.getMaxIter())

    monkeypatch.setattr(M, "fit", fit)
    with pytest.raises(Seen) as seen:
        R.trained_model(spark, SF, kind)
    assert seen.value.args == (rounds,)


def test_network_query_trains_balanced_with_the_default_budget(spark, monkeypatch):
    class Network:
        def __init__(self, *args, **given):
            assert "max_iter" not in given

        def fit(self, rows):
            raise Seen({r[R.C.target]: r["count"] for r in rows.groupBy(R.C.target).count().collect()})

    monkeypatch.setattr(M, "neural", Network)
    with pytest.raises(Seen) as seen:
        R.trained_model(spark, SF, "neural")
    counts = seen.value.args[0]
    assert abs(counts[1] / counts[0] - 1) < 0.1


@pytest.mark.parametrize("weight", [3.0, 2.5, 0.5])
def test_repeated_rows_keep_every_row(spark, weight):
    df = spark.range(4000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    out = I.with_repeated_rows(df, "y", weight, "id")
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert out.select("id").distinct().count() == 4000 and out.columns == df.columns
    assert abs(counts[1] / counts[0] / (weight / 3) - 1) < 0.05


def test_best_round_has_patience():
    assert M.best_round([3.0, 2.0, 2.5, 1.0, 1.5], 2) == 4
    assert M.best_round([3.0, 2.0, 2.5, 2.5, 1.0], 2) == 2
    assert M.best_round([1.0], 50) == 1


def test_rows_of_iterative_learners_are_dealt_evenly(spark):
    """The last two of 64 partitions hold all rows: merged as they lie, one task would hold them all."""
    df = spark.range(0, 6400, 1, 64).where("id >= 6200")
    cores = spark.sparkContext.defaultParallelism
    for wanted in (2, cores + 1):
        sized = M.sized_for_iterations(df, 200, -(-200 // wanted))
        sizes = [r["count"] for r in sized.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200 and len(sizes) == sized.rdd.getNumPartitions() <= wanted
        assert len(sizes) in (2, cores) and max(sizes) <= 2 * 200 / len(sizes)
    assert M.sized_for_iterations(df, 200).rdd.getNumPartitions() == 1
    assert M.sized_for_iterations(df, 200, 1).rdd.getNumPartitions() == 64  # large partitions stay as they are


def test_vectors_held_for_a_learner_carry_no_lineage(spark):
    held = M.held_for_iterations(spark.range(10).where("id > 3"))
    assert sorted(r.id for r in held.collect()) == list(range(4, 10)) and "Range" not in held._jdf.queryExecution().optimizedPlan().toString()
    held.unpersist()


def test_boosting_is_cut_at_the_best_validation_round(spark):
    """The validation labels contradict the training labels, so every round but the first makes it worse."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml import Pipeline
    df = spark.range(80).selectExpr("id", "cast(id % 2 as int) as y", "cast(id % 2 as double) as x", "1.0D as w")
    model = M.fit(Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="f")]),
                  M.BoostingParams(n_estimators=6, max_depth=2).estimator("f", "y", "w"), df)
    cut = M.stop_early(model, df.withColumn("y", 1 - F.col("y")), 2, "w")
    assert model.stages[-1].getNumTrees == 6 and cut.stages[-1].getNumTrees == 1
    assert M.predict_proba(cut, df).count() == 80
    assert M.stop_early(model, df, 2, "w").stages[-1].getNumTrees == 6


def test_content_fingerprints_cover_every_table_whatever_its_files(spark, tmp_path):
    from riskloom.sources.tables import TABLE_NAMES, read_table
    for name in TABLE_NAMES:
        read_table(spark, SF, name).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    query = R.QUERIES["content_fingerprints"]
    rows = {r.name: r for r in query(spark, SF).collect()}
    assert {n: r.row_count for n, r in rows.items()} == {n: read_table(spark, SF, n).count() for n in TABLE_NAMES}
    assert {r.name: r for r in query(spark, str(tmp_path)).collect()} == rows
    read_table(spark, SF, "nation").withColumn("n_name", F.upper(F.lit("x"))).write.mode("overwrite").parquet(f"{tmp_path}/nation.parquet")
    changed = {r.name: r for r in query(spark, str(tmp_path)).collect()}
    assert [n for n in TABLE_NAMES if changed[n] != rows[n]] == ["nation"]


@pytest.mark.parametrize("query, module, name, repeats, least", [
    ("top_importances", X, "permutation_importance", "repeats", 5),
    ("grouped_permutation_importance", X, "permutation_importance", "repeats", 5),
    ("bootstrap_intervals", D, "bootstrap_metrics", "replicates", 200),
    ("random_search_leaderboard", M, "random_search", "n_iter", 8)])
def test_queries_repeat_as_often_as_their_operators(spark, monkeypatch, query, module, name, repeats, least):
    signature = inspect.signature(getattr(module, name))

    def spy(*args, **given):
        bound = signature.bind(*args, **given)
        bound.apply_defaults()
        raise Seen(bound.arguments[repeats])

    monkeypatch.setattr(module, name, spy)
    with pytest.raises(Seen) as seen:
        R.QUERIES[query](spark, SF)
    assert seen.value.args[0] >= least


def test_the_network_is_given_its_own_columns_and_no_held_copies(spark, monkeypatch):
    class Spy:
        def fit(self, rows):
            raise Seen((rows.columns, rows.storageLevel.useMemory or rows.storageLevel.useDisk))

    monkeypatch.setattr(M, "neural", lambda *args, **given: Spy())
    with pytest.raises(Seen) as seen:
        R._fitted_model(spark, SF, "neural")
    assert seen.value.args[0] == (["features", R.C.target], False)
