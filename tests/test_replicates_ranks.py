"""Bootstrap by weight arrays, Spearman ranks and clusters against plain versions."""
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics as K
from riskloom.operators import monitoring as D


@pytest.mark.parametrize("weights_per_task", [D.BOOTSTRAP_WEIGHTS, 200])
def test_replicates_equal_weighted_metrics_of_copied_rows(spark, weights_per_task):
    random.seed(3)
    rows = [(i, int(random.random() < 0.4), round(random.random(), 2)) for i in range(160)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    copies = df.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(11))))
    copies = copies.withColumn("w", D.poisson_weight(9, F.col("replicate"), F.col("k"))).where("w > 0")
    want = {r.replicate: r.asDict() for r in K.binary_metrics(copies, "y", "s", 0.5, ["replicate"], weight="w").collect()}
    got = {r.replicate: r.asDict() for r in D.bootstrap_replicates(df, "y", "s", "k", 12, 9, 0.5, weights_per_task).collect()}
    assert set(got) == set(want) == set(range(12))
    for r in want:
        assert {c: pytest.approx(v, abs=1e-12) for c, v in want[r].items()} == got[r]


@pytest.mark.parametrize("row, message", [((1, None, 0.5), K.MSG_Y_MISSING), ((1, 2, 0.5), K.MSG_Y_BINARY), ((1, 1, None), K.MSG_S_MISSING),
                                          ((1, 1, 1.5), K.MSG_S_RANGE)])
def test_bad_rows_are_errors(spark, row, message):
    df = spark.createDataFrame([(0, 0, 0.1), row], "k long, y int, s double")
    with pytest.raises(Exception, match=message.split(".")[0].replace("[", r"\[")):
        D.bootstrap_replicates(df, "y", "s", "k", 3).collect()


def test_ranks_of_a_column_of_two_values_and_of_rare_values(spark):
    random.seed(8)
    n = 1500
    rows = [(i, float(i % 3 == 0), random.random(), None if i % 7 == 0 else (0.0 if i % 2 else random.random()), math.nan if i % 5 == 0 else 1.0 * i)
            for i in range(n)]
    df = spark.createDataFrame(rows, "k long, two double, rare double, mixed double, late double")
    names = ["two", "rare", "mixed", "late"]
    got = D.spearman_ranks(df, "k", names).toPandas().sort_values("k").reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["k", *names])[names].rank(method="average")
    pd.testing.assert_frame_equal(got[names].astype(float), want.astype(float))


def test_ranks_keep_rows_of_equal_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (5, 2.0), (5, None)], "k long, v double")
    got = sorted(((r.k, r.v) for r in D.spearman_ranks(df, "k", ["v"]).collect()), key=str)
    assert got == sorted([(None, 1.0), (None, 2.5), (5, 2.5), (5, None)], key=str)


def test_clusters_of_columns(spark):
    chain = [(f"c{i}", f"c{i + 1}", 0.9 if i % 2 else -0.8) for i in range(9)]  # ten columns in a row
    pairs = spark.createDataFrame(chain + [("x", "y", 0.69), ("y", "z", None), ("z", "w", 0.7)], "column_a string, column_b string, rho double")
    names = [f"c{i}" for i in range(10)] + ["w", "x", "y", "z"]
    got = {r["column"]: (r.cluster, r.cluster_size) for r in D.correlation_clusters(pairs, "rho", names, 0.7).collect()}
    assert got == {**{f"c{i}": ("c0", 10) for i in range(10)}, "w": ("w", 2), "z": ("w", 2), "x": ("x", 1), "y": ("y", 1)}


def test_correlation_of_a_column_of_one_value_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0), (None, 9.0, 5.0)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.pearson for r in D.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("b", "c")] is None
    assert got[("a", "b")] == pytest.approx(pd.Series([1.0, 2, 3]).corr(pd.Series([2.0, 4.5, 5])))


def test_clusters_make_their_pairs_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [("a", "b", 0.9), ("c", "d", 0.8)]
    pairs = spark.createDataFrame(rows, "column_a string, column_b string, rho double").mapInArrow(counted, "column_a string, column_b string, rho double")
    got = {r["column"]: r.cluster for r in D.correlation_clusters(pairs, "rho", ["a", "b", "c", "d"]).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}
    assert made.value == len(rows)


def test_correlations_are_those_of_all_rows_whatever_their_batches(spark):
    random.seed(5)
    rows = [(random.gauss(1e6, 1), None if i % 3 == 0 else random.random(), 0.1 if i % 2 else None, math.nan if i == 7 else 1.0 * i, 0.3 if i < 9 else None)
            for i in range(500)]
    names = ["a", "b", "one", "nan", "few"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.column_a, r.column_b): r.pearson for r in D.correlation_matrix(df.repartition(3), names).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    table = pd.DataFrame(rows, columns=names)
    assert got[("a", "b")] == pytest.approx(table["a"].corr(table["b"]), abs=1e-9)
    assert [got[p] for p in [("a", "one"), ("b", "one"), ("one", "few"), ("b", "few")]] == [None] * 4
    assert math.isnan(got[("a", "nan")]) and len(got) == 10
    assert {r.pearson for r in D.correlation_matrix(df.where("a is null"), names).collect()} == {None}
