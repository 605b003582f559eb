"""The bucketed way of running totals gives what the plain way gives: nulls, NaN, text keys, null groups, hot values."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions.cumulative import running_totals
from riskloom.operators import compare, metrics, models, monitoring, split


def rows_of(df, drop=("_bucket",)):
    return sorted(repr(tuple(r)) for r in df.drop(*drop).collect())  # as text, for NaN


@pytest.mark.parametrize("kind", ["double", "string"])
@pytest.mark.parametrize("descending", [False, True])
def test_same_rows_whatever_the_bucket_size(spark, kind, descending):
    rng = random.Random(2)
    values = [None, float("nan"), *[rng.randrange(400) / 8 for _ in range(60)]] if kind == "double" else [
        None, "", *[f"customer-{rng.randrange(5000)}" for _ in range(60)], "customer-é", "customer"]
    rows = [(g, v, i + 1) for g in ("a", "b", None) for i, v in enumerate(dict.fromkeys(values))]
    df = spark.createDataFrame(rows, f"g string, v {kind}, n long")
    plain = rows_of(running_totals(df, "v", ["n"], ["g"], descending))
    assert len(plain) == len(rows)
    assert rows_of(running_totals(df, "v", ["n"], ["g"], descending, rows_per_bucket=7)) == plain
    ranked = df.where("g = 'a'").drop("g")
    assert rows_of(running_totals(ranked, "v", ["n"], rows_per_bucket=3)) == rows_of(running_totals(ranked, "v", ["n"]))


def test_psi_keeps_groups_that_are_new(spark):
    base = spark.createDataFrame([("x", float(i)) for i in range(40)], "g string, v double")
    now = spark.createDataFrame([("x", float(i)) for i in range(0, 40, 2)] + [("new", 1.0)] * 3, "g string, v double")
    got = monitoring.psi(base, now, "v", 10, ["g"])
    fresh = got.where("g = 'new'").collect()
    assert [(r.bin, r.current_count, r.base_count, r.psi_term) for r in fresh] == [(None, 3, 0, None)]
    assert got.where("g = 'x'").agg(F.sum("current_count")).first()[0] == 20


def test_sampled_parameter_sets_are_distinct():
    space = {"a": [1, 2, 3], "b": ["x", "y"], "c": [0.1]}
    got = models.sample_parameter_sets(space, 99, 1)
    assert len(got) == 6 and len({tuple(g.items()) for g in got}) == 6
    assert models.sample_parameter_sets(space, 4, 1) == models.sample_parameter_sets(space, 4, 1)
    with pytest.raises(ValueError, match="'d'"):
        models.sample_parameter_sets({"d": []}, 1, 1)


def test_one_champion_of_two_designated_and_none_of_nothing(spark):
    columns = ("model_key string, designated_champion boolean, validation_average_precision double, test_average_precision double, "
               "test_roc_auc double, test_brier_score double, interactive_inference_supported boolean, "
               "batch_inference_supported boolean, f1_threshold double, cost_threshold double")
    rows = [(k, True, ap, ap, 0.8, 0.01, True, True, 0.5, 0.5) for k, ap in (("m1", 0.40), ("m2", 0.401))]
    flagged = compare.champion_flags(compare.rank_models(spark.createDataFrame(rows, columns)))
    assert [r.model_key for r in flagged.where("is_champion").collect()] == ["m2"]
    with pytest.raises(ValueError):
        compare.champion_flags(compare.rank_models(spark.createDataFrame([], columns)))


def test_gains_and_split_with_small_buckets_and_a_hot_score(spark, monkeypatch):
    """Nine tenths of the rows share a score; buckets of seven rows give what one window gives."""
    rows = [(i, i % 2, 0.5 if i % 10 else i / 300) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    config = split.SplitConfig(seed=3)
    plain = {r.k: r.split for r in split.assign_splits(df, "k", "y", config).collect()}
    small = functools.partial(running_totals, rows_per_bucket=7)
    monkeypatch.setattr(monitoring, "running_totals", small)
    monkeypatch.setattr(split, "running_totals", small)
    got = {r.decile: (r.rows, r.positives, r.min_score, r.max_score) for r in monitoring.gains_table(df, "y", "s", "k").collect()}
    parts = {d: order[d * 30:(d + 1) * 30] for d in range(10)}
    assert got == {d: (30, sum(r[1] for r in p), p[-1][2], p[0][2]) for d, p in parts.items()}
    assert {r.k: r.split for r in split.assign_splits(df, "k", "y", config, prefix_len=1).collect()} == plain


def test_a_group_without_a_threshold_is_an_error(spark):
    df = spark.createDataFrame([(g, y, s) for g in "ab" for y, s in ((0, 0.2), (1, 0.7))], "g string, y int, s double")
    limits = spark.createDataFrame([("a", 0.5)], "g string, threshold double")
    with pytest.raises(Exception, match="no threshold"):
        metrics.binary_metrics(df, "y", "s", limits, ["g"]).collect()


def test_permuted_rows_are_spread_over_tasks(spark):
    """ranking and permuting rows isn't one task's work."""
    from pyspark.sql import functions as F
    from riskloom.operators.importance import permuted_copies
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("a"))
    out = permuted_copies(df, "k", [["a"]], 2, 3)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == 8000 and len(per_task) >= 4 and max(per_task) < 4000


def test_values_meet_few_brackets_without_a_shuffle(spark):
    """A row a group is broadcast, whatever the planner knows of sizes."""
    from pyspark.sql import functions as F
    from riskloom.functions.cumulative import _bracketed_values, exact_quantiles
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _bracketed_values(df, "v", [0.25, 0.5], ["g"], 10)._jdf.queryExecution().sparkPlan().toString()
        got = {(r.g, r.q): r.quantile for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"], accuracy=10).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan
    assert got == {(g, p): g + 3 * 999 * p for g in range(3) for p in (0.25, 0.5)}


def test_batch_summary_scores_rows_once(spark):
    """the median's passes and the aggregate share the scored rows."""
    from pyspark.sql import functions as F
    from riskloom.operators.scoring import batch_summary
    scored = spark.range(100).select((F.col("id") / 100.0).alias("predicted_probability"), F.lit("High").alias("risk_band"),
                                     F.lit(1).alias("predicted_label_f1_threshold"), F.lit(1).alias("predicted_label_cost_threshold"),
                                     F.lit("s").alias("selected_candidate_source"), F.lit(0.5).alias("f1_threshold"),
                                     F.lit(0.4).alias("cost_threshold"))
    out = batch_summary(scored)
    assert "Range (0, 100" not in out._jdf.queryExecution().withCachedData().toString().split("InMemoryRelation")[0]
    row = out.first()
    assert row.uploaded_row_count == 100 and abs(row.median_predicted_probability - 0.495) < 1e-12
