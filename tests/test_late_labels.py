"""As-of join and late labels (D11) against a plain loop: late, missing, repeated and null labels, any bucket width."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import late_labels as LL

DAY = dt.datetime(2024, 1, 1)


def plain(left, right):
    out = []
    for i, k, t in left:
        best = [(rt, y) for rk, rt, y in right if rk == k and k is not None and t is not None and rt is not None and rt <= t]
        top = max(best, key=lambda x: (x[0], x[1] is not None, x[1] or 0)) if best else (None, None)
        out.append((i, *top))
    return sorted(out, key=str)


@pytest.mark.parametrize("seconds", [3600, 86_400 * 3, 86_400 * 4000])
def test_as_of_join_equals_plain_loop(spark, seconds):
    rng = random.Random(seconds)
    when = lambda: None if rng.random() < 0.05 else DAY + dt.timedelta(hours=rng.randint(-2000, 2000))
    name = lambda: rng.choice([None, "a", "a", "a", "a", *"bcdefgh"])  # noqa: E731 - one key holds a third of all rows
    left = [(i, name(), when()) for i in range(300)]
    right = [(name(), when(), rng.choice([None, 0, 1])) for _ in range(200)]
    right += right[:30] + [(k, t, 1) for k, t, _ in right[:10]]  # repeats, and equal times with another label
    left += [(1000 + i, k, t) for i, (k, t, _) in enumerate(right[:20])]  # equal times count
    got = LL.as_of_join(spark.createDataFrame(left, "id int, k string, t timestamp"),
                        spark.createDataFrame(right, "k string, at timestamp, y int"), "k", "t", "at", ["y"], seconds)
    assert got.columns == ["id", "k", "t", "at", "y"]
    assert sorted(((r.id, r["at"], r.y) for r in got.collect()), key=str) == plain(left, right)


def test_no_labels_at_all(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "id int, k string, t timestamp")
    none = spark.createDataFrame([], "k string, at timestamp, y int")
    assert [tuple(r) for r in LL.as_of_join(left, none, "k", "t", "at", ["y"]).collect()] == [(1, "a", DAY, None, None)]
    assert LL.as_of_join(left.where("id < 0"), none, "k", "t", "at", ["y"]).count() == 0


def test_a_hot_key_is_ordered_in_buckets(spark):
    left = spark.range(2000).select(F.lit("a").alias("k"), (F.lit(DAY).cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).alias("t"))
    plan = LL.as_of_join(left, left.select("k", F.col("t").alias("at"), F.lit(1).alias("y")), "k", "t", "at", ["y"])
    text = plan._jdf.queryExecution().toString()
    assert "windowspecdefinition(_k#" in text and plan.where("at = t").count() == 2000


def test_maturity_and_vintages(spark):
    at = lambda d: DAY + dt.timedelta(days=d)
    scores = spark.createDataFrame([(1, at(0), 0.2), (2, at(1), 0.8), (3, at(40), 0.5), (4, at(200), 0.5)], "id int, made timestamp, p double")
    labels = spark.createDataFrame([(1, at(5), 0), (1, at(20), 1), (2, at(50), 1), (9, at(1), 1)], "id int, arrived timestamp, y int")
    rows = LL.labels_by_maturity(scores, labels, "id", "made", "p", "arrived", "y", F.lit(at(60)).cast("timestamp"), [10, 45])
    got = sorted((r.id, r.window_days, r.matured, r.y) for r in rows.collect())
    assert got == [(1, 10, True, 0), (1, 45, True, 1), (2, 10, True, None), (2, 45, True, None), (3, 10, True, None), (3, 45, False, None)]
    report = {(r.vintage.month, r.window_days): r for r in LL.vintage_report(rows, "made", "p", "y").collect()}
    first = report[1, 45]
    assert (first.row_count, first.matured_count, first.labelled_count, first.unlabelled_share) == (2, 2, 1, 0.5)
    assert (first.positive_rate, first.mean_score) == (1.0, 0.2) and abs(first.brier_score - 0.64) < 1e-12 and abs(first.calibration_gap + 0.8) < 1e-12
    assert report[2, 10].positive_rate is None and report[2, 10].unlabelled_share == 1.0
