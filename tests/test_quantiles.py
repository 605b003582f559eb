"""Exact quantiles by bracketing sketches against numpy, and how little of the values they shuffle."""
import re

import numpy as np
import pytest

from riskloom.functions import cumulative as CU

PROBS = [0.0, 0.99, 0.01, 0.25, 0.5, 1.0]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out = [("a", float(v)) for v in rng.normal(size=3000)] + [("b", round(float(v), 2)) for v in rng.normal(size=700)]
    out += [(None, float(v)) for v in rng.normal(size=1200)] + [("tiny", float(v)) for v in range(7)]
    return out + [("a", 0.5)] * 1500 + [("none", None)] * 5  # a hot value, a group without values


@pytest.mark.parametrize("accuracy", [20, 50, 10_000])
def test_bracketed_quantiles_equal_numpy(spark, rows, accuracy):
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {(r.g, r.q_index): r["quantile"] for r in CU.exact_quantiles(df, "v", PROBS, ["g"], accuracy=accuracy).collect()}
    want = {(g, i): np.quantile([v for k, v in rows if k == g and v is not None], p) for g in ("a", "b", None, "tiny") for i, p in enumerate(PROBS)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_quantiles_without_groups_and_of_nothing(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    values = [v for _, v in rows if v is not None]
    got = {r.q_index: r["quantile"] for r in CU.exact_quantiles(df, "v", [0.9, 0.1], accuracy=30).collect()}
    assert all(abs(got[i] - np.quantile(values, p)) < 1e-9 for i, p in enumerate([0.9, 0.1]))
    assert CU.exact_quantiles(df.where("g = 'zz'"), "v", PROBS, ["g"]).count() == 0
    assert CU.exact_quantiles(df.where("v is null"), "v", PROBS).count() == 0


def test_shuffled_values_are_bounded_by_the_brackets(spark):
    n, accuracy = 40_000, 400
    df = spark.range(n).selectExpr("xxhash64(id) / 1e18 AS v")
    inside = CU._bracketed_values(df, "v", [0.25, 0.5, 0.75], [], accuracy)
    per_probe = {r["_i"]: r["count"] for r in inside.groupBy("_i").count().collect()}
    assert set(per_probe) == {0, 1, 2} and all(c <= 10 / accuracy * n for c in per_probe.values())


def test_a_missed_bracket_counts_all_values(spark, rows, monkeypatch):
    seen = []
    whole, bracketed = CU._counted_quantiles, CU._bracketed_values
    monkeypatch.setattr(CU, "_counted_quantiles", lambda *a: seen.append(1) or whole(*a))
    monkeypatch.setattr(CU, "_bracketed_values", lambda *a: bracketed(*a).where("_i < 3"))
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.q_index): r["quantile"] for r in CU.exact_quantiles(df, "v", PROBS, ["g"], accuracy=20).collect()}
    assert seen and abs(got["a", 4] - np.quantile([v for k, v in rows if k == "a"], 0.5)) < 1e-9


def test_brackets_are_searched_by_compiled_expressions(spark, rows):
    """Functions over arrays are interpreted for every cell; only the few rows behind the counts may use them."""
    df = spark.createDataFrame(rows, "g string, v double")
    inside = CU._bracketed_values(df, "v", [0.25, 0.5, 0.75], ["g"], 50)
    plan = inside._jdf.queryExecution().toString().splitlines()
    searches = [line for line in plan if "Generate explode" in line]
    assert searches and not any("lambda" in line for line in searches)


def test_overlapping_brackets_and_nan(spark):
    """Probes closer than their brackets are wide share values; NaN is the largest value, infinities are values."""
    values = [float(i % 97) for i in range(900)] + [float("inf")] * 30 + [float("-inf")] * 30
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.5, 0.501, 0.502, 0.03, 0.97, 0.0, 1.0]
    got = {r.q_index: r["quantile"] for r in CU.exact_quantiles(df, "v", probs, accuracy=40).collect()}
    ranked = sorted(values)
    for i in (0, 1, 2):
        assert abs(got[i] - np.quantile(ranked, probs[i])) < 1e-9
    assert got[5] == ranked[0] or np.isnan(got[5])
    more = df.union(spark.createDataFrame([(float("nan"),)] * 100, "v double"))
    top = {r.q_index: r["quantile"] for r in CU.exact_quantiles(more, "v", [0.5, 0.99], accuracy=40).collect()}
    assert np.isnan(top[1]) and abs(top[0] - (ranked + [np.nan] * 100)[530]) <= 1


def test_the_bracket_pass_fits_the_compiler(spark, rows, monkeypatch):
    """Java leaves methods of more than 8,000 bytes uncompiled, which made the pass over all cells some 40 times slower."""
    df = spark.createDataFrame(rows, "g string, v double")
    monkeypatch.setattr(type(df), "persist", lambda self: self)  # the plans of held tables aren't shown
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = CU._bracketed_values(df, "v", [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99], ["g"], 50)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) <= 8000
