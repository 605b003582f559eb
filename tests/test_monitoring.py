"""Second-wave operators against brute force on small fixtures."""
import math
import random

import numpy as np
import pytest

from riskloom.operators import monitoring as D


def test_gains_table_brute_force(spark):
    random.seed(11)
    rows = [(i, random.randint(0, 1), round(random.random(), 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    got = {r.decile: r for r in D.gains_table(df, "y", "s", "k", 10).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    P = sum(r[1] for r in rows)
    cum = 0
    for d in range(10):
        part = order[d * 20:(d + 1) * 20]
        cum += sum(r[1] for r in part)
        assert got[d].rows == 20 and got[d].positives == sum(r[1] for r in part)
        assert got[d].cumulative_gain == pytest.approx(cum / P)


def test_psi_brute_force(spark):
    random.seed(5)
    base = [random.gauss(0, 1) for _ in range(500)]
    cur = [random.gauss(0.3, 1.2) for _ in range(400)]
    b = spark.createDataFrame([(v,) for v in base], "x double")
    c = spark.createDataFrame([(v,) for v in cur], "x double")
    got = sum(r.psi_term for r in D.psi(b, c, "x", 10).collect())
    cuts = np.quantile(base, [i / 10 for i in range(1, 10)])
    def shares(vals):
        bins = [sum(v > ct for ct in cuts) for v in vals]
        return [max(bins.count(i) / len(vals), 1e-6) for i in range(10)]
    sb, sc = shares(base), shares(cur)
    want = sum((a - e) * math.log(a / e) for a, e in zip(sc, sb))
    assert got == pytest.approx(want, rel=1e-9)


def test_bootstrap_repeatable_and_brackets_point(spark):
    random.seed(2)
    rows = [(i, int(random.random() < 0.3 + 0.4 * (i % 2)), round(0.2 + 0.5 * (i % 2) + 0.2 * random.random(), 3))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k long, y int, s double")
    a = {r.metric: (r.lower, r.upper) for r in D.bootstrap_metrics(df, "y", "s", "k", replicates=30, seed=9).collect()}
    b = {r.metric: (r.lower, r.upper) for r in D.bootstrap_metrics(df, "y", "s", "k", replicates=30, seed=9).collect()}
    assert a == b
    assert all(lo <= hi for lo, hi in a.values())


def test_band_expression(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.01,), (0.07,), (0.5,)], "p double")
    bands = [("low", None, 0.05), ("mid", 0.05, 0.2), ("high", 0.2, None)]
    got = [r.b for r in df.select(D.band_expression(F.col("p"), bands).alias("b")).orderBy("p").collect()]
    assert got == ["low", "mid", "high"]
