"""Metric operators against literal expectations (reference unit-test values) and brute force."""
import random

import numpy as np
import pytest

from riskloom.functions import cumulative as CU
from riskloom.operators import metrics as K


def _df(spark, ys, ss):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(ys, ss)], "y int, s double")


def test_bundle_literals(spark):
    r = K.binary_metrics(_df(spark, [0, 0, 1, 1, 0, 1], [.1, .3, .8, .9, .4, .7]), "y", "s", 0.5).first()
    assert r.average_precision == pytest.approx(1.0)
    assert r.roc_auc == pytest.approx(1.0)
    assert r.ks_statistic == pytest.approx(1.0)
    assert r.brier_score == pytest.approx(0.0666667, abs=1e-6)
    assert (r.tn, r.fp, r.fn, r.tp) == (3, 0, 0, 3)


def test_threshold_confusion(spark):
    r = K.binary_metrics(_df(spark, [0, 1, 1, 0], [.40, .55, .60, .45]), "y", "s", 0.6).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (2, 0, 1, 1)
    assert r.precision == 1.0 and r.recall == 0.5


def test_average_precision_not_trapezoid(spark):
    r = K.binary_metrics(_df(spark, [0, 0, 1, 1], [.1, .4, .35, .8]), "y", "s").first()
    assert r.average_precision == pytest.approx(0.8333333, abs=1e-6)
    assert r.roc_auc == pytest.approx(0.75)


def test_pr_curve_points(spark):
    pts = K.precision_recall_curve(_df(spark, [0, 0, 1, 1], [.1, .2, .8, .9]), "y", "s").collect()
    assert len(pts) == 5
    first = [p for p in pts if p.threshold == 0.1][0]
    assert first.precision == 0.5 and first.recall == 1.0
    assert any(p.threshold is None and p.precision == 1.0 and p.recall == 0.0 for p in pts)


def test_roc_drops_collinear(spark):
    pts = K.roc_curve(_df(spark, [0, 0, 1, 1], [.1, .2, .8, .9]), "y", "s").collect()
    assert sorted(p.threshold for p in pts) == [0.1, 0.8, 0.9, float("inf")]


def test_one_class_raises(spark):
    with pytest.raises(Exception, match="both negative and positive"):
        K.binary_metrics(_df(spark, [0, 0, 0], [.1, .2, .3]), "y", "s").collect()


def test_out_of_range_raises(spark):
    with pytest.raises(Exception, match="bounded within"):
        K.binary_metrics(_df(spark, [0, 1, 0], [.1, 1.2, .3]), "y", "s").collect()


def test_threshold_param_checked():
    with pytest.raises(ValueError):
        K.check_threshold(1.5)


def _brute(ys, ss):
    ys, ss = np.array(ys), np.array(ss)
    P, N = ys.sum(), (1 - ys).sum()
    auc = 0.0
    for s_pos in ss[ys == 1]:
        auc += (ss[ys == 0] < s_pos).sum() + 0.5 * (ss[ys == 0] == s_pos).sum()
    auc /= P * N
    ap = 0.0
    for t in np.unique(ss):
        sel = ss >= t
        ap += ((ys == 1) & (ss == t)).sum() / P * (ys[sel].sum() / sel.sum())
    ks = max(abs(ys[ss >= t].sum() / P - (1 - ys[ss >= t]).sum() / N) for t in np.unique(ss))
    return auc, ap, ks


def test_ties_and_bucketed_path_equal_brute_force(spark, monkeypatch):
    random.seed(7)
    ys = [random.randint(0, 1) for _ in range(3000)]
    ss = [round(random.random() * 0.5 + 0.3 * y, 2) for y in ys]  # heavy ties
    auc, ap, ks = _brute(ys, ss)
    df = _df(spark, ys, ss)
    for rows_per_bucket in (CU.ROWS_PER_BUCKET, 7):
        orig = CU.running_totals

        def small(*a, **k):
            k["rows_per_bucket"] = rows_per_bucket
            return orig(*a, **k)
        monkeypatch.setattr(K, "running_totals", small)
        r = K.binary_metrics(df, "y", "s").first()
        assert r.roc_auc == pytest.approx(auc, abs=1e-12)
        assert r.average_precision == pytest.approx(ap, abs=1e-12)
        assert r.ks_statistic == pytest.approx(ks, abs=1e-12)


def test_exact_quantiles_match_numpy(spark):
    random.seed(3)
    vals = [random.choice([1.0, 2.0, 2.0, 3.5]) * random.randint(1, 50) for _ in range(999)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "v double, g int")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.q_index): r.quantile for r in CU.exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in range(3):
        sub = [v for i, v in enumerate(vals) if i % 3 == g]
        for i, p in enumerate(probs):
            assert got[(g, i)] == pytest.approx(float(np.quantile(sub, p)), rel=1e-12)
    got2 = {(r.g, r.q_index): r.quantile for r in CU.exact_quantiles(df, "v", probs, ["g"], rows_per_bucket=5).collect()}
    assert got2 == pytest.approx(got)


def test_weighted_equals_duplicated(spark):
    rows = [(0, .1, 2.0), (1, .4, 1.0), (0, .4, 3.0), (1, .8, 2.0), (0, .9, 1.0), (1, .95, 1.0)]
    w = spark.createDataFrame(rows, "y int, s double, w double")
    dup = spark.createDataFrame([(y, s) for y, s, k in rows for _ in range(int(k))], "y int, s double")
    a = K.binary_metrics(w, "y", "s", 0.5, weight="w").first()
    b = K.binary_metrics(dup, "y", "s", 0.5).first()
    for m in ("average_precision", "roc_auc", "ks_statistic", "brier_score", "precision", "recall", "f1"):
        assert a[m] == pytest.approx(b[m], abs=1e-12), m


def test_row_level_ks_depends_on_tie_order(spark):
    df = spark.createDataFrame([(1, 0, .5), (2, 1, .5), (3, 1, .5), (4, 0, .2)], "k int, y int, s double")
    r = K.ks_row_level(df, "y", "s", "k").first()
    # order within the tie: k=1 (neg), 2 (pos), 3 (pos): max |tpr - fpr| = 0.5 after row 3
    assert r.ks_statistic_row_level == pytest.approx(0.5)
    g = K.binary_metrics(df, "y", "s").first()
    assert g.ks_statistic == pytest.approx(0.5)
