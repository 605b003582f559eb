"""Split sizes, feature rules and class weights (reference literal cases)."""
import pytest
from pyspark.sql import functions as F

from riskloom.operators import split as P
from riskloom.operators.features import FeatureBuilder, feature_document, preprocessing
from riskloom.operators.imbalance import class_weight_summary
from riskloom.rules import CreditColumns

COLS = CreditColumns(id="id", target="y", utilization="util", age="age", late_30_59="l30", debt_ratio="debt",
                     income="income", open_lines="open", late_90="l90", real_estate="re", late_60_89="l60",
                     dependents="dep")
SCHEMA = ("id long, y int, util double, age double, l30 double, debt double, income double, open double, "
          "l90 double, re double, l60 double, dep double")


def rows40():
    out = []
    for i in range(40):
        out.append((i + 1, 1 if i % 5 == 0 else 0, 1.25 if i == 0 else 0.10 + 0.01 * i, 12.0 if i == 0 else 30.0 + i,
                    25.0 if i == 0 else float(i % 4), 6.5 if i == 0 else 0.20 + 0.03 * i,
                    None if i in (0, 7) else 3000.0 + 100 * i, float(3 + i % 7), 22.0 if i == 0 else float(i % 3),
                    float(i % 4), 24.0 if i == 0 else float(i % 2), None if i in (0, 9) else float(i % 3)))
    return out


def test_split_sizes_40(spark):
    df = spark.createDataFrame(rows40(), SCHEMA)
    out = P.assign_splits(df, "id", "y", P.SplitConfig())
    meta = {r.split: r for r in P.split_metadata(out, "y").collect()}
    assert (meta["train"].row_count, meta["validation"].row_count, meta["test"].row_count) == (28, 6, 6)
    assert meta["train"].positive_count == 6
    assert out.count() == 40 and out.select("id").distinct().count() == 40


def test_split_quotas_150k():
    q = P.split_quotas({1: 10026, 0: 139974}, P.SplitConfig())
    test = sum(v[0] for v in q.values())
    val = sum(v[1] for v in q.values())
    train = sum(v[2] for v in q.values())
    assert (train, val, test) == (105000, 22500, 22500)


def test_split_sizes_must_sum():
    with pytest.raises(ValueError):
        P.SplitConfig(0.7, 0.2, 0.2)


def test_split_independent_of_partitioning(spark):
    df = spark.createDataFrame(rows40(), SCHEMA)
    a = sorted(P.assign_splits(df.repartition(1), "id", "y").select("id", "split").collect())
    b = sorted(P.assign_splits(df.repartition(7), "id", "y").select("id", "split").collect())
    assert a == b


def test_feature_builder_clips_and_flags(spark):
    df = spark.createDataFrame(rows40(), SCHEMA)
    out = FeatureBuilder.for_columns(COLS).transform(df).where("id = 1").first()
    assert (out.age, out.util, out.debt, out.l30, out.l60, out.l90) == (18.0, 1.0, 5.0, 20.0, 20.0, 20.0)
    assert out.income_missing == 1 and out.dep_missing == 1 and out.income is None


def test_coercion_rejects_text(spark):
    df = spark.createDataFrame([("1", "x", " 2.5 ", "1d", "NaN", "inf")], "a string, b string, c string, d string, e string, f string")
    from riskloom.functions.columns import coerce_numeric
    r = df.select(*[coerce_numeric(F.col(c)).alias(c) for c in df.columns]).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (1.0, None, 2.5, None, None, None)


def test_preprocessing_fit_train_only(spark):
    df = spark.createDataFrame(rows40(), SCHEMA)
    model = preprocessing(COLS, output_col=None).fit(df)
    out = model.transform(df)
    stats = out.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
    assert stats.m == pytest.approx(0.0, abs=1e-9) and stats.s == pytest.approx(1.0, abs=1e-9)


def test_feature_schema():
    doc = feature_document(FeatureBuilder.for_columns(COLS), COLS)
    assert len(doc["raw_feature_columns"]) == 10 and len(doc["model_input_features"]) == 12
    assert doc["missing_indicator_features"] == ["income_missing", "dep_missing"]
    assert doc["clipping_rules"]["age"] == {"lower": 18.0, "upper": 100.0}


def test_ratio_weight(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (0,), (0,), (0,)], "y int")
    r = class_weight_summary(df, "y").first()
    assert r.scale_pos_weight == 2.0


def test_smote_points_on_segments(spark):
    import numpy as np
    from riskloom.operators.imbalance import exact_knn, smote
    rows = rows40() + [(100 + i, 1, 0.3 + 0.01 * i, 40.0 + i, 0.0, 0.4, 4000.0 + i, 5.0, 0.0, 1.0, 0.0, 1.0)
                       for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    feats = list(COLS.features)
    out, dist = smote(df, "id", "y", feats, k_neighbors=5, seed=1)
    d = {r.target: r for r in dist.collect()}
    assert d[1].count_after == d[0].count_after == 32
    syn = out.where("id < 0").collect()
    assert len(syn) == 32 - 14 and sorted(r.id for r in syn) == list(range(-18, 0))
    allrows = df.collect()
    med = {c: float(np.median([r[c] for r in allrows if r[c] is not None])) for c in feats}
    X = {r.id: np.array([r[c] if r[c] is not None else med[c] for c in feats]) for r in allrows if r.y == 1}
    for r in syn:
        s = np.array([r[c] for c in feats])
        found = False
        for a in X.values():
            for b in X.values():
                seg = b - a
                if not seg.any():
                    found = found or np.allclose(s, a)
                    continue
                u = float(np.dot(s - a, seg) / np.dot(seg, seg))
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(s, a + u * seg, atol=1e-6):
                    found = True
        assert found


def test_exact_knn_small(spark):
    from riskloom.operators.imbalance import exact_knn
    pts = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(50)], "k long, v array<double>")
    got = {(r.k, r.rank): r.nn_key for r in exact_knn(pts, "k", "v", 2, block_rows=7).collect()}
    assert {got[(10, 1)], got[(10, 2)]} == {9, 11}
    assert got[(0, 1)] == 1 and got[(0, 2)] == 2


def test_smote_hot_duplicate_group(spark):
    from riskloom.operators.imbalance import smote
    rows = [(i, 0, 0.1 * (i % 7), 30.0 + i, 0.0, 0.2, 3000.0, 5.0, 0.0, 1.0, 0.0, 1.0) for i in range(40)]
    rows += [(100 + i, 1, 0.5, 40.0, 1.0, 0.3, 2000.0, 4.0, 0.0, 1.0, 0.0, 2.0) for i in range(12)]  # one vector x12
    rows += [(200, 1, 0.9, 50.0, 2.0, 0.6, 1000.0, 3.0, 1.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out, dist = smote(df, "id", "y", list(COLS.features), k_neighbors=5, seed=3)
    d = {r.target: r.count_after for r in dist.collect()}
    assert d[1] == d[0] == 40
    # a base inside the duplicate group draws its 5 slots from its own 11 copies: synthetic = the point itself
    syn = [r for r in out.where("id < 0").collect()]
    assert len(syn) == 27
    for r in syn:
        assert 0.5 <= r.util <= 0.9 and 40.0 <= r.age <= 50.0


def test_exact_knn_is_brute_force(spark):
    """Ties by key, a key twice, a null key and a NaN component; every cell size gives the same rows."""
    import numpy as np
    from riskloom.operators.imbalance import exact_knn
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(0, 6, 3)]) for i in range(300)] + [(7, [0.5, 9.0, 1.0]), (400, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    pts = spark.createDataFrame(rows, "k long, v array<double>")
    ends = {}
    for k, v in rows[:-1]:
        for o, w in rows[:-1]:
            if o != k:
                d = sum((a - b) ** 2 for a, b in zip(v, w))
                ends.setdefault(k, []).append((d != d, d if d == d else 0.0, o))
    expected = {k: [o for _, _, o in sorted(v)[:4]] for k, v in ends.items()}
    for size in (20, 1000):
        got = {}
        for r in exact_knn(pts, "k", "v", 4, block_rows=size).orderBy("k", "rank").collect():
            got.setdefault(r.k, []).append(r.nn_key)
        assert got == expected


def test_smote_plan_stays_short(spark):
    """the plan no longer holds a copy of the input's plan for every step of the search."""
    from riskloom.operators.imbalance import smote
    rows = [(i, int(i % 4 == 0), 0.37 * (i % 71), 20.0 + i % 83, float(i % 3), 0.2, 1.5 * i, 5.0, 0.0, 1.0, 0.0, 1.0) for i in range(10_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for i in range(100):
        df = df.where(f"id > -{i + 1}")
    out, _ = smote(df, "id", "y", list(COLS.features), seed=2)
    assert len(out._jdf.queryExecution().logical().toString()) < 50_000
    assert out.where("id < 0").count() == 5_000


def test_neighbours_of_many_queries_are_found_at_once():
    """A task works on arrays of queries; ties, repeated vectors, NaN and infinities against a plain search."""
    import numpy as np

    from riskloom.operators.imbalance import _cell_search

    rng = np.random.default_rng(3)
    for n, k in ((120, 5), (9, 4), (3, 5), (1, 2)):
        rows = rng.integers(0, 4, (n, 3)).astype(float)
        rows[rng.random(rows.shape) < 0.05] = np.nan
        rows[rng.random(rows.shape) < 0.02] = np.inf
        keys, got = np.arange(n), {}
        blocks = list(_cell_search()[1](rows, keys, rows, keys, k))
        assert len(blocks) == 1  # fails where each query comes by itself
        for i, at, d2 in blocks:
            for a, b, c in zip(i, at, d2):
                got.setdefault(int(a), []).append((int(b), float(c)))
        for i in range(n):
            with np.errstate(invalid="ignore"):
                far = sum((rows[i, j] - rows[:, j]) ** 2 for j in range(3))
            want = sorted((p for p in range(n) if p != i), key=lambda p: (np.isnan(far[p]), 0 if np.isnan(far[p]) else far[p], p))[:k]
            assert [p for p, _ in got.get(i, [])] == want
            assert np.array_equal([c for _, c in got.get(i, [])], far[want], equal_nan=True)
