"""Rank permutations and permutation importance against plain Python."""
import collections

import pytest
from pyspark.sql import functions as F

from riskloom.functions import permute
from riskloom.operators import importance as X


def plain_image(x, n, seed, stream):
    a, b = permute.grid(n)
    while True:
        column, row = x % a, x // a
        for k, (m, s, t) in enumerate(permute.round_constants(seed, stream)):
            if k % 2 == 0:
                column = (column + ((row * m + s) ** 2 + t) % permute.PRIME) % a
            else:
                row = (row + ((column * m + s) ** 2 + t) % permute.PRIME) % b
        x = row * a + column
        if x < n:
            return x


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 10, 101, 1000])
def test_permuted_ranks_are_a_bijection(spark, n):
    rows = spark.range(n).select("id", permute.permuted_rank(F.col("id"), n, 42, 3).alias("image")).collect()
    assert sorted(r.image for r in rows) == list(range(n))
    assert all(r.image == plain_image(r.id, n, 42, 3) for r in rows)


def test_permutations_of_many_streams_are_even():
    seen = collections.Counter(tuple(plain_image(i, 4, 7, s) for i in range(4)) for s in range(2400))
    assert len(seen) == 24 and all(60 <= k <= 145 for k in seen.values())


def plain_average_precision(rows):
    positives, out = sum(y for y, _ in rows), 0.0
    for score in sorted({p for _, p in rows}, reverse=True):
        above = [y for y, p in rows if p >= score]
        out += sum(y for y, p in rows if p == score) / positives * sum(above) / len(above)
    return out


def test_importance_equals_plain_loops(spark):
    rows = [(i * 3, int(i % 3 == 0), (i * 7 % 11) / 11.0 if i % 5 else None, float(i % 4), "x") for i in range(40)]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double, _f2 string")
    rule = lambda a, b: min(1.0, (a or 0.0) * 0.6 + b / 10.0)
    out = X.permutation_importance(df, "k", "y", ["a", ["a", "b"], "b"], lambda d: F.least(
        F.lit(1.0), F.coalesce("a", F.lit(0.0)) * 0.6 + F.col("b") / 10.0), repeats=3, seed=5).collect()
    baseline = plain_average_precision([(y, rule(a, b)) for _, y, a, b, _ in rows])
    for name, cols in (("a", "a"), ("a+b", "ab"), ("b", "b")):
        got = next(r for r in out if r.feature_name == name)
        for r in range(3):
            giver = {plain_image(i, 40, 5, r): i for i in range(40)}
            scored = [(row[1], rule(rows[giver[i]][2] if "a" in cols else row[2], rows[giver[i]][3] if "b" in cols else row[3]))
                      for i, row in enumerate(rows)]
            assert got.importance_values[r] == pytest.approx(baseline - plain_average_precision(scored))
    assert [r.mean_importance for r in out] == sorted((r.mean_importance for r in out), reverse=True)


def test_rows_of_null_and_equal_keys_stay(spark):
    df = spark.createDataFrame([(None, 1, 0.5), (None, 0, 0.25), (4, 0, 0.75), (4, 1, 1.0)], "k long, y int, a double")
    copies = X.permuted_copies(df, "k", [["a"]], 4, 1).groupBy("_r").agg(F.array_sort(F.collect_list("a")).alias("a"),
                                                                         F.sum("y").alias("y")).collect()
    assert len(copies) == 4 and all(r.a == [0.25, 0.5, 0.75, 1.0] and r.y == 2 for r in copies)


def test_no_rows_give_no_importances(spark):
    df = spark.createDataFrame([], "k long, y int, a double")
    assert X.permuted_copies(df, "k", [["a"]], 2, 1).count() == 0
