"""Permutation importance (X1, D9) and top-N importances (X2) without sorting or shuffling a copy of the rows per feature.

The rows are ranked once by key.  In repeat r the values of the row of rank i go to the row of rank ``permuted_rank(i)``, a
seeded bijection computed from the rank alone.  One join on the rank brings every repeat's values to the rows, in the same
task the row gets one variant a feature, is scored, and only counts by (feature, repeat, score) are shuffled from there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import q
from riskloom.functions.cumulative import running_totals
from riskloom.functions.permute import permuted_rank
from riskloom.operators.metrics import binary_metrics

#: Rows that one task ranks by key; the permuted values are made in as many tasks as the session shuffles into.
RANKED_ROWS = 50_000

# FIXED VALUES
MSG_REPEATS = "Permutation importance requires n_repeats to be positive."
MSG_TOP = "top_n must be positive."


def permuted_copies(df: DataFrame, key: str, groups: Sequence[Sequence[str]], repeats: int, seed: int) -> DataFrame:
    """The columns of ``df`` and ``_f`` (group name), ``_r`` (repeat): a row for every row of ``df``, group and repeat, in which the
    group's columns hold the values of another row, as double.  A repeat permutes all groups alike, columns of one group together.
    Rows of equal or null key are rows of their own."""
    ranked = running_totals(df.withColumn("_one", F.lit(1)), key, ["_one"], with_totals=False, rows_per_bucket=RANKED_ROWS) \
        .select(*[q(c) for c in df.columns], (F.col("cum__one") - 1).alias("_rank"))
    # little data but much work a row: a number of its own keeps Spark from merging the partitions by their size
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = ranked.repartition(parts, "_rank").persist()
    n = ranked.count()
    used = list(dict.fromkeys(c for g in groups for c in g))
    images = F.array(*[permuted_rank(F.col("_rank"), n, seed, r) for r in range(repeats)])
    given = ranked.select(F.posexplode(images).alias("_r", "_rank"), *[q(c).cast("double").alias(f"_to{i}") for i, c in enumerate(used)])
    met = ranked.join(given.repartition(parts, "_rank"), on="_rank")
    variants = [F.struct(F.lit("+".join(g)).alias("_f"), *[
        (F.col(f"_to{used.index(c)}") if c in g else q(c).cast("double") if c in used else q(c)).alias(c) for c in df.columns]) for g in groups]
    return met.select("_r", F.inline(F.array(*variants))).select("_f", "_r", *[q(c) for c in df.columns])


def permutation_importance(
    df: DataFrame, key: str, y: str, features: Sequence[str] | Sequence[Sequence[str]],
    score: Callable[[DataFrame], Column | DataFrame], metric: str = "average_precision", repeats: int = 5,
    seed: int = 42, direction: str = "maximize", threshold: float = 0.5,
) -> DataFrame:
    """X1 (and D9 when ``features`` holds column groups).  ``score(df)`` returns the probability
    column (or a DataFrame carrying ``_p``).  Output per feature: mean and population std of the
    importance, mean permuted metric, per-repeat values, baseline; sorted by mean importance."""
    if repeats <= 0:
        raise ValueError(MSG_REPEATS)
    groups = [[f] if isinstance(f, str) else list(f) for f in features]
    base = df.persist()

    def scored(frame: DataFrame) -> DataFrame:
        out = score(frame)
        return out if isinstance(out, DataFrame) else frame.withColumn("_p", out)

    baseline = binary_metrics(scored(base), y, "_p", threshold).select(F.col(metric).alias("baseline_metric"))
    metrics = binary_metrics(scored(permuted_copies(base, key, groups, repeats, seed)), y, "_p", threshold, ["_f", "_r"]).select(
        "_f", "_r", F.col(metric).alias("permuted_metric"))
    sign = -1.0 if direction == "minimize" else 1.0
    joined = metrics.withColumn("_one", F.lit(1)).join(F.broadcast(baseline.withColumn("_one", F.lit(1))), on="_one")
    joined = joined.withColumn("importance", F.lit(sign) * (F.col("baseline_metric") - F.col("permuted_metric")))
    out = joined.groupBy(F.col("_f").alias("feature_name")).agg(
        F.avg("importance").alias("mean_importance"), F.stddev_pop("importance").alias("std_importance"),
        F.avg("permuted_metric").alias("mean_permuted_metric"),
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "permuted_metric"))), lambda x: x["permuted_metric"])
        .alias("permuted_metric_values"),
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "importance"))), lambda x: x["importance"])
        .alias("importance_values"),
        F.max("baseline_metric").alias("baseline_metric_value"))
    return out.orderBy(F.desc("mean_importance"), "feature_name")  # one row a feature


def top_importances(imp: DataFrame, value_col: str, n: int, name_col: str = "feature_name") -> DataFrame:
    """The n largest (a top-k is the operator)."""
    if n <= 0:
        raise ValueError(MSG_TOP)
    w = Window.orderBy(F.col(value_col).desc(), F.col(name_col))  # importance tables have one row per feature
    return imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
