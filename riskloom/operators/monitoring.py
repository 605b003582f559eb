"""Second-wave operators specified by the reference's requirements.

All are grouped aggregates, exact distributed ranks or small lookups; none
collects rows to the driver (cut points of a base period are a bounded
summary).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.columns import nan_to_null, q
from riskloom.functions.cumulative import BUCKET, bucketize, exact_quantiles, running_totals
from riskloom.operators.metrics import (MSG_S_MISSING, MSG_S_RANGE, MSG_Y_BINARY, MSG_Y_MISSING, _finish, _guard, check_threshold,
                                        precision_recall_curve)
from riskloom.session import ensure_checkpoint_dir


def calibration_curve(df: DataFrame, y: str, s: str, bins: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width score bins; mean predicted vs observed rate per bin."""
    b = F.least(F.floor(F.col(s) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*group_cols, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(s).alias("mean_predicted"),
        F.avg(F.col(y).cast("double")).alias("observed_rate"))


def gains_table(df: DataFrame, y: str, s: str, key: str, groups: int = 10) -> DataFrame:
    """Rows ordered by score (desc, key asc) cut into equal-count groups by exact rank;
    per group: rows, positives, cumulative gain and lift."""
    rows = df.select(q(key), F.col(s), F.col(y), F.lit(1).alias("_one"))
    scores = rows.groupBy(s).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(y)).alias("_pos"))
    at = running_totals(scores, s, ["_n"], descending=True)

    def decile(rank: Column) -> Column:
        return F.floor(rank * groups / F.col("tot__n")).cast("int")

    first, last = decile(F.col("cum__n") - F.col("_n")), decile(F.col("cum__n") - 1)
    whole = at.where(first == last).select(first.alias("decile"), "_n", "_pos", F.col(s).alias("_s"), "tot__n")
    # fewer scores than groups lie across an edge; their rows, however many, are ranked by key in buckets
    cut = at.where(first != last).select(F.col(s).alias("_s"), (F.col("cum__n") - F.col("_n")).alias("_before"), "tot__n")
    split = rows.join(F.broadcast(cut), F.col(s).eqNullSafe(F.col("_s")))
    split = running_totals(split, key, ["_one"], ["_s"], with_totals=False).select(
        decile(F.col("_before") + F.col("cum__one") - 1).alias("decile"), F.lit(1).cast("long").alias("_n"),
        F.col(y).alias("_pos"), "_s", "tot__n")
    per = whole.unionByName(split).groupBy("decile").agg(
        F.sum("_n").alias("rows"), F.sum("_pos").alias("positives"), F.min("_s").alias("min_score"),
        F.max("_s").alias("max_score"), F.max("tot__n").alias("_rows_total"))
    tot = per.agg(F.sum("positives").alias("_pos_total"), F.max("_rows_total").alias("_all_rows")).withColumn("_one", F.lit(1))
    from pyspark.sql import Window
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # <= groups rows
    out = per.withColumn("_one", F.lit(1)).join(F.broadcast(tot), on="_one") \
        .withColumn("cumulative_positives", F.sum("positives").over(w)) \
        .withColumn("cumulative_rows", F.sum("rows").over(w))
    return out.select("decile", "rows", F.col("positives").cast("long"), "min_score", "max_score",
                      F.col("cumulative_positives").cast("long"),
                      (F.col("cumulative_positives") / F.col("_pos_total")).alias("cumulative_gain"),
                      ((F.col("positives") / F.col("rows")) / (F.col("_pos_total") / F.col("_all_rows"))).alias("lift"),
                      ((F.col("cumulative_positives") / F.col("cumulative_rows"))
                       / (F.col("_pos_total") / F.col("_all_rows")))
                      .alias("cumulative_lift"))


def recall_at_precision(df: DataFrame, y: str, s: str, targets: Sequence[float],
                        group_cols: Sequence[str] = ()) -> DataFrame:
    """D3: best recall among thresholds whose precision reaches each target (and that threshold,
    the highest such recall's lowest threshold)."""
    pr = precision_recall_curve(df, y, s, group_cols).where(F.col("threshold").isNotNull())
    t = F.explode(F.array(*[F.lit(float(v)) for v in targets])).alias("target_precision")
    x = pr.select(*group_cols, "threshold", "precision", "recall", t).where(F.col("precision") >= F.col("target_precision"))
    return x.groupBy(*group_cols, "target_precision").agg(
        F.max("recall").alias("max_recall"),
        F.min_by("threshold", F.struct(-F.col("recall"), F.col("threshold"))).alias("threshold"))


def psi(base: DataFrame, current: DataFrame, value: str, bins: int = 10, group_cols: Sequence[str] = (),
        eps: float = 1e-6) -> DataFrame:
    """Population stability index of ``value``; bins are the base period's exact deciles
    (value <= cut goes to the lower bin).  PSI = sum (a - b) ln(a / b) with empty shares floored at eps.
    A group that only the current period has gets one row with its count: no bin, no base, no term."""
    group_cols = list(group_cols)
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(base, value, probs, group_cols)
    cut_arr = cuts.groupBy(*group_cols).agg(F.array_sort(F.collect_list(F.struct("q_index", "quantile"))).alias("_c"))
    cut_arr = cut_arr.select(*group_cols, F.transform("_c", lambda x: x["quantile"]).alias("_cuts"))

    def binned(df: DataFrame, tag: str) -> DataFrame:
        keys = group_cols or ["_one"]
        d = df.withColumn("_one", F.lit(1)) if not group_cols else df
        c = cut_arr.withColumn("_one", F.lit(1)) if not group_cols else cut_arr
        x = d.where(F.col(value).isNotNull()).join(c, on=keys, how="left")
        b = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda cut: F.col(value) > cut)))
        return x.groupBy(*group_cols, b.alias("bin")).agg(F.count(F.lit(1)).alias(tag))

    a = binned(current, "current_count")
    b = binned(base, "base_count")
    j = b.join(a, on=group_cols + ["bin"], how="full").fillna(0, ["current_count", "base_count"])
    from pyspark.sql import Window
    w = Window.partitionBy(*group_cols)  # <= bins rows per group
    share = lambda c: F.greatest(F.coalesce(F.try_divide(c, F.sum(c).over(w)), F.lit(0.0)), F.lit(eps))
    j = j.withColumn("base_share", share("base_count")).withColumn("current_share", share("current_count"))
    term = (F.col("current_share") - F.col("base_share")) * F.log(F.col("current_share") / F.col("base_share"))
    return j.withColumn("psi_term", F.when(F.col("bin").isNotNull(), term))


def band_expression(p: Column, bands: Sequence[tuple[str, float | None, float | None]]) -> Column:
    """Configurable bands (name, lower inclusive, upper exclusive) as one CASE expression."""
    out = None
    for name, lo, hi in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (p >= lo)
        if hi is not None:
            cond = cond & (p < hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def cohort_profile(df: DataFrame, cohort: str, columns: Sequence[str]) -> DataFrame:
    """Per cohort and column: count, mean, exact median."""
    long = df.select(q(cohort).alias("cohort"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), nan_to_null(q(c).cast("double")).alias("value")) for c in columns])))
    mom = long.groupBy("cohort", "column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"))
    med = exact_quantiles(long, "value", [0.5], ["cohort", "column"]).select("cohort", "column",
                                                                               F.col("quantile").alias("median"))
    return mom.join(med, on=["cohort", "column"], how="left")


def treatment_audit(df: DataFrame, clip_rules: dict, impute_cols: Sequence[str]) -> DataFrame:
    """Rows changed by each clip rule and rows imputed per column (one aggregate)."""
    aggs = []
    for c, (lo, hi) in clip_rules.items():
        v = nan_to_null(q(c))
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (v < lo)
        if hi is not None:
            cond = cond | (v > hi)
        aggs.append(F.struct(F.lit(c).alias("column"), F.lit("capped").alias("treatment"),
                             F.count_if(cond).alias("rows")))
    for c in impute_cols:
        aggs.append(F.struct(F.lit(c).alias("column"), F.lit("imputed").alias("treatment"),
                             F.count_if(nan_to_null(q(c)).isNull()).alias("rows")))
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def joint_delinquency(df: DataFrame, columns: Sequence[str], limit: float = R.DELINQUENCY_MAX) -> DataFrame:
    """Rows over the limit in any / all delinquency columns (the joint rule) in one pass."""
    over = [q(c) > limit for c in columns]
    any_ = over[0]
    all_ = over[0]
    for o in over[1:]:
        any_ = any_ | o
        all_ = all_ & o
    return df.agg(F.count_if(any_).alias("any_column_over_limit"), F.count_if(all_).alias("all_columns_over_limit"),
                  F.count(F.lit(1)).alias("row_count"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one pass (long form); null where a column has one value or none in the
    pair's rows.

    A task sums the co-moments of all pairs over its rows, batch by batch, and passes on one row a pair; these are merged pair by pair.
    Deviations are taken from a value of the batch, so a column of one value has a deviation of exactly zero."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    places = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]

    def merged(a, b):
        """(n, mean x, mean y, sum of squared deviations of x, of y, sum of their products) of two sets of rows together."""
        n = a[0] + b[0]
        dx, dy, shared = b[1] - a[1], b[2] - a[2], a[0] * b[0] / n
        return (n, a[1] + dx * b[0] / n, a[2] + dy * b[0] / n, a[3] + b[3] + dx * dx * shared, a[4] + b[4] + dy * dy * shared,
                a[5] + b[5] + dx * dy * shared)

    def co_moments(batches):
        sums = {}
        for batch in batches:
            there = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            values = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns]
            with np.errstate(invalid="ignore", over="ignore"):
                for p, (i, j) in enumerate(places):
                    both = there[i] & there[j]
                    x, y = values[i][both], values[j][both]
                    if not len(x):
                        continue
                    dx, dy = x - x[0], y - y[0]
                    mx, my = dx.mean(), dy.mean()
                    dx, dy = dx - mx, dy - my
                    own = (float(len(x)), x[0] + mx, y[0] + my, (dx * dx).sum(), (dy * dy).sum(), (dx * dy).sum())
                    sums[p] = merged(sums[p], own) if p in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), *[pa.array([m[f] for m in sums.values()], pa.float64()) for f in range(6)]],
                                         names=["_p", *fields])

    def correlation(parts: pa.Table) -> pa.Table:
        with np.errstate(invalid="ignore", over="ignore"):
            n, _, _, xx, yy, xy = reduce(merged, zip(*[parts[f].to_numpy() for f in fields]))
            deviation = np.sqrt(xx / n) * np.sqrt(yy / n)
            at = (parts["_p"][0].as_py(), xy / n, deviation if np.isfinite(deviation) else math.nan)
        return pa.table({name: pa.array([v]) for name, v in zip(("_p", "_covariance", "_deviation"), at)})

    fields = ["n", "x", "y", "xx", "yy", "xy"]
    rows = df.select(*[q(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    parts = rows.mapInArrow(co_moments, "_p long, " + ", ".join(f"{f} double" for f in fields))
    found = parts.groupBy("_p").applyInArrow(correlation, "_p long, _covariance double, _deviation double")
    names = df.sparkSession.createDataFrame([(p, a, b) for p, (a, b) in enumerate(pairs)], "_p long, column_a string, column_b string")
    return names.join(found, on="_p", how="left").select("column_a", "column_b", F.try_divide("_covariance", "_deviation").alias("pearson"))


#: A value with at least this part of a column's rows is frequent: a column has at most 1 / FREQUENT of them.
FREQUENT = 1 / 256


def spearman_ranks(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Average ranks (ties share the mean rank; null and NaN have none) of the columns, one row for every row of ``df``, with its key;
    ``corr`` of these ranks is Spearman's rho.

    Ranks come from the running counts of each column's distinct values.  Frequent values, of which there are at most
    ``1 / FREQUENT`` a column, are broadcast and looked up in place, and their rows shuffle by the row alone; the others are
    joined by value, where no value holds more than that part of the rows.  Equal and null keys are rows of their own."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(q(key), *[nan_to_null(q(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(columns)])
    # a row's own number is drawn once: the job that joins it back must not draw another, so the numbered rows are a checkpoint
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    long = rows.select("_row", F.posexplode(F.array(*[f"_v{i}" for i in range(len(columns))])).alias("_c", "_v")).where(F.col("_v").isNotNull())
    counts = long.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(counts, "_v", ["_n"], ["_c"]).select(
        "_c", "_v", "_n", "tot__n", (F.col("cum__n") - (F.col("_n") - 1) / 2.0).alias("_rank")).persist()
    is_frequent = F.col("_n") >= F.col("tot__n") * F.lit(FREQUENT)
    table = ranks.where(is_frequent).agg(F.collect_list(F.struct("_c", "_v", "_rank")).alias("_t"))  # columns / FREQUENT entries

    def rank_map(i: int) -> Column:
        own = F.filter("_t", lambda e: e["_c"] == i)
        return F.map_from_entries(F.transform(own, lambda e: F.struct(e["_v"], e["_rank"]))).alias(f"_m{i}")

    looked_up = rows.crossJoin(F.broadcast(table.select(*[rank_map(i) for i in range(len(columns))])))  # one row
    found = [F.try_element_at(f"_m{i}", F.col(f"_v{i}")) for i in range(len(columns))]
    held = looked_up.select("_row", q(key), *[r.alias(f"_f{i}") for i, r in enumerate(found)],
                            *[F.when(r.isNull(), F.col(f"_v{i}")).alias(f"_v{i}") for i, r in enumerate(found)])
    rare = held.select("_row", F.posexplode(F.array(*[f"_v{i}" for i in range(len(columns))])).alias("_c", "_v")).where(F.col("_v").isNotNull()) \
        .join(ranks.where(~is_frequent).select("_c", "_v", "_rank"), on=["_c", "_v"])
    rare = rare.groupBy("_row").agg(*[F.max(F.when(F.col("_c") == i, F.col("_rank"))).alias(f"_r{i}") for i in range(len(columns))])
    return held.join(rare, on="_row", how="left").select(
        q(key), *[F.coalesce(f"_f{i}", f"_r{i}").alias(c) for i, c in enumerate(columns)])


def correlation_clusters(pairs: DataFrame, value: str, columns: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """Clusters of columns linked by |``value``| >= threshold: one row a column with its cluster (its first member in the order of
    names) and the cluster's size.  ``pairs`` is a table (column_a, column_b, value) of column pairs; a null value links nothing.

    Labels spread along links and jump to their label's label, so about log2 of the columns' number of rounds suffice."""
    spark = pairs.sparkSession
    ensure_checkpoint_dir(spark)
    # the pairs may be the end of a long job: they are made once, not once for each direction of the links
    links = pairs.where(F.abs(F.col(value)) >= threshold).select(F.col("column_a").alias("a"), F.col("column_b").alias("b")).checkpoint()
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).checkpoint()
    labels = spark.createDataFrame([(c, c) for c in columns], "column string, cluster string")
    while True:
        near = links.join(labels, F.col("b") == F.col("column")).groupBy("a").agg(F.min("cluster").alias("near"))
        step = labels.join(near, F.col("a") == F.col("column"), "left").select(
            "column", F.least("cluster", F.coalesce("near", "cluster")).alias("cluster"), F.col("cluster").alias("before"))
        parent = step.select(F.col("column").alias("parent"), F.col("cluster").alias("jump"))
        step = step.join(parent, F.col("cluster") == F.col("parent")).select("column", F.col("jump").alias("cluster"), "before").checkpoint()
        labels = step.select("column", "cluster")
        if step.where("cluster <> before").isEmpty():
            break
    size = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    return labels.join(size, on="cluster").select("column", "cluster", "cluster_size")


def poisson_weight(seed: int, replicate: Column, key: Column) -> Column:
    """The Poisson(1) weight of a row in a replicate: the inverse distribution function at 53 bits of a hash, as double."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), replicate, key), 11).cast("double") / float(2 ** 53)
    cdf, acc, p = [], 0.0, math.exp(-1.0)
    for k in range(19):  # 53 bits can't reach weights above 18
        acc += p
        cdf.append(acc)
        p = p / (k + 1)
    weight = F.lit(len(cdf))
    for k in reversed(range(len(cdf))):
        weight = F.when(u < cdf[k], F.lit(k)).otherwise(weight)
    return weight.cast("double")


#: Weights (cells x replicates) that one task of the bootstrap holds in each of its matrices, about.
BOOTSTRAP_WEIGHTS = 1_000_000


def bootstrap_replicates(df: DataFrame, y: str, s: str, key: str, replicates: int = 200, seed: int = 42, threshold: float = 0.5,
                         weights_per_task: int = BOOTSTRAP_WEIGHTS) -> DataFrame:
    """The metrics row (K12) of every replicate 0 .. replicates - 1, in which each row of ``df`` counts ``poisson_weight`` times.

    No row is copied: a row has the array of its weights, arrays are summed per (score, class) before the shuffle, and the running
    sums over the scores are taken for all replicates at once, bucket by bucket of the scores: bucket totals give the sums before
    each bucket, within a bucket they are one cumulative sum of a (scores x replicates) matrix."""
    from pyspark.sql import Window
    check_threshold(threshold)
    yc, sc = F.col(y), F.col(s)
    ids = F.sequence(F.lit(0), F.lit(replicates - 1))
    rows = df.select(
        _guard(yc.cast("int"), [(yc.isNull(), MSG_Y_MISSING), (~yc.isin(0, 1), MSG_Y_BINARY), (sc.isNull() | F.isnan(sc), MSG_S_MISSING),
                                ((sc < 0) | (sc > 1), MSG_S_RANGE)]).alias("_y"),
        sc.cast("double").alias("_s"), F.transform(ids, lambda r: poisson_weight(seed, r, q(key))).alias("_w"))

    def summed(g: DataFrame, *by: str) -> DataFrame:
        return g.groupBy(*by).agg(*[F.sum(F.col("_w")[r]).alias(f"_w{r}") for r in range(replicates)]).select(
            *by, F.array(*[f"_w{r}" for r in range(replicates)]).alias("_w"))

    cells = summed(rows, "_s", "_y").persist()
    buckets = max(1, math.ceil(cells.count() * replicates / weights_per_task))
    cells = bucketize(cells, "_s", buckets) if buckets > 1 else cells.withColumn(BUCKET, F.lit(0))
    per = summed(cells, BUCKET, "_y").select(BUCKET, "_y", F.posexplode("_w").alias("replicate", "_w")).groupBy(BUCKET, "replicate").agg(
        F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0.0)).alias("pos"), F.sum(F.when(F.col("_y") == 0, F.col("_w")).otherwise(0.0)).alias("neg"))
    every = Window.partitionBy("replicate")  # a row a bucket
    above = every.orderBy(F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(BUCKET, "replicate", *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(f"{c}_above") for c in ("pos", "neg")],
                        *[F.sum(c).over(every).alias(f"{c}_total") for c in ("pos", "neg")])
    fields = ("pos_above", "neg_above", "pos_total", "neg_total")
    starts = starts.groupBy(F.col(BUCKET).alias("_at")).agg(F.array_sort(F.collect_list(F.struct("replicate", *fields))).alias("_l")) \
        .select("_at", *[F.expr(f"transform(_l, e -> e.{f})").alias(f) for f in fields])

    def measure(cell: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        scores = np.unique(cell["_s"].to_numpy())[::-1]
        counts = np.zeros((2, len(scores), replicates))
        counts[cell["_y"].to_numpy(), np.searchsorted(-scores, -cell["_s"].to_numpy())] = np.stack(cell["_w"].to_list())
        neg, pos = counts
        pos_above, neg_above, pos_total, neg_total = (np.asarray(start[f].iloc[0]) for f in fields)
        cum_pos, cum_neg = pos_above + pos.cumsum(axis=0), neg_above + neg.cumsum(axis=0)
        at = scores[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            ap = np.nan_to_num(pos * cum_pos / (cum_pos + cum_neg)).sum(axis=0)
            ks = np.nan_to_num(np.abs(cum_pos / pos_total - cum_neg / neg_total)).max(axis=0)
        hit = at >= threshold
        return pd.DataFrame({
            "replicate": np.arange(replicates), "P": pos.sum(axis=0), "N": neg.sum(axis=0),
            "_auc_num": (neg * (cum_pos - pos / 2.0)).sum(axis=0), "_ap_num": ap, "_ks": ks,
            "_sq": (pos * (at - 1.0) ** 2 + neg * at ** 2).sum(axis=0), "tp": (pos * hit).sum(axis=0), "fp": (neg * hit).sum(axis=0)})

    sums = ("P", "N", "_auc_num", "_ap_num", "_sq", "tp", "fp")
    parts = cells.groupBy(BUCKET).cogroup(starts.groupBy("_at")).applyInPandas(
        measure, "replicate int, P double, N double, _auc_num double, _ap_num double, _ks double, _sq double, tp double, fp double")
    agg = parts.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in sums], F.max("_ks").alias("_ks"),
                                         *[F.lit(0).alias(c) for c in ("_bad_y", "_null_y", "_s_missing", "_s_range")])
    return _finish(agg, ["replicate"], F.lit(float(threshold)))


def bootstrap_metrics(df: DataFrame, y: str, s: str, key: str, replicates: int = 200, seed: int = 42,
                      metrics: Sequence[str] = ("average_precision", "roc_auc", "ks_statistic", "brier_score"),
                      level: float = 0.95, threshold: float = 0.5) -> DataFrame:
    """Poisson(1) bootstrap - every row gets a repeatable Poisson weight per replicate from a hash of its key, and the interval is
    the exact percentile of each metric over the replicates (``bootstrap_replicates``)."""
    per = bootstrap_replicates(df, y, s, key, replicates, seed, threshold).persist()  # a row a replicate, read by several jobs
    long = per.select("replicate", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                      for m in metrics])))
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    qs = exact_quantiles(long, "value", [lo, 0.5, hi], ["metric"])
    return qs.groupBy("metric").agg(F.max(F.when(F.col("q_index") == 0, F.col("quantile"))).alias("lower"),
                                    F.max(F.when(F.col("q_index") == 1, F.col("quantile"))).alias("median"),
                                    F.max(F.when(F.col("q_index") == 2, F.col("quantile"))).alias("upper"))


def distribution_shift(df: DataFrame, a: str, b: str, bins: int = 20, group_cols: Sequence[str] = ()) -> DataFrame:
    """Histograms of two probability columns on [0, 1] side by side plus the mean absolute
    difference per group."""
    def binned(c):
        return F.least(F.floor(F.col(c) * bins), F.lit(bins - 1)).cast("int")
    long = df.select(*group_cols, F.abs(F.col(a) - F.col(b)).alias("_d"), F.inline(F.array(
        F.struct(F.lit(a).alias("series"), binned(a).alias("bin")),
        F.struct(F.lit(b).alias("series"), binned(b).alias("bin")))))
    hist = long.groupBy(*group_cols, "bin").agg(
        F.count_if(F.col("series") == a).alias(f"{a}_count"), F.count_if(F.col("series") == b).alias(f"{b}_count"))
    mad = df.groupBy(*group_cols).agg(F.avg(F.abs(F.col(a) - F.col(b))).alias("mean_absolute_difference"))
    return hist.join(mad, on=list(group_cols) or None, how="inner") if group_cols else \
        hist.withColumn("_one", F.lit(1)).join(mad.withColumn("_one", F.lit(1)), on="_one").drop("_one")


def importance_stability(runs: DataFrame, run_col: str, name_col: str, value_col: str, top_k: int = 5) -> DataFrame:
    """Per pair of runs (seeds), overlap of the top-k feature sets and the Spearman correlation of
    the importance ranks.  ``runs`` holds one row per (run, feature): a small table."""
    from pyspark.sql import Window
    w = Window.partitionBy(run_col).orderBy(F.col(value_col).desc(), F.col(name_col))
    ranked = runs.withColumn("_rank", F.row_number().over(w).cast("double"))
    tops = ranked.groupBy(run_col).agg(F.collect_set(F.when(F.col("_rank") <= top_k, F.col(name_col))).alias("_top"))
    a = ranked.select(F.col(run_col).alias("run_a"), name_col, F.col("_rank").alias("rank_a"))
    b = ranked.select(F.col(run_col).alias("run_b"), name_col, F.col("_rank").alias("rank_b"))
    pairs = a.join(b, on=name_col).where(F.col("run_a") < F.col("run_b"))
    corr = pairs.groupBy("run_a", "run_b").agg(F.corr("rank_a", "rank_b").alias("rank_correlation"))
    ta = tops.select(F.col(run_col).alias("run_a"), F.col("_top").alias("top_a"))
    tb = tops.select(F.col(run_col).alias("run_b"), F.col("_top").alias("top_b"))
    return corr.join(ta, on="run_a").join(tb, on="run_b").select(
        "run_a", "run_b", "rank_correlation",
        (F.size(F.array_intersect("top_a", "top_b")) / F.lit(float(top_k))).alias("top_k_overlap"))
