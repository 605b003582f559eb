"""Threshold search and business cost (T1-T7) in one pass over the scores.

The reference re-evaluates the whole metric bundle at each of ~210
candidate thresholds.  Here the candidates are interleaved with the
distinct scores of each group and one exact descending running sum gives
``tp``/``fp`` at every candidate at once (``ranked_scores`` with probe rows);
no candidate list is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.cumulative import exact_quantiles
from riskloom.operators.metrics import binary_metrics, ranked_scores

# FIXED VALUES
MSG_MAX_CANDIDATES = "max_candidates must be greater than 1."


def grid_probs(max_candidates: int) -> list[float]:
    if max_candidates <= 1:
        raise ValueError(MSG_MAX_CANDIDATES)
    return [i / (max_candidates - 1) for i in range(max_candidates)]


def candidate_grid(df: DataFrame, s: str, group_cols: Sequence[str] = (),
                   max_candidates: int = R.DEFAULT_MAX_CANDIDATES,
                   fixed: Sequence[float] = R.FIXED_THRESHOLD_CANDIDATES) -> DataFrame:
    """Exact linear quantiles at evenly spaced positions, plus fixed candidates, clipped to
    [0, 1], distinct.  Output (group..., threshold)."""
    group_cols = list(group_cols)
    qs = exact_quantiles(df, s, grid_probs(max_candidates), group_cols)
    from_quantiles = qs.select(*group_cols, F.col("quantile").alias("threshold"))
    groups = qs.select(*group_cols).distinct() if group_cols else None
    fixed_arr = F.array(*[F.lit(float(v)) for v in fixed])
    if groups is not None:
        extra = groups.select(*group_cols, F.explode(fixed_arr).alias("threshold"))
    else:
        extra = qs.limit(1).select(F.explode(fixed_arr).alias("threshold"))
    grid = from_quantiles.unionByName(extra)
    return grid.select(*group_cols, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("threshold")))
                       .alias("threshold")).distinct()


def threshold_sweep(df: DataFrame, y: str, s: str, grid: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and threshold metrics at every candidate (one pass).

    Output (group..., threshold, tn, fp, fn, tp, precision, recall, f1, accuracy, row_count)."""
    group_cols = list(group_cols)
    probes = grid.select(*group_cols, F.col("threshold").cast("double").alias(s))
    rt = ranked_scores(df.select(*group_cols, y, F.col(s).cast("double").alias(s)), y, s, group_cols, extra=probes)
    pts = rt.where(F.col("_probe") == 1)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    P, N = F.col("tot_pos"), F.col("tot_neg")
    fn, tn = P - tp, N - fp
    return pts.select(
        *group_cols, F.col(s).alias("threshold"),
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, P), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(tp + tn, P + N).alias("accuracy"),
        (P + N).alias("row_count"))


def select_threshold(sweep: DataFrame, objective: str = "f1", group_cols: Sequence[str] = (),
                     min_precision: float | None = None, min_recall: float | None = None,
                     top: int = 10) -> DataFrame:
    """Feasible pool (or all, status constraints_not_met); order objective desc, recall desc,
    threshold asc.  Output: the pool's top ``top`` rows with rank, status and feasible count."""
    group_cols = list(group_cols)
    feasible = F.lit(True)
    if min_precision is not None:
        feasible = feasible & (F.col("precision") >= min_precision)
    if min_recall is not None:
        feasible = feasible & (F.col("recall") >= min_recall)
    wg = Window.partitionBy(*group_cols)  # <= max_candidates + 9 rows per group
    x = sweep.withColumn("objective_value", F.col(objective)).withColumn("_feasible", feasible) \
        .withColumn("feasible_candidate_count", F.count_if("_feasible").over(wg)) \
        .withColumn("candidate_count", F.count(F.lit(1)).over(wg))
    pool = x.where(F.col("_feasible") | (F.col("feasible_candidate_count") == 0))
    order = Window.partitionBy(*group_cols).orderBy(F.col("objective_value").desc(), F.col("recall").desc(),
                                                   F.col("threshold").asc())
    ranked = pool.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    status = F.when(F.col("feasible_candidate_count") > 0, F.lit("constraints_satisfied")) \
        .otherwise(F.lit("constraints_not_met"))
    return ranked.withColumn("status", status).drop("_feasible")


def business_cost(sweep: DataFrame, fp_cost: float = 1.0, fn_cost: float = 5.0, tp_benefit: float = 0.0,
                  tn_benefit: float = 0.0) -> DataFrame:
    """Total and average cost per row at every candidate."""
    total = (F.col("fp") * fp_cost + F.col("fn") * fn_cost - F.col("tp") * tp_benefit - F.col("tn") * tn_benefit)
    return sweep.withColumn("total_cost", total.cast("double")) \
        .withColumn("average_cost_per_row", F.when(F.col("row_count") > 0, F.col("total_cost") / F.col("row_count"))
                    .otherwise(F.col("total_cost")))


def select_cost_threshold(costed: DataFrame, group_cols: Sequence[str] = (), top: int = 10) -> DataFrame:
    """Lowest average cost, then highest recall, then lowest threshold; top ``top`` rows."""
    group_cols = list(group_cols)
    order = Window.partitionBy(*group_cols).orderBy(F.col("average_cost_per_row").asc(), F.col("recall").desc(),
                                                   F.col("threshold").asc())
    return costed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def threshold_report(scored: DataFrame, y: str, s: str, split_col: str = "split", objective: str = "f1",
                     choose_on: str = "validation", read_on: str = "test", group_cols: Sequence[str] = (),
                     max_candidates: int = R.DEFAULT_MAX_CANDIDATES, min_precision: float | None = None,
                     min_recall: float | None = None) -> DataFrame:
    """T5: choose the threshold on one partition, read the full metric bundle out on another.
    Output one row per group: recommended threshold + test metrics."""
    group_cols = list(group_cols)
    val = scored.where(F.col(split_col) == choose_on)
    grid = candidate_grid(val, s, group_cols, max_candidates)
    best = select_threshold(threshold_sweep(val, y, s, grid, group_cols), objective, group_cols,
                            min_precision, min_recall, top=1)
    chosen = best.select(*group_cols, "threshold", "status")
    test = scored.where(F.col(split_col) == read_on)
    metrics = binary_metrics(test, y, s, chosen.select(*group_cols, "threshold"), group_cols)
    keys = group_cols or ["_one"]
    if not group_cols:
        metrics, chosen = metrics.withColumn("_one", F.lit(1)), chosen.withColumn("_one", F.lit(1))
    out = metrics.join(chosen.select(*keys, "status"), on=keys, how="inner")
    return out if group_cols else out.drop("_one")
