"""Binary-classifier evaluation as grouped aggregates.

Everything is computed from one map-side-combined aggregate per
(group, distinct score): ``pos`` and ``neg`` counts.  Confusion counts,
Brier score, ROC AUC (ties count one half), average precision (no
interpolation) and the KS statistic all derive from that table and its
exact running sums (``running_totals``), so one scan of the scored rows
serves every metric of every group (split, model, repeat, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.cumulative import BUCKET, running_totals

# FIXED VALUES: input-check messages.
MSG_Y_BINARY = "Binary evaluation requires y_true to contain only 0/1 values."
MSG_Y_MISSING = "Binary evaluation does not allow missing target values."
MSG_S_MISSING = "Binary evaluation does not allow missing probability scores."
MSG_S_RANGE = "Probability scores must be bounded within [0, 1]."
MSG_THRESHOLD = "threshold must be bounded within [0, 1]."
MSG_NO_THRESHOLD = "A group has no threshold."
MSG_ONE_CLASS = "KS statistic requires both negative and positive classes to be present."
MSG_ROC_ONE_CLASS = "ROC curve requires both negative and positive classes to be present."


def check_threshold(threshold: float) -> None:
    if not 0.0 <= float(threshold) <= 1.0:
        raise ValueError(MSG_THRESHOLD)


def score_table(df: DataFrame, y: str, s: str, group_cols: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(group..., s, pos, neg, _bad_y, _null_y) - one row per distinct score.  With ``weight``,
    pos / neg are weighted sums (sample weights, bootstrap replicate weights)."""
    yc = F.col(y)
    if weight is not None:
        w = F.col(weight).cast("double")
        pos, neg = F.sum(F.when(yc == 1, w).otherwise(0.0)), F.sum(F.when(yc == 0, w).otherwise(0.0))
    else:
        pos, neg = F.count_if(yc == 1), F.count_if(yc == 0)
    return df.groupBy(*group_cols, s).agg(
        pos.alias("pos"),
        neg.alias("neg"),
        F.count_if(yc.isNotNull() & ~yc.isin(0, 1)).alias("_bad_y"),
        F.count_if(yc.isNull()).alias("_null_y"),
    )


def _score_invalid(s: str) -> Column:
    return F.col(s).isNull() | F.isnan(s) | (F.col(s) < 0) | (F.col(s) > 1)


def _guard(value: Column, checks: list[tuple[Column, str]]) -> Column:
    """Raise at execution time (no extra pass) when any check column is true."""
    out = value
    for cond, msg in reversed(checks):
        out = F.when(cond, F.raise_error(F.lit(msg))).otherwise(out)
    return out


def ranked_scores(df: DataFrame, y: str, s: str, group_cols: Sequence[str] = (),
                  extra: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Score table with exact descending running sums ``cum_pos``/``cum_neg`` and totals.

    ``extra`` rows (group..., s, pos=0, neg=0, _probe=1) are interleaved after
    the score rows of equal value, so their running sums count every score >= s.
    """
    g = score_table(df, y, s, group_cols, weight)
    base = g.select(*group_cols, s, "pos", "neg", "_bad_y", "_null_y", F.lit(0).alias("_probe"))
    if extra is not None:
        num = "double" if weight is not None else "long"
        base = base.unionByName(extra.select(*group_cols, F.col(s), F.lit(0).cast(num).alias("pos"),
                                             F.lit(0).cast(num).alias("neg"), F.lit(0).cast("long").alias("_bad_y"),
                                             F.lit(0).cast("long").alias("_null_y"), F.lit(1).alias("_probe")))
    return running_totals(base, s, ["pos", "neg", "_bad_y", "_null_y"], group_cols, descending=True,
                          tiebreak="_probe")


def _checked(rt_agg: DataFrame) -> list[tuple[Column, str]]:
    return [
        (F.col("_bad_y") > 0, MSG_Y_BINARY),
        (F.col("_null_y") > 0, MSG_Y_MISSING),
        (F.col("_s_missing") > 0, MSG_S_MISSING),
        (F.col("_s_range") > 0, MSG_S_RANGE),
        ((F.col("P") == 0) | (F.col("N") == 0), MSG_ONE_CLASS),
    ]


def _metric_aggs(s: str, threshold: Column) -> list[Column]:
    sc, pos, neg = F.col(s), F.col("pos"), F.col("neg")
    hit = sc >= threshold
    return [
        F.max("tot_pos").alias("P"),
        F.max("tot_neg").alias("N"),
        F.max("tot__bad_y").alias("_bad_y"),
        F.max("tot__null_y").alias("_null_y"),
        F.sum(F.when(sc.isNull() | F.isnan(s), pos + neg).otherwise(0)).alias("_s_missing"),
        F.sum(F.when((sc < 0) | (sc > 1), pos + neg).otherwise(0)).alias("_s_range"),
        F.sum(neg * (F.col("cum_pos") - pos + pos / 2.0)).alias("_auc_num"),
        F.sum(pos * F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("_ap_num"),
        F.max(F.abs(F.try_divide(F.col("cum_pos"), F.col("tot_pos"))
                    - F.try_divide(F.col("cum_neg"), F.col("tot_neg")))).alias("_ks"),
        F.sum(pos * (sc - 1.0) * (sc - 1.0) + neg * sc * sc).alias("_sq"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
    ]


def _finish(agg: DataFrame, group_cols: Sequence[str], threshold: Column) -> DataFrame:
    P, N = F.col("P"), F.col("N")
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = P - tp, N - fp
    n = P + N
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, P), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))
    checks = _checked(agg)
    cols = [
        n.alias("row_count"),
        F.try_divide(P, n).alias("positive_rate"),
        threshold.alias("threshold"),
        _guard(F.try_divide(F.col("_ap_num"), P), checks).alias("average_precision"),
        _guard(F.try_divide(F.col("_auc_num"), P * N), checks).alias("roc_auc"),
        _guard(F.col("_ks"), checks).alias("ks_statistic"),
        F.try_divide(F.col("_sq"), n).alias("brier_score"),
        F.try_divide(tp + tn, n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        F.coalesce(F.try_divide(tn, N), F.lit(0.0)).alias("actual_0_pred_0"),
        F.coalesce(F.try_divide(fp, N), F.lit(0.0)).alias("actual_0_pred_1"),
        F.coalesce(F.try_divide(fn, P), F.lit(0.0)).alias("actual_1_pred_0"),
        F.coalesce(F.try_divide(tp, P), F.lit(0.0)).alias("actual_1_pred_1"),
    ]
    return agg.select(*group_cols, *cols)


def binary_metrics(
    df: DataFrame,
    y: str,
    s: str,
    threshold: float | DataFrame = 0.5,
    group_cols: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """One metrics row per group.  ``threshold`` is a number or a table
    ``(group..., threshold)`` (one threshold per group, e.g. chosen on validation; a group without one is an error).  ``weight``
    turns every count into a weighted sum (row_count and confusion cells become weights)."""
    group_cols = list(group_cols)
    rt = ranked_scores(df, y, s, group_cols, weight=weight)
    if isinstance(threshold, DataFrame):
        keys = group_cols or ["_one"]
        tt = threshold.select(*group_cols, F.col("threshold").alias("_t"))
        if not group_cols:
            tt, rt = tt.limit(1).withColumn("_one", F.lit(1)), rt.withColumn("_one", F.lit(1))
        rt = rt.join(tt, on=keys, how="left").withColumn("_t", F.when(F.col("_t").isNotNull(), F.col("_t")).otherwise(
            F.raise_error(F.lit(MSG_NO_THRESHOLD)).cast("double")))
        t = F.col("_t")
        agg = rt.groupBy(*group_cols).agg(*_metric_aggs(s, t), F.max("_t").alias("_t"))
        return _finish(agg, group_cols, F.col("_t"))
    check_threshold(threshold)
    t = F.lit(float(threshold))
    agg = rt.groupBy(*group_cols).agg(*_metric_aggs(s, t))
    return _finish(agg, group_cols, t)


def confusion_counts(df: DataFrame, y: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """K2/K3 from given 0/1 predictions: counts and the row-normalised matrix (empty row -> 0)."""
    yc, pc = F.col(y), F.col(pred)
    agg = df.groupBy(*group_cols).agg(
        F.count_if((yc == 0) & (pc == 0)).alias("tn"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if((yc == 1) & (pc == 1)).alias("tp"),
        F.count_if(yc.isNull() | ~yc.isin(0, 1) | pc.isNull() | ~pc.isin(0, 1)).alias("_bad"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return agg.select(
        *group_cols,
        _guard(tn, [(F.col("_bad") > 0, MSG_Y_BINARY)]).alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
        F.coalesce(F.try_divide(tn, tn + fp), F.lit(0.0)).alias("actual_0_pred_0"),
        F.coalesce(F.try_divide(fp, tn + fp), F.lit(0.0)).alias("actual_0_pred_1"),
        F.coalesce(F.try_divide(fn, fn + tp), F.lit(0.0)).alias("actual_1_pred_0"),
        F.coalesce(F.try_divide(tp, fn + tp), F.lit(0.0)).alias("actual_1_pred_1"))


def precision_recall_curve(df: DataFrame, y: str, s: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """K9: one point per distinct score (threshold ascending) plus the final (precision 1, recall 0)
    point with a null threshold.  Columns: group..., point_index, threshold, precision, recall."""
    group_cols = list(group_cols)
    rt = ranked_scores(df, y, s, group_cols)
    ps = F.col("cum_pos") + F.col("cum_neg")
    pts = rt.select(*group_cols, F.col(s).cast("double").alias("threshold"),
                    F.coalesce(F.try_divide(F.col("cum_pos"), ps), F.lit(0.0)).alias("precision"),
                    F.coalesce(F.try_divide(F.col("cum_pos"), F.col("tot_pos")), F.lit(1.0)).alias("recall"))
    last = rt.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_k")).select(
        *group_cols, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(last)


def roc_curve(df: DataFrame, y: str, s: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """ROC points with collinear interior points dropped, starting at (0, 0, +inf).

    A point i (distinct scores, descending) is interior-collinear when the next
    score's (pos, neg) equal its own: the second differences of the cumulative
    counts are the first differences of the per-score counts.
    """
    group_cols = list(group_cols)
    rt = ranked_scores(df, y, s, group_cols)
    keys = group_cols + [BUCKET]
    w = Window.partitionBy(*keys).orderBy(F.col(s).desc())
    rt = rt.withColumn("_next_pos", F.lead("pos").over(w)).withColumn("_next_neg", F.lead("neg").over(w)) \
           .withColumn("_prev_cum", F.col("cum_pos") + F.col("cum_neg") - F.col("pos") - F.col("neg"))
    # First row of every bucket (highest score) stands in for "next" of the previous bucket's last row.
    heads = rt.groupBy(*keys).agg(F.max_by(F.struct("pos", "neg"), F.col(s)).alias("_head"),
                                  F.min(s).alias("_min_s"))
    wb = Window.partitionBy(*group_cols).orderBy(F.col(BUCKET).desc())
    heads = heads.withColumn("_follow", F.lead("_head").over(wb)) \
                 .select(*keys, F.col("_follow.pos").alias("_fpos"), F.col("_follow.neg").alias("_fneg"))
    rt = rt.join(heads, on=keys, how="left")
    next_pos = F.coalesce(F.col("_next_pos"), F.col("_fpos"))
    next_neg = F.coalesce(F.col("_next_neg"), F.col("_fneg"))
    is_first = F.col("_prev_cum") == 0
    is_last = next_pos.isNull()
    keep = is_first | is_last | (next_pos != F.col("pos")) | (next_neg != F.col("neg"))
    checks = [((F.col("tot_pos") == 0) | (F.col("tot_neg") == 0), MSG_ROC_ONE_CLASS)]
    pts = rt.where(keep).select(
        *group_cols, F.col(s).cast("double").alias("threshold"),
        _guard(F.col("cum_neg") / F.col("tot_neg"), checks).alias("false_positive_rate"),
        (F.col("cum_pos") / F.col("tot_pos")).alias("true_positive_rate"))
    start = rt.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_k")).select(
        *group_cols, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("false_positive_rate"),
        F.lit(0.0).alias("true_positive_rate"))
    return pts.unionByName(start)


def ks_row_level(df: DataFrame, y: str, s: str, key: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """K8 row variant: rows ordered by (score desc, key asc), running TPR - FPR after every row, so
    inside a tie the value depends on the tie order (the original's stable-sort behaviour).
    Buckets split on the score; one tied score stays in one bucket (sorted externally)."""
    group_cols = list(group_cols)
    rows = df.select(*group_cols, key, F.col(s), (F.col(y) == 1).cast("long").alias("pos"),
                     (F.col(y) == 0).cast("long").alias("neg"))
    rt = running_totals(rows, s, ["pos", "neg"], group_cols, descending=True, tiebreak=key)
    checks = [((F.col("P") == 0) | (F.col("N") == 0), MSG_ONE_CLASS)]
    agg = rt.groupBy(*group_cols).agg(
        F.max(F.abs(F.try_divide(F.col("cum_pos"), F.col("tot_pos")) - F.try_divide(F.col("cum_neg"), F.col("tot_neg"))))
        .alias("_ks"), F.max("tot_pos").alias("P"), F.max("tot_neg").alias("N"))
    return agg.select(*group_cols, _guard(F.col("_ks"), checks).alias("ks_statistic_row_level"))
