"""Labels that arrive late (D11): an as-of join, and metrics by vintage and maturity.

``as_of_join`` gives every left row the newest right row of its key that is
not later than the row's own time.  Both sides are first brought down to one
row for each key and time, so copies cost nothing; time is cut into buckets,
and a row is matched inside its (key, bucket) cell or else takes the last
value of the nearest earlier cell of its key.  The carried values are one row
for each key and bucket, so even a key that holds a third of all rows is
ordered in pieces no larger than a bucket's distinct times.  No pair of rows
is ever formed beyond the one that matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import q

#: Seconds of a time bucket; the result doesn't depend on it.
BUCKET_SECONDS = 7 * 86_400


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str],
               bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``left`` with the right side's ``values`` and ``right_time`` as of ``left_time`` (both timestamps).

    Rows without a match, a key or a time get nulls.  Of right rows with equal key and time the one
    whose values are largest counts, in the order given.
    """
    made = F.struct(F.col("_t").alias(right_time), *[F.col(f"_m.{v}").alias(v) for v in values])
    known = right.where(q(key).isNotNull() & q(right_time).isNotNull()) \
        .groupBy(q(key).alias("_k"), q(right_time).alias("_t")).agg(F.max(F.struct(*[q(v).alias(v) for v in values])).alias("_m")) \
        .select("_k", "_t", made.alias("_value"))
    asked = left.where(q(key).isNotNull() & q(left_time).isNotNull()).select(q(key).alias("_k"), q(left_time).alias("_t")).distinct()
    bucket = F.floor(F.unix_micros("_t") / F.lit(bucket_seconds * 1_000_000)).alias("_b")
    empty = F.lit(None).cast(known.schema["_value"].dataType)
    both = known.select("_k", "_t", bucket, "_value", F.lit(0).alias("_side")).unionByName(
        asked.select("_k", "_t", bucket, empty.alias("_value"), F.lit(1).alias("_side")))
    # inside a cell: the last value up to the row, a value of the same time included
    inside = Window.partitionBy("_k", "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    cells = both.withColumn("_last", F.last("_value", ignorenulls=True).over(inside)).where("_side = 1").select("_k", "_t", "_b", "_last")
    # between cells: one row a key and bucket, with the last value before it
    ends = both.groupBy("_k", "_b").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_t"))).alias("_end"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_k", "_b", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    found = cells.join(carried, ["_k", "_b"], "left").select("_k", "_t", F.coalesce("_last", "_carried").alias("_value"))
    kept = [c for c in left.columns if c not in (right_time, *values)]
    return left.join(found, (q(key) == F.col("_k")) & (q(left_time) == F.col("_t")), "left").select(
        *[q(c) for c in kept], *[F.col(f"_value.{c}").alias(c) for c in (right_time, *values)])


def labels_by_maturity(scores: DataFrame, labels: DataFrame, key: str, scored_at: str, score: str, labelled_at: str, label: str,
                       evaluated_at: Column, windows_days: Sequence[int]) -> DataFrame:
    """One row for each score and maturity window: the newest label that had arrived when the window ended, or at the evaluation
    if that came first.  ``matured`` says whether the window had ended by then.  Scores made after the evaluation take no part."""
    rows = scores.select(q(key), q(scored_at), q(score)).where(q(scored_at) <= evaluated_at) \
        .withColumn("window_days", F.explode(F.array(*[F.lit(int(d)) for d in windows_days])))
    end = q(scored_at) + F.make_dt_interval(F.col("window_days"))
    rows = rows.withColumn("matured", end <= evaluated_at).withColumn("_until", F.least(end, evaluated_at))
    return as_of_join(rows, labels, key, "_until", labelled_at, [label]).drop("_until")


def vintage_report(rows: DataFrame, scored_at: str, score: str, label: str, vintage: str = "month") -> DataFrame:
    """Per vintage (the period of the scoring) and maturity window: rows, those matured and labelled, the share not yet labelled,
    and of the labelled ones the positive rate, mean score, Brier score and the gap between score and rate."""
    y, s = q(label).cast("double"), q(score)
    known = y.isNotNull()
    out = rows.groupBy(F.date_trunc(vintage, q(scored_at)).cast("date").alias("vintage"), "window_days").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("matured").alias("matured_count"), F.count_if(known).alias("labelled_count"),
        F.sum(F.when(known, y)).alias("_pos"), F.sum(F.when(known, s)).alias("_score"), F.avg(F.when(known, (s - y) * (s - y))).alias("brier_score"))
    return out.select("vintage", "window_days", "row_count", "matured_count", "labelled_count",
                      (1.0 - F.col("labelled_count") / F.col("row_count")).alias("unlabelled_share"),
                      F.try_divide(F.col("_pos"), F.col("labelled_count")).alias("positive_rate"),
                      F.try_divide(F.col("_score"), F.col("labelled_count")).alias("mean_score"), "brier_score",
                      F.try_divide(F.col("_score") - F.col("_pos"), F.col("labelled_count")).alias("calibration_gap"))
