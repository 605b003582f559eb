"""Exact global running sums and exact quantiles without a single-task window.

``Window.orderBy`` with no partition key sends every row to one task.  Here
the ordered table (one row per distinct value, so a hot value is one row) is
cut into buckets at approximate quantile points of the *whole* table, so
every (group, bucket) cell holds about ``n / buckets`` rows whatever the
group sizes are.  Bucket totals (bounded: groups x buckets rows) give each
bucket its starting offset; the running sum is then a window partitioned by
(group, bucket).  The result is exact; only the bucket boundaries are
approximate.  Small tables (``n <= rows_per_bucket``, checked with a count)
take the plain partitioned window.

Both ways give the same rows: null order values come first when ascending
(last when descending) and NaN the other way round, as in Spark's sort; text
order columns are bucketed by their bytes behind what all values share; null
groups are groups like any other.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 20_000
BUCKET = "_bucket"
#: The sketch that brackets quantiles is off by at most this part of the rows; with more probes all values are counted.
SKETCH_ACCURACY, SKETCHED_PROBES = 10_000, 32
#: Bracket ends and keys of the groups that are sent to all tasks, at most (some MB); more groups are joined by a shuffle.
BROADCAST_CELLS = 200_000


def bucketize(g: DataFrame, order_col: str, buckets: int) -> DataFrame:
    """``g`` with the number of the range of the order column (``BUCKET``) that a row lies in; ranges hold about equally many rows."""
    probs = [i / buckets for i in range(1, buckets)]
    with_double = g.withColumn("_order_d", _as_number(g, order_col))
    cuts = with_double.approxQuantile("_order_d", probs, 1.0 / (4 * buckets))
    splits = [-math.inf] + sorted({float(c) for c in cuts if c is not None and math.isfinite(c)}) + [math.inf]
    out = Bucketizer(splits=splits, inputCol="_order_d", outputCol=BUCKET, handleInvalid="keep").transform(with_double)
    # null has a bucket of its own before all others; NaN (kept by the Bucketizer) one behind them
    return out.drop("_order_d").withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(-1)))


def _as_number(g: DataFrame, order_col: str) -> Column:
    """A number that never falls as the order column rises.  Text: six bytes behind the prefix that all values share."""
    if not isinstance(g.schema[order_col].dataType, StringType):
        return F.col(order_col).cast("double")
    ends = g.agg(F.min(order_col), F.max(order_col)).first()
    shared = len(os.path.commonprefix([(x or "").encode() for x in ends]))
    part = F.substring(F.col(order_col).cast("binary"), shared + 1, 6)
    return F.conv(F.rpad(F.hex(part), 12, "0"), 16, 10).cast("double")


def running_totals(
    g: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    with_totals: bool = True,
    tiebreak: str | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order_col`` order within each group) and,
    when ``with_totals``, ``tot_<c>`` (group total) for every ``c`` in ``sum_cols``.

    ``g`` must have at most one row per (group, order value[, tiebreak]).  ``tiebreak``
    (ascending) orders rows of equal value; such rows always share a bucket.
    """
    group_cols = list(group_cols)
    order = [F.col(order_col).desc() if descending else F.col(order_col).asc()]
    if tiebreak:
        order.append(F.col(tiebreak).asc())
    g = g.persist()
    n = g.count()
    buckets = min(MAX_BUCKETS, max(1, math.ceil(n / max(1, rows_per_bucket))))

    if buckets == 1:
        # Proven small (n <= rows_per_bucket): a window per group is fine.
        w = Window.partitionBy(*group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = g
        for c in sum_cols:
            out = out.withColumn(f"cum_{c}", F.sum(c).over(w))
        if with_totals:
            wt = Window.partitionBy(*group_cols)
            for c in sum_cols:
                out = out.withColumn(f"tot_{c}", F.sum(c).over(wt))
        return out.withColumn(BUCKET, F.lit(0))

    b = bucketize(g, order_col, buckets)
    keys = group_cols + [BUCKET]
    totals = b.groupBy(*keys).agg(*[F.sum(c).alias(f"_bt_{c}") for c in sum_cols])
    border = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    wb = Window.partitionBy(*group_cols).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*group_cols)
    offsets = totals
    for c in sum_cols:
        offsets = offsets.withColumn(f"_off_{c}", F.coalesce(F.sum(f"_bt_{c}").over(wb), F.lit(0)))
        if with_totals:
            offsets = offsets.withColumn(f"tot_{c}", F.sum(f"_bt_{c}").over(wg))
    offsets = offsets.drop(*[f"_bt_{c}" for c in sum_cols]).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]  # the planner chooses the join by size
    joined = b.join(offsets, on=same, how="inner").drop(*[f"_key_{k}" for k in keys])
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.sum(c).over(w) + F.col(f"_off_{c}"))
    made = [f"cum_{c}" for c in sum_cols] + ([f"tot_{c}" for c in sum_cols] if with_totals else [])
    return out.select(*g.columns, *made, BUCKET)  # as the plain way


def value_counts(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (group, non-null value) with its multiplicity ``_n`` (map-side combined)."""
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_n")))


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``linear`` / SQL ``quantile_cont``).

    Returns one row per (group, prob index): ``group..., q_index, q, quantile``.
    Position ``h = (n - 1) * q``; value ``v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h)``.

    A mergeable sketch of each group brackets every probe; one more pass counts the values below
    each bracket and keeps only those inside, so what is shuffled and ordered is the brackets'
    share of the rows (``8 / accuracy`` a probe).  The brackets are checked against the counts, and
    where one misses its ranks all values are counted instead, so the result is always exact.
    Groups of fewer than ``10 * accuracy`` rows, and many probes (``SKETCHED_PROBES``), are counted
    whole: their brackets would hold most values.
    """
    group_cols = list(group_cols)
    if len(probs) > SKETCHED_PROBES:
        return _counted_quantiles(df, value_col, probs, group_cols, rows_per_bucket)
    inside = _bracketed_values(df, value_col, probs, group_cols, accuracy).persist()
    missed = inside.groupBy(*group_cols, "_i").agg(F.max("_below").alias("below"), F.sum("_n").alias("n"), F.max("_total").alias("total"))
    h = (F.col("total") - 1) * F.element_at(F.array(*[F.lit(float(x)) for x in probs]), F.greatest("_i", F.lit(0)) + 1)
    outside = (F.floor(h) < F.col("below")) | (F.ceil(h) >= F.col("below") + F.col("n"))
    expected = inside.select(*group_cols).distinct().count() if group_cols else 1
    wrong = missed.agg(F.count_if((F.col("_i") >= 0) & outside).alias("wrong"), F.count_if(F.col("_i") >= 0).alias("probes"),
                       F.count_if(F.col("_i") < 0).alias("whole")).first()
    if wrong["wrong"] or wrong["probes"] + len(probs) * wrong["whole"] < len(probs) * (expected if wrong["probes"] + wrong["whole"] else 0):
        return _counted_quantiles(df, value_col, probs, group_cols, rows_per_bucket)
    keys = [*group_cols, "_i"]
    rt = running_totals(inside.select(*keys, "_v", "_n", "_below", "_total"), "_v", ["_n"], keys, rows_per_bucket=rows_per_bucket,
                        with_totals=False)
    rt = rt.withColumn("cum__n", F.col("cum__n") + F.col("_below")).withColumn("tot__n", F.col("_total"))
    own = F.when(F.col("_i") >= 0, F.array("_i")).otherwise(F.sequence(F.lit(0), F.lit(len(probs) - 1)))
    return _at_positions(rt, "_v", probs, group_cols, own)


def _bracketed_values(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str], accuracy: int) -> DataFrame:
    """(group..., _i, _v, _n, _below, _total): the distinct values inside probe _i's bracket with their multiplicity, the number of
    values below that bracket, and the group's size.  Groups that are counted whole have all values under _i = -1."""
    rows = df.where(F.col(value_col).isNotNull()).select(*group_cols, F.col(value_col).cast("double").alias("_v"))
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    margin = 4.0 / accuracy
    lows, highs = [probs[i] - margin for i in order], [probs[i] + margin for i in order]
    asked = sorted({x for x in (*lows, *highs) if 0 < x < 1})
    at = {x: F.element_at("_s", i + 1) for i, x in enumerate(asked)}
    sketch = [F.percentile_approx("_v", asked, accuracy).alias("_s")] if asked else [F.array().cast("array<double>").alias("_s")]
    groups = rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_total"), *sketch)
    # NaN is the largest value of Spark's order
    groups = groups.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], "_total", *[
        F.when(F.col("_total") >= 10 * accuracy, at.get(x, F.lit(end))).alias(f"{name}{i}")
        for name, bounds, end in (("_lo", lows, float("-inf")), ("_hi", highs, float("nan"))) for i, x in enumerate(bounds)])
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group_cols)]
    if same:
        # counted before the join: Spark learns how many groups there are before it would shuffle every value to join them
        groups = groups.persist()
        if groups.count() * (2 * len(probs) + len(same)) <= BROADCAST_CELLS:
            groups = F.broadcast(groups)
    joined = rows.join(groups, on=same, how="inner") if same else rows.crossJoin(F.broadcast(groups))  # one row
    # bracket i holds a value if i < slot (brackets whose low end isn't above it) and i >= passed (brackets whose high end is below it):
    # both ends rise with i.  A row is one key, whatever number of brackets hold it, and the ends are plain columns: a longer expression
    # (ends read from arrays, an array of places for every row) makes a method that Java no longer compiles, some 40 us a row.
    # Both numbers are null for groups that are counted whole.
    slot, passed = (reduce(add, [test(F.col(f"{name}{i}")).cast("int") for i in range(len(probs))], F.lit(0)) for name, test in (
        ("_lo", lambda low: low <= F.col("_v")), ("_hi", lambda high: high < F.col("_v"))))
    cells = joined.select(*group_cols, "_total", slot.alias("_slot"), passed.alias("_passed"), "_v") \
        .withColumn("_v", F.when(F.col("_slot") <= F.col("_passed"), F.lit(None)).otherwise(F.col("_v"))) \
        .groupBy(*group_cols, "_total", "_slot", "_passed", "_v").agg(F.count(F.lit(1)).alias("_n"))
    places = F.when(F.col("_slot").isNull(), F.array(F.lit(-1))).when(
        F.col("_slot") > F.col("_passed"), F.concat(F.array(-2 - F.col("_slot")), F.sequence("_passed", F.col("_slot") - 1))).otherwise(
        F.array(-2 - F.col("_slot")))
    counted = cells.select(*group_cols, "_total", F.explode(places).alias("_place"), "_v", "_n") \
        .withColumn("_v", F.when(F.col("_place") >= -1, F.col("_v"))) \
        .groupBy(*group_cols, "_total", "_place", "_v").agg(F.sum("_n").alias("_n")).persist()
    # rows of slot s lie below the brackets s, s + 1, ...: a group has at most as many slots as probes, and one more
    slots = counted.where("_place < -1").groupBy(*group_cols).agg(F.collect_list(F.struct((-2 - F.col("_place")).alias("s"), "_n")).alias("_slots"))
    slots = slots.withColumnsRenamed({c: f"_g{i}" for i, c in enumerate(group_cols)})
    values = counted.where("_place >= -1")
    out = values.join(slots, on=same, how="left") if same else values.join(F.broadcast(slots), how="left")
    below = F.aggregate(F.filter(F.coalesce("_slots", F.array().cast(slots.schema["_slots"].dataType)), lambda x: x["s"] <= F.col("_place")),
                        F.lit(0).cast("long"), lambda acc, x: acc + x["_n"])
    number = F.element_at(F.array(*[F.lit(i) for i in order]), F.greatest("_place", F.lit(0)) + 1)
    return out.select(*group_cols, F.when(F.col("_place") >= 0, number).otherwise(-1).alias("_i"), "_v", "_n",
                      F.when(F.col("_place") >= 0, below).otherwise(0).cast("long").alias("_below"), "_total")


def _counted_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """The quantiles from the running counts of all distinct values.

    Every distinct value carries its rank range ``[before, cum)`` and its group
    size, so the (bounded) list of probe ranks is tested row by row: no join.
    """
    group_cols = list(group_cols)
    vc = value_counts(df, value_col, group_cols)
    rt = running_totals(vc, value_col, ["_n"], group_cols, rows_per_bucket=rows_per_bucket)
    before = F.col("cum__n") - F.col("_n")
    last = (F.col("tot__n") - 1).cast("double")
    plist = F.array(*[F.lit(float(p)) for p in probs])  # a constant: folded, not per-row code
    # A distinct value holding ranks [before, cum) serves probe i when its position h_i = last * p_i
    # lies in (before - 1, cum).  With sorted probes those i are one contiguous range [a, b).
    ordered = list(probs) == sorted(probs)
    if ordered:
        a = F.size(F.filter(plist, lambda p: last * p <= before - 1))
        b = F.size(F.filter(plist, lambda p: last * p < F.col("cum__n")))
        idx = F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))
    else:
        idx = F.sequence(F.lit(0), F.lit(len(probs) - 1))
    return _at_positions(rt, value_col, probs, group_cols, idx)


def _at_positions(rt: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str], idx: Column) -> DataFrame:
    """The quantiles from values with running counts, each of which is asked for the probes ``idx``."""
    before = F.col("cum__n") - F.col("_n")
    last = (F.col("tot__n") - 1).cast("double")
    plist = F.array(*[F.lit(float(p)) for p in probs])
    hits = rt.select(*group_cols, F.col(value_col).cast("double").alias("_v"), before.alias("_before"),
                     F.col("cum__n"), last.alias("_last"), F.explode(idx).alias("_i"))
    p_i = F.element_at(plist, F.col("_i") + 1)
    hits = hits.withColumn("_q", p_i).withColumn("_h", F.col("_last") * F.col("_q"))
    in_range = lambda r: (r >= F.col("_before")) & (r < F.col("cum__n"))
    hits = hits.withColumn("_lo_hit", in_range(F.floor("_h"))).withColumn("_hi_hit", in_range(F.ceil("_h"))) \
        .where(F.col("_lo_hit") | F.col("_hi_hit")) \
        .select(*group_cols, "_v", "_lo_hit", "_hi_hit",
                F.struct(F.col("_i").alias("q_index"), F.col("_q").alias("q"), F.col("_h").alias("h"),
                         F.lit(0).alias("side")).alias("p"))
    res = hits.groupBy(*group_cols, F.col("p.q_index").alias("q_index"), F.col("p.q").alias("q"),
                       F.col("p.h").alias("_h")).agg(
        F.max(F.when(F.col("_lo_hit"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_hi_hit"), F.col("_v"))).alias("_vhi"))
    return res.select(*group_cols, "q_index", "q",
                      (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_h") - F.floor("_h")))
                      .alias("quantile"))
