"""Profiling (E1-E10) as a few grouped aggregates over a long (column, value) view.

Exact percentiles use ``exact_quantiles`` (distributed running counts over
the distinct values of each column); moments are one wide aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.columns import nan_to_null, numeric_columns, q, stack
from riskloom.functions.cumulative import exact_quantiles
from riskloom.rules import CreditColumns

SUMMARY_PERCENTILES = (0.01, 0.05, 0.5, 0.95, 0.99)
EXTREME_PERCENTILES = (0.25, 0.75, 0.99)


def shape(df: DataFrame) -> DataFrame:
    """E1 + E2: rows, columns and duplicate rows (rows beyond the first of each identical group;
    missing equals missing, as grouping treats nulls as equal).  Partial aggregation keeps a
    hot duplicate group to one row per task before the shuffle."""
    dup = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return dup.agg(F.sum("_n").cast("long").alias("row_count"),
                   F.lit(len(df.columns)).cast("long").alias("column_count"),
                   F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_row_count"))


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """Counts per class including the null class; rate over all rows."""
    per = df.groupBy(q(target).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()  # per-class table: bounded by the number of classes
    total = F.sum("count").over(w)
    positive = F.sum(F.when(F.col("value") == 1, F.col("count")).otherwise(0)).over(w)
    negative = F.sum(F.when(F.col("value") == 0, F.col("count")).otherwise(0)).over(w)
    return per.select("value", F.col("count").cast("long").alias("count"),
                      positive.cast("long").alias("positive_count"), negative.cast("long").alias("negative_count"),
                      (positive / total).alias("positive_rate"))


def missingness(df: DataFrame) -> DataFrame:
    """Columns with missing values, count and rate over all rows (order: count desc, name)."""
    names = list(df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(nan_to_null(q(c)).isNull() if _is_float(df, c) else q(c).isNull()).alias(f"m{i}")
                   for i, c in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").cast("long").alias("missing_count"))
                      for i, c in enumerate(names)])
    out = agg.select("_rows", F.inline(pairs)).where(F.col("missing_count") > 0)
    return out.select("column", "missing_count", F.try_divide(F.col("missing_count"), F.col("_rows")).alias("missing_rate"))


def _is_float(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def _cells(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """(the stacked cells, their quantiles).  Several aggregates read the cells: they are kept instead of recomputing the input."""
    long = stack(df, columns).persist()
    return long, exact_quantiles(long, "value", list(probs), ["column"])


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, percentiles: Sequence[float] = SUMMARY_PERCENTILES,
                    cells: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """E5: count, mean, sample std, min, percentiles, max per numeric column, rounded to 6.

    ``cells`` are ``_cells`` of at least these columns and percentiles, where a report shares them."""
    columns = list(columns or numeric_columns(df))
    long, qs = cells or _cells(df, columns, percentiles)
    long = long.where(F.col("column").isin(columns))
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    wide = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == p, F.col("quantile"))).alias(_pname(p)) for p in percentiles])
    out = moments.join(wide, on="column", how="left")
    cols = ["count", "mean", "std", "min", *[_pname(p) for p in percentiles], "max"]
    return out.select("column", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in cols])


def _pname(p: float) -> str:
    return f"p{round(p * 100):d}" if abs(p * 100 - round(p * 100)) < 1e-9 else f"p{p * 100:g}".replace(".", "_")


def extreme_values(df: DataFrame, exclude: Sequence[str], columns: Sequence[str] | None = None,
                   cells: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """IQR fences (linear Q1/Q3, strict outside) per numeric column over non-null values.

    ``cells`` as in ``numeric_summary``, with ``EXTREME_PERCENTILES``."""
    columns = [c for c in (columns or numeric_columns(df)) if c not in set(exclude)]
    long, qs = cells or _cells(df, columns, EXTREME_PERCENTILES)
    long = long.where(F.col("value").isNotNull() & F.col("column").isin(columns))
    bounds = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == p, F.col("quantile"))).alias(name)
                                        for name, p in zip(("q1", "q3", "p99"), EXTREME_PERCENTILES)])
    bounds = bounds.withColumn("_iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower_bound", F.col("q1") - F.lit(1.5) * F.col("_iqr")) \
        .withColumn("upper_bound", F.col("q3") + F.lit(1.5) * F.col("_iqr"))
    # bounds has one row per column: a proven-small broadcast.
    tagged = long.join(F.broadcast(bounds), on="column", how="inner")
    out = tagged.groupBy("column").agg(
        F.min("value").alias("min"), F.max("p99").alias("p99"), F.max("value").alias("max"),
        F.count_if((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
        .alias("iqr_outlier_count"), F.count(F.lit(1)).alias("_n"))
    return out.select("column", "min", "p99", "max", F.col("iqr_outlier_count").cast("long"),
                      (F.col("iqr_outlier_count") / F.col("_n")).alias("iqr_outlier_rate"))


def suspicious_values(df: DataFrame, cols: CreditColumns) -> DataFrame:
    """Like the warning rules plus age <= 0 and delinquency > 50; here missing income and
    dependents count as 0 (so missing income is 'non-positive')."""
    aggs = [
        F.count_if(q(cols.age) <= 0).alias("age_non_positive_count"),
        F.count_if(q(cols.age) < R.AGE_MIN).alias("age_below_18_count"),
        F.count_if(q(cols.age) > R.AGE_MAX).alias("age_above_100_count"),
        F.count_if(q(cols.utilization) > 1).alias("revolving_utilization_above_1_count"),
        F.count_if(q(cols.debt_ratio) > 5).alias("debt_ratio_above_5_count"),
        F.count_if(F.coalesce(nan_to_null(q(cols.income)), F.lit(0.0)) <= 0).alias("monthly_income_non_positive_count"),
        F.count_if(F.coalesce(nan_to_null(q(cols.dependents)), F.lit(0.0)) < 0).alias("dependents_negative_count"),
    ]
    for c in cols.delinquency:
        aggs.append(F.count_if(q(c) > R.DELINQUENCY_MAX).alias(f"{c}_above_20_count"))
        aggs.append(F.count_if(q(c) > R.DELINQUENCY_EXTREME).alias(f"{c}_above_50_count"))
    return df.agg(*aggs)


def full_summary(df: DataFrame, cols: CreditColumns) -> DataFrame:
    """E1-E7 as one long table (section, item, statistic, value).  ``item`` is the column, the
    class value of the target (null for missing targets), or null where the whole table is meant.
    Duplicates are counted without the id, which would make every row differ.
    The parts read the rows one after another, and two of them their cells and quantiles: both are made once."""
    df = df.persist()
    cells = _cells(df, numeric_columns(df), sorted({*SUMMARY_PERCENTILES, *EXTREME_PERCENTILES}))
    parts = [
        _as_long(shape(df.drop(cols.id)), "shape"),
        _as_long(target_counts(df, cols.target), "target", "value"),
        _as_long(missingness(df), "missingness", "column"),
        _as_long(numeric_summary(df, cells=cells), "numeric", "column"),
        _as_long(extreme_values(df, exclude=[cols.id, cols.target], cells=cells), "extremes", "column"),
        _as_long(suspicious_values(df, cols), "suspicious"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _as_long(table: DataFrame, section: str, item: str | None = None) -> DataFrame:
    """One row for each cell of a wide report table."""
    cells = F.array(*[F.struct(F.lit(c).alias("statistic"), q(c).cast("double").alias("value"))
                      for c in table.columns if c != item])
    name = q(item).cast("string") if item else F.lit(None).cast("string")
    return table.select(F.lit(section).alias("section"), name.alias("item"), F.inline(cells))


def histogram(df: DataFrame, columns: Sequence[str], bins: int | dict[str, int] = 40) -> DataFrame:
    """Per column, drop missing, clip at the exact p99, equal-width bins over [min, p99]
    with the last bin closed (numpy's edge rules).  Output (column, bin, bin_left, bin_right, count)."""
    long = stack(df, columns).where(F.col("value").isNotNull()).persist()
    p99 = exact_quantiles(long, "value", [0.99], ["column"]).select("column", F.col("quantile").alias("_p99"))
    nb = bins if isinstance(bins, dict) else {c: bins for c in columns}
    nbins = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(int(nb[c])))])
    clipped = long.join(F.broadcast(p99), on="column").withColumn("_x", F.least("value", "_p99")) \
        .withColumn("_nb", nbins[F.col("column")])
    rng = clipped.groupBy("column").agg(F.min("_x").alias("_lo0"), F.max("_x").alias("_hi0"))
    rng = rng.withColumn("_lo", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0"))) \
             .withColumn("_hi", F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")))
    x = clipped.join(F.broadcast(rng.select("column", "_lo", "_hi")), on="column")
    step = (F.col("_hi") - F.col("_lo")) / F.col("_nb")

    def edge(i):
        return F.when(i >= F.col("_nb"), F.col("_hi")).otherwise(i * step + F.col("_lo"))

    norm = F.col("_nb") / (F.col("_hi") - F.col("_lo"))
    i0 = F.floor((F.col("_x") - F.col("_lo")) * norm)
    i0 = F.when(i0 >= F.col("_nb"), F.col("_nb") - 1).otherwise(i0)
    x = x.withColumn("_i", i0)
    x = x.withColumn("_i", F.when(F.col("_x") < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    x = x.withColumn("_i", F.when((F.col("_x") >= edge(F.col("_i") + 1)) & (F.col("_i") != F.col("_nb") - 1),
                                  F.col("_i") + 1).otherwise(F.col("_i")))
    counts = x.groupBy("column", F.col("_i").cast("int").alias("bin"), "_lo", "_hi", "_nb") \
        .agg(F.count(F.lit(1)).alias("count"))
    return counts.select("column", "bin", edge(F.col("bin")).alias("bin_left"),
                         edge(F.col("bin") + 1).alias("bin_right"), F.col("count").cast("long"))
