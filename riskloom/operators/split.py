"""Exact stratified train / validation / test split.

Row order inside a class is a seeded hash order ``(md5(seed-key), key)``:
repeatable, independent of partitioning and expressible in plain SQL.
Per-class sizes follow the stratified-shuffle rules (test count
``ceil(size * n)``, per-class shares by largest remainder, train allocated
first).  Ties between equal remainders go to the lower class value.

Scale: the md5 prefix (``16^prefix_len`` buckets, uniform by construction)
cuts every class - even one holding most rows - into small cells.  Cell
counts give each cell its rank range; cells entirely inside one segment are
labelled without sorting, only the few cells that straddle a segment
boundary are ranked, in buckets of the hash however many rows they hold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import rules as R
from riskloom.functions.columns import q
from riskloom.functions.cumulative import BUCKET, running_totals

# FIXED VALUES
MSG_SIZES = "train_size + validation_size + test_size must equal 1.0."


class SplitConfig:
    """The fractions of train, validation and test, in this order; the seed of the hash order; whether to stratify."""

    def __init__(self, *fractions: float, seed: int = R.SPLIT_SEED, stratify: bool = True) -> None:
        self.train, self.validation, self.test = fractions or (R.SPLIT_TRAIN, R.SPLIT_VALIDATION, R.SPLIT_TEST)
        self.seed, self.stratify = seed, stratify
        if not math.isclose(math.fsum((self.train, self.validation, self.test)), 1.0, abs_tol=1e-9):
            raise ValueError(MSG_SIZES)


def _ceil_size(fraction: float, n: int) -> int:
    # round first: 0.15 / 0.85 * n must not become ceil(6.000000000000001) = 7
    return int(math.ceil(round(fraction * n, 9)))


def largest_remainders(counts: dict, draws: int) -> dict:
    """Largest-remainder allocation of ``draws`` over classes in proportion to ``counts``."""
    total = sum(counts.values())
    cont = {k: (v / total) * draws for k, v in counts.items()}
    out = {k: int(math.floor(c)) for k, c in cont.items()}
    need = draws - sum(out.values())
    for k in sorted(counts, key=lambda k: (-(cont[k] - math.floor(cont[k])), k))[:max(0, need)]:
        out[k] += 1
    return out


def split_quotas(class_counts: dict, config: SplitConfig, holdout_only: float | None = None) -> dict:
    """Per class: (test, validation, train) row counts."""
    n = sum(class_counts.values())
    if holdout_only is not None:  # P5: one holdout of the given fraction
        n_hold = _ceil_size(holdout_only, n)
        keep = largest_remainders(class_counts, n - n_hold)
        return {k: (class_counts[k] - keep[k], 0, keep[k]) for k in class_counts}
    n_test = _ceil_size(config.test, n)
    trval = largest_remainders(class_counts, n - n_test)
    m = n - n_test
    n_val = _ceil_size(config.validation / (config.train + config.validation), m)
    train = largest_remainders(trval, m - n_val)
    return {k: (class_counts[k] - trval[k], trval[k] - train[k], train[k]) for k in class_counts}


def hash_order(key: str, seed: int):
    return F.md5(F.concat(F.lit(str(seed)), F.lit("-"), q(key).cast("string")))


def assign_splits(df: DataFrame, key: str, target: str | None, config: SplitConfig = SplitConfig(),
                  split_col: str = "split", prefix_len: int = 3, holdout_only: float | None = None,
                  labels=("test", "validation", "train")) -> DataFrame:
    """Add ``split_col`` to every row; no row is lost.  ``target=None`` or ``stratify=False``
    means one stratum."""
    if not config.stratify or target is None:
        stratum = F.lit(0)
    else:
        stratum = q(target).cast("long")
    h = hash_order(key, config.seed)
    # The input is read twice (cell counts, then labels): keep it rather than recompute its lineage.
    base = df.withColumn("_stratum", stratum).withColumn("_h", h) \
        .withColumn("_cell", F.conv(F.substring("_h", 1, prefix_len), 16, 10).cast("int")).persist()
    cells = base.groupBy("_stratum", "_cell").agg(F.count(F.lit(1)).alias("_cnt")).persist()
    class_counts = {r["_stratum"]: r["n"] for r in cells.groupBy("_stratum").agg(F.sum("_cnt").alias("n")).collect()}
    if target is not None and config.stratify and None in class_counts:
        raise ValueError("Stratified split requires a target without missing values.")
    quotas = split_quotas(class_counts, config, holdout_only)
    spark = df.sparkSession
    qdf = spark.createDataFrame([(k, v[0], v[1]) for k, v in quotas.items()], "_stratum long, _q0 long, _q1 long")
    w = Window.partitionBy("_stratum").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_start", F.coalesce(F.sum("_cnt").over(w), F.lit(0))) \
        .withColumn("_end", F.col("_start") + F.col("_cnt")) \
        .join(F.broadcast(qdf.withColumn("_stratum", F.col("_stratum").cast(cells.schema["_stratum"].dataType))),
              on="_stratum")
    b1, b2 = F.col("_q0"), F.col("_q0") + F.col("_q1")

    def seg(rank):
        return F.when(rank < b1, F.lit(labels[0])).when(rank < b2, F.lit(labels[1])).otherwise(F.lit(labels[2]))

    cells = cells.withColumn("_boundary", (seg(F.col("_start")) != seg(F.col("_end") - 1))) \
        .withColumn("_label", seg(F.col("_start")))
    # cells: bounded by classes x 16^prefix_len rows -> broadcast.
    tagged = base.join(F.broadcast(cells.select("_stratum", "_cell", "_start", "_q0", "_q1", "_boundary", "_label")),
                       on=["_stratum", "_cell"])
    direct = tagged.where(~F.col("_boundary")).withColumn(split_col, F.col("_label"))
    # a cell across a boundary may hold many rows of a huge class: its running count is bucketed by the hash
    ranked = running_totals(tagged.where(F.col("_boundary")).withColumn("_one", F.lit(1)), "_h", ["_one"],
                            ["_stratum", "_cell"], with_totals=False, tiebreak=key)
    ranked = ranked.withColumn("_rank", F.col("_start") + F.col("cum__one") - 1).drop("_one", "cum__one", BUCKET)
    ranked = ranked.withColumn(split_col, seg(F.col("_rank"))).drop("_rank")
    out = direct.unionByName(ranked)
    return out.drop("_stratum", "_h", "_cell", "_start", "_q0", "_q1", "_boundary", "_label")


def split_metadata(df: DataFrame, target: str, split_col: str = "split") -> DataFrame:
    """Per partition rows, non-null targets, class counts and the positive rate over non-null."""
    t = q(target)
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(t).alias("non_null_count"),
        F.count_if(t == 1).alias("positive_count"), F.count_if(t == 0).alias("negative_count"),
        F.try_divide(F.count_if(t == 1), F.count(t)).alias("positive_rate"))


def split_oracle_sql(source_sql: str, key: str, target: str, config: SplitConfig = SplitConfig()) -> str:
    """The same split in plain SQL (window ranks over the whole class; fine for a small oracle)."""
    ts = repr(config.test)
    vs = repr(config.validation / (config.train + config.validation))
    seed = str(config.seed)
    return f"""
WITH base AS (
  SELECT *, md5(concat('{seed}', '-', CAST({key} AS VARCHAR))) AS _h FROM ({source_sql}) src
), cls AS (SELECT {target} AS k, count(*) AS cnt FROM base GROUP BY {target}
), l1 AS (
  SELECT k, cnt, n, n_draw, floor((cnt * 1.0 / n) * n_draw) AS fl,
         (cnt * 1.0 / n) * n_draw - floor((cnt * 1.0 / n) * n_draw) AS rem
  FROM (SELECT k, cnt, sum(cnt) OVER () AS n,
               sum(cnt) OVER () - CAST(ceil(round({ts} * sum(cnt) OVER (), 9)) AS BIGINT) AS n_draw FROM cls) x
), a1 AS (
  SELECT k, cnt, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, k) <= n_draw - sum(fl) OVER ()
                         THEN 1 ELSE 0 END AS BIGINT) AS trval
  FROM l1
), l2 AS (
  SELECT k, cnt, trval, m, n_draw, floor((trval * 1.0 / m) * n_draw) AS fl,
         (trval * 1.0 / m) * n_draw - floor((trval * 1.0 / m) * n_draw) AS rem
  FROM (SELECT k, cnt, trval, sum(trval) OVER () AS m,
               sum(trval) OVER () - CAST(ceil(round({vs} * sum(trval) OVER (), 9)) AS BIGINT) AS n_draw FROM a1) y
), quota AS (
  SELECT k, cnt - trval AS q_test,
         trval - CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, k) <= n_draw - sum(fl) OVER ()
                           THEN 1 ELSE 0 END AS BIGINT) AS q_val
  FROM l2
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.{target} ORDER BY b._h, b.{key}) - 1 AS _r FROM base b
)
SELECT r.* EXCLUDE (_h, _r),
       CASE WHEN r._r < q.q_test THEN 'test' WHEN r._r < q.q_test + q.q_val THEN 'validation' ELSE 'train' END AS split
FROM ranked r JOIN quota q ON r.{target} = q.k
"""
