"""The derived ``cases`` relation: one credit case per order.

The driver's tables carry no credit data, so the credit operators run on a
relation derived from ``orders``, ``customer`` and ``lineitem`` (grain: one
order).  Line items are pre-aggregated per order before the join, so the
join never sees more than one row per order on the right side; the distinct
supplier count is planned by Spark as a two-level aggregate keyed by
``(order, supplier)`` first, so a hot order is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.rules import CASES_COLUMNS
from riskloom.sources.tables import read_table

# Case-building constants (fixed by the blueprint of the cases relation).
UTILIZATION_SCALE = 400000.0
AGE_BASE, AGE_SPAN = 16, 95
EXTREME_EVERY, EXTREME_ADD = 557, 98
INCOME_NULL_EVERY, INCOME_ZERO_EVERY = 5, 91
DEPENDENTS_NULL_EVERY = 38


def line_summary(lineitem: DataFrame) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(flag == "R").alias("n_returned"),
        F.count_if(flag == "A").alias("n_accepted"),
        F.count_if((flag == "N") & (status == "O")).alias("n_open"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
        F.max("l_linenumber").alias("max_line"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
    )


def build_cases(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    extreme = F.when(key % EXTREME_EVERY == 0, F.lit(EXTREME_ADD)).otherwise(F.lit(0)).cast("long")

    def count_or_zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("long")

    # Orders are hash-partitioned by the order key: the exchange a sort-merge join with the per-order
    # line summary needs anyway (the summary is already partitioned by the same key), so it adds no
    # shuffle at scale, and it gives small single-file inputs their parallelism.  Customers join last
    # (broadcast when small, else one shuffle by customer key).
    joined = (
        orders.select("o_orderkey", "o_custkey", "o_totalprice").repartition(key)
        .join(line_summary(lineitem), key == F.col("l_orderkey"), "left")
        .join(customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    )
    c = CASES_COLUMNS
    return joined.select(
        key.alias(c.id),
        (F.col("c_acctbal") < 0).cast("int").alias(c.target),
        (F.col("o_totalprice") / F.lit(UTILIZATION_SCALE)).alias(c.utilization),
        (F.lit(AGE_BASE) + (F.col("o_custkey") * 7 + key) % AGE_SPAN).cast("long").alias(c.age),
        (count_or_zero("n_returned") + extreme).alias(c.late_30_59),
        (F.coalesce(F.col("discount_amount"), F.lit(0.0)) / F.col("o_totalprice")).alias(c.debt_ratio),
        F.when(key % INCOME_NULL_EVERY == 0, F.lit(None).cast("double"))
        .when(key % INCOME_ZERO_EVERY == 0, F.lit(0.0))
        .otherwise(F.abs(F.col("c_acctbal"))).alias(c.income),
        count_or_zero("n_lines").alias(c.open_lines),
        (count_or_zero("n_accepted") + extreme).alias(c.late_90),
        count_or_zero("n_suppliers").alias(c.real_estate),
        (count_or_zero("n_open") + extreme).alias(c.late_60_89),
        F.when(key % DEPENDENTS_NULL_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.coalesce(F.col("max_line"), F.lit(0)).cast("double")).alias(c.dependents),
    )


def load_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_cases(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                       read_table(spark, sf_dir, "lineitem"))


def fixed_score(utilization: str = "utilization", income: str = "income") -> Column:
    """Deterministic score in [0, 1] with many ties, so metric operators have an exact SQL oracle."""
    raw = F.lit(0.3) * F.col(utilization) + F.when(F.col(income) < 1000, F.lit(0.5)).otherwise(F.lit(0.0))
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))
    # floor(x*1000 + 0.5) / 1000 is the same IEEE arithmetic in every engine (round() is not).
    return (F.floor(clipped * F.lit(1000.0) + F.lit(0.5)) / F.lit(1000.0)).cast("double")


CASES_SQL = """
WITH li AS (
  SELECT l_orderkey,
         count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned,
         sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS n_accepted,
         sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS n_open,
         count(DISTINCT l_suppkey) AS n_suppliers,
         max(l_linenumber) AS max_line,
         sum(l_extendedprice * l_discount) AS discount_amount
  FROM lineitem GROUP BY l_orderkey
)
SELECT o.o_orderkey AS case_id,
       CAST(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS INTEGER) AS target,
       o.o_totalprice / 400000.0 AS utilization,
       CAST(16 + (o.o_custkey * 7 + o.o_orderkey) % 95 AS BIGINT) AS age,
       CAST(coalesce(li.n_returned, 0) + CASE WHEN o.o_orderkey % 557 = 0 THEN 98 ELSE 0 END AS BIGINT) AS late_30_59,
       coalesce(li.discount_amount, 0.0) / o.o_totalprice AS debt_ratio,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL WHEN o.o_orderkey % 91 = 0 THEN 0.0
            ELSE abs(c.c_acctbal) END AS income,
       CAST(coalesce(li.n_lines, 0) AS BIGINT) AS open_lines,
       CAST(coalesce(li.n_accepted, 0) + CASE WHEN o.o_orderkey % 557 = 0 THEN 98 ELSE 0 END AS BIGINT) AS late_90,
       CAST(coalesce(li.n_suppliers, 0) AS BIGINT) AS real_estate,
       CAST(coalesce(li.n_open, 0) + CASE WHEN o.o_orderkey % 557 = 0 THEN 98 ELSE 0 END AS BIGINT) AS late_60_89,
       CASE WHEN o.o_orderkey % 38 = 0 THEN NULL ELSE CAST(coalesce(li.max_line, 0) AS DOUBLE) END AS dependents
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN li ON li.l_orderkey = o.o_orderkey
"""

FIXED_SCORE_SQL = ("CAST(floor(least(1.0, greatest(0.0, 0.3 * utilization + "
                   "CASE WHEN income < 1000 THEN 0.5 ELSE 0.0 END)) * 1000.0 + 0.5) / 1000.0 AS DOUBLE)")
