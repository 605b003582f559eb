"""Shared building blocks of the registered queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from riskloom.operators.split import SplitConfig, assign_splits
from riskloom.rules import CASES_COLUMNS
from riskloom.sources.cases import fixed_score, load_cases

C = CASES_COLUMNS


def rnd6(c):
    """floor(x * 1e6 + 0.5) / 1e6 - identical IEEE steps in Spark and in the SQL oracle."""
    x = c.cast("double")
    return F.when(F.abs(x) < 1e12, F.floor(x * 1000000.0 + 0.5) / 1000000.0).otherwise(x)


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every floating column so engines agree beyond summation-order noise."""
    return df.select(*[rnd6(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_cases(spark, sf_dir)


def split_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_splits(cases(spark, sf_dir), C.id, C.target, SplitConfig())


def scored_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, target, split, score) with the fixed, engine-independent score.  Four narrow
    columns read by several actions downstream (grid, sweep, read-out): kept, not recomputed."""
    return split_cases(spark, sf_dir).select(C.id, C.target, "split", fixed_score().alias("score")).persist()
