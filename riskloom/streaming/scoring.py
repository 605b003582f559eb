"""Streaming batch scoring.

The reference excludes streaming scoring, but its row rules (B2-B6) are
stateless column expressions, so the very same functions run on a
``readStream`` source unchanged.  Bad rows go to their own sink instead of
rejecting a never-ending input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.operators import scoring as B
from riskloom.rules import CreditColumns


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_uploads(spark: SparkSession, folder: str, columns: list[str], fmt: str = "csv") -> DataFrame:
    """Files arriving in ``folder`` (all columns as text, as uploads are)."""
    reader = spark.readStream.schema(text_schema(columns))
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(folder)


def score_stream(stream: DataFrame, cols: CreditColumns, score_fn: Callable[[DataFrame], Column],
                 f1_threshold: float, cost_threshold: float, source: str) -> tuple[DataFrame, DataFrame]:
    """(scored rows, rejected rows with their message) as two streaming DataFrames."""
    norm = B.normalize_batch(stream, cols)
    good = norm.where(F.col("row_error").isNull())
    bad = norm.where(F.col("row_error").isNotNull()).select(*stream.columns, F.col("row_error").alias("message"))
    return B.enrich(good, score_fn(good), f1_threshold, cost_threshold, source, stream.columns), bad


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """Append to a file sink with a checkpoint in the shared folder (restart-safe, exactly-once files)."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
