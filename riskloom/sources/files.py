"""Sources and sinks (S1-S11) with contracts.

Files are read as text columns first (so a contract decides types, as the
reference's reader did) and cast with ``try_cast``; nothing is parsed on the
driver.  All paths may be on any Hadoop-compatible file system; existence
checks use the Hadoop FileSystem of the session.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions.columns import q
from riskloom.operators import quality as V
from riskloom.operators.contracts import SourceContract, contracts_for, read_as, repeated_columns
from riskloom.rules import CreditColumns

MSG_EMPTY_UPLOAD = "Uploaded file is empty."


def path_exists(spark: SparkSession, path: str) -> bool:
    """V14 on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The raw header (V2 must see duplicates before the CSV reader renames them), split by the reader's own quoting rules."""
    first = spark.read.option("header", False).option("ignoreLeadingWhiteSpace", True).option(
        "ignoreTrailingWhiteSpace", True).csv(path).limit(1).collect()
    return [c or "" for c in first[0]] if first else []


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, in header order; an empty file is an error, as is a file of a folder with another header."""
    header = csv_header(spark, path)
    if not header:
        raise ValueError(MSG_EMPTY_UPLOAD)
    repeated = repeated_columns(header)
    if repeated:
        raise ValueError(V.R.MSG_DUPLICATE_COLUMNS + f" {repeated}")
    schema = StructType([StructField(c, StringType(), True) for c in header])
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def typed(df: DataFrame, cols: CreditColumns) -> DataFrame:
    """Text columns by the contract's types (id and counts long, target int, amounts and ratios double); others as they are.

    Missing and unreadable values are null: ``load_validated`` looks at the text first, so there none is unreadable.
    """
    wanted = {f.name: f.dataType for f in contracts_for(cols)["train"].schema}
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[read_as(c, kinds[c], wanted[c]).alias(c) if c in wanted else q(c) for c in df.columns])


def load_validated(spark: SparkSession, path: str, contract: SourceContract, cols: CreditColumns,
                   fmt: str = "csv") -> DataFrame:
    """S1/S3 + V16: read, validate what was read (a CSV's text) against the contract, fail on errors, return typed rows."""
    readers = {"csv": lambda: read_text_csv(spark, path), "parquet": lambda: spark.read.parquet(path),
               "table": lambda: spark.table(path)}
    if fmt not in readers:
        raise ValueError(f"Unsupported source format: {fmt}")
    raw = readers[fmt]()
    V.raise_on_errors(V.validation_messages(raw, contract, cols))
    return typed(raw, cols)


def load_optional(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame | None:
    """An optional source that is absent gives ``None``."""
    if not path_exists(spark, path):
        return None
    return read_text_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def source(spark: SparkSession, spec: Mapping) -> DataFrame:
    """One entry point for every backend: {"format": csv|parquet|table|jdbc, "location": ..., "options": {}}."""
    fmt = spec["format"]
    if fmt == "table":
        return spark.table(spec["location"])
    if fmt == "csv":
        return read_text_csv(spark, spec["location"])
    reader = spark.read.format(fmt)
    for k, v in (spec.get("options") or {}).items():
        reader = reader.option(k, v)
    return reader.load(spec["location"]) if spec.get("location") else reader.load()


def with_lineage(df: DataFrame, file_col: bool = True, ingestion_id: str | None = None) -> DataFrame:
    """RAW lineage columns - ingestion id, source file name, row fingerprint, ingested-at."""
    out = df
    if file_col:
        out = out.withColumn("source_file_name", F.col("_metadata.file_name"))
    return out.withColumn("raw_ingestion_id", F.lit(ingestion_id or uuid.uuid4().hex)) \
        .withColumn("row_fingerprint", F.xxhash64(*[q(c) for c in df.columns])) \
        .withColumn("ingested_at_utc", F.current_timestamp())


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A report table is small (bounded by rules / thresholds / models): one file is fine."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def write_json_document(spark: SparkSession, payload: Mapping, path: str) -> None:
    """A metadata sidecar (feature schema, split metadata, run summary) through Spark's writer."""
    spark.createDataFrame([(json.dumps(payload, default=str),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_json_document(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).collect()
    return json.loads("".join(r[0] for r in rows))


def write_scored_csv(df: DataFrame, path: str) -> None:
    """All input columns + score columns, with a header, no index (partitioned files)."""
    df.write.mode("overwrite").option("header", True).csv(path)
