"""What the training-data operators share: staged tables, whole-batch text arrays, bounded samples, components.

Nothing here holds a whole column on the driver or in one task.  Staged
tables live in the shared checkpoint folder, so any executor can reread them
after another one is lost; results are lazy and read them, so nothing here
deletes them: whoever owns that folder clears it after the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import ensure_checkpoint_dir

#: Bytes of text that the Python tasks turn into arrays at once.
BLOCK_BYTES = 1 << 20
#: The most bytes of an Arrow batch that a Python task gets; a session's smaller setting stays.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that a task's memory doesn't follow the length of its texts.

    The setting stays on the session, as results are lazy and run later.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None) or ""
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives a lost executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_mod(column: str, m: int):
    """crc32 of an id written as text, modulo m (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def with_arrow_columns(df: DataFrame, inputs: list[str], compute: Callable, added: T.StructType) -> DataFrame:
    """All columns of ``df`` and those that ``compute`` makes of the input columns of one Arrow batch.

    A column of ``df`` named like an added one is replaced.
    """
    small_batches(df.sparkSession)
    names = added.fieldNames()
    source = df.select([F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(inputs)]
                       + [F.col(f"`{c}`") for c in df.columns if c not in names])
    kept = source.columns[len(inputs):]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(*batch.columns[:len(inputs)])
            yield pa.RecordBatch.from_arrays([*batch.columns[len(inputs):], *made], names=[*kept, *names])

    schema = T.StructType([*source.schema.fields[len(inputs):], *added.fields])
    return source.mapInArrow(run, schema)


def utf8_pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of an Arrow string column, each of about BLOCK_BYTES: (first row, row after the last, bytes, offsets).

    A null text counts as empty.  A text longer than a block is a run of its own.
    """
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_BYTES, "right")) - 1)
        yield first, last, whole[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def label_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of the key: the same rows on every run.

    One pass counts the labels, a second keeps a hash range of each label whose width follows its
    count.  ``per_label`` bounds what a model is fitted on.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    place = (F.xxhash64(F.col(key).cast("string")).bitwiseAND(F.lit((1 << 52) - 1))) / float(1 << 52)
    share = F.lit(0.0)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_label / n))).otherwise(share)
    return rows.where(place < share).limit(2 * per_label * len(counts))


def star_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates large and small stars; every round is two aggregates with map-side combine and two
    joins that Spark may split where a node has very many neighbours.  A node without an edge is absent.
    """
    now = staged(_downward(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(_downward(large), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.withColumnRenamed("m", "b"))
        now = staged(_downward(small), "small")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _downward(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
