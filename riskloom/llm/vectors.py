"""Vectors as packed doubles, and the grid of row chunks and query blocks on which the searches run."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import staged

#: Rows of a chunk of candidates, and of a block of queries: what one task holds.
CHUNK, BLOCK = 8192, 2048

PACKED = "vec_id long, dim int, raw binary"
#: What a search returns of each pair: the rows of the query and the candidate, their ids, the score.
PAIR = "query long, query_id long, row long, vec_id long, score "


def finite(vector: str) -> Column:
    """Whether the vector is there, has a component, and all of them are finite numbers."""
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def packed(rows: DataFrame, key: str, vector: Column) -> DataFrame:
    """(row, vec_id, dim, raw): every row's vector of doubles as bytes, under a number of its own; written to the shared folder.

    Rows that share an id stay rows of their own.  Rows without an id are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v, np.float64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(r) // 8 for r in raw], pa.int32()),
                                              pa.array(raw, pa.binary())], names=["vec_id", "dim", "raw"])

    made = rows.select(F.col(key).cast("long").alias("vec_id"), vector.cast("array<double>").alias("v")).where("vec_id is not null")
    return staged(made.mapInArrow(run, PACKED).select(F.monotonically_increasing_id().alias("row"), "vec_id", "dim", "raw"), "vectors")


def matrix(frame: pd.DataFrame) -> np.ndarray:
    """The packed vectors of rows of one dimension."""
    return np.frombuffer(b"".join(frame["raw"]), np.float64).reshape(len(frame), -1) if len(frame) else np.zeros((0, 0))


def parts_of(n: int, size: int) -> int:
    return max(1, math.ceil(n / size))


def dealt(rows: DataFrame, cells: int, seed: int) -> Column:
    """The part, of ``cells``, that a row falls into."""
    return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(cells)).cast("int")


def on_grid(candidates: DataFrame, queries: DataFrame, keys: list[str], search: Callable, schema: str) -> DataFrame:
    """``search(candidates, queries)`` on every cell that has both; cells are the values of the key columns."""
    def cell(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asked):
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        return search(own, asked)

    return candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(cell, schema)


def grid(candidates: DataFrame, queries: DataFrame, n: int, q: int) -> tuple[DataFrame, DataFrame]:
    """Every candidate meets every query in one cell (dim, chunk, block); neither side is dealt whole to a task."""
    chunks, blocks = parts_of(n, CHUNK), parts_of(q, BLOCK)
    candidates = candidates.withColumn("chunk", dealt(candidates, chunks, 1)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = queries.withColumn("block", dealt(queries, blocks, 2)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return candidates, queries


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query row, ties to the smaller vec_id, with their rank."""
    from pyspark.sql import Window

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
