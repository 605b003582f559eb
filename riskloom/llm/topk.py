"""Exact top-k by inner product in three phases with a uniform threshold.

The components are cut into ``LISTS`` runs; each run gives every candidate a
partial score, and the score is the sum of the lists' entries.

1. Each list sends its k best entries for a query, and its least entry.  The
   sums known so far, with the least entries for what is unknown, bound the
   scores from below; the k-th best bound is the cutoff.
2. A candidate at or above the cutoff exceeds the least entry, in at least one
   list, by an even share of what the cutoff exceeds the sum of least entries.
   That uniform threshold goes to all chunks, which keep the entries above it,
   and of those the candidates whose upper bound reaches the cutoff.
3. The scores of what remains are summed exactly, and the best k are kept.

Candidates lie in chunks and queries in blocks of bounded size; cutoffs travel
with their queries, not by broadcast.  Scores are whole numbers.

Edge cases: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows without an id; rows that share an id are
candidates, and queries, of their own, and meet each other.  A query meets only vectors of its own dimension.  With
fewer candidates than k all are returned.  Ties go to the smaller vec_id.  The
result has its own columns only, so other columns may have any name; a task
holds whole vectors of a chunk and a block, however long they are.
Sums must stay within 63 bits, as the score's type does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import staged
from riskloom.llm.vectors import PAIR, finite, grid, matrix, on_grid, packed, ranked

LISTS = 4
#: Queries that a task scores at once.
_STEP = 64


def whole_numbers(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """The packed vectors of floor(scale * x)."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return packed(rows.where(finite(vector)), key, whole)


def _partials(asked: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
    """The entries of each list, as whole numbers (by floats where they hold every sum exactly)."""
    size = own.shape[1]
    top = max(1.0, np.abs(asked).max(initial=0)) * max(1.0, np.abs(own).max(initial=0)) * size
    kind = np.float64 if top < 2 ** 53 else np.int64
    cuts = np.array_split(np.arange(size), min(LISTS, size))
    return [(asked[:, c].astype(kind) @ own[:, c].astype(kind).T).astype(np.int64) for c in cuts]


def _local_lists(k: int):
    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, mine, theirs = own["row"].to_numpy(), matrix(own), matrix(asked)
        out = []
        for s in range(0, len(asked), _STEP):
            names = asked["row"].to_numpy()[s:s + _STEP]
            for b, part in enumerate(_partials(theirs[s:s + _STEP], mine)):
                low = part.min(1)
                part = np.where(ids[None, :] == names[:, None], np.iinfo(np.int64).min, part)  # a query's own row is no candidate
                best = np.argpartition(part, -min(k, len(ids)), axis=1)[:, -min(k, len(ids)):]
                rows = np.repeat(np.arange(len(names)), best.shape[1])
                out.append(pd.DataFrame({"query": names[rows], "list": b, "row": ids[best.ravel()],
                                         "part": part[rows, best.ravel()], "low": low[rows]}))
        made = pd.concat(out)
        return made[made["part"] > np.iinfo(np.int64).min]
    return search


def _cutoffs(lists: DataFrame, k: int) -> DataFrame:
    """(row, cutoff, lows): for each query the k-th best lower bound (null with fewer) and every list's least entry."""
    lows = lists.groupBy("query", "list").agg(F.min("low").alias("low"))
    best = Window.partitionBy("query", "list").orderBy(F.desc("part"), "row")
    known = lists.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).join(lows.withColumnRenamed("low", "least"), [
        "query", "list"])
    floor = lows.groupBy("query").agg(F.sum("low").alias("floor"), F.sort_array(F.collect_list(F.struct("list", "low"))).alias("lows"))
    above = known.groupBy("query", "row").agg(F.sum(F.col("part") - F.col("least")).alias("above"))
    order = Window.partitionBy("query").orderBy(F.desc("above"))
    kth = above.withColumn("r", F.row_number().over(order)).where(F.col("r") == k).select("query", "above")
    return floor.join(kth, "query", "left").select(
        F.col("query").alias("row"), (F.col("above") + F.col("floor")).alias("cutoff"), F.col("lows.low").alias("lows"))


def _resolve(k: int):
    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows_, ids, mine, theirs = own["row"].to_numpy(), own["vec_id"].to_numpy(), matrix(own), matrix(asked)
        out = []
        for s in range(0, len(asked), _STEP):
            block = asked.iloc[s:s + _STEP]
            parts = _partials(theirs[s:s + _STEP], mine)
            for i, (name, query_id, cutoff, lows) in enumerate(zip(block["row"], block["vec_id"], block["cutoff"], block["lows"])):
                rows = [p[i] for p in parts]
                if cutoff is None or pd.isna(cutoff) or lows is None:
                    left = np.arange(len(ids))
                else:
                    cutoff, lows = int(cutoff), [int(x) for x in lows]
                    share = -(-(cutoff - sum(lows)) // len(lows))
                    marks = [low + share for low in lows]
                    sent = [r >= m for r, m in zip(rows, marks)]
                    left = np.flatnonzero(np.logical_or.reduce(sent))
                    most = sum(np.where(t[left], r[left], m) for t, r, m in zip(sent, rows, marks))
                    left = left[most >= cutoff]
                left = left[rows_[left] != name]
                total = sum(r[left] for r in rows)
                if len(left) > k:
                    least = np.partition(total, -k)[-k]
                    left, total = left[total >= least], total[total >= least]
                order = np.lexsort((ids[left], -total))[:k]
                out.append(pd.DataFrame({"query": name, "query_id": query_id, "row": rows_[left][order], "vec_id": ids[left][order],
                                         "score": total[order]}))
        return pd.concat(out)
    return search


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with every other vector.

    Both sides come from one table of packed vectors (see ``packed``); the candidate of the query's row is the query itself.
    """
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # columns of its own, as both may be one table
    n, q = vectors.count(), queries.count()
    keys = ["dim", "chunk", "block"]
    own, asked = grid(vectors, queries, n, q)
    lists = staged(on_grid(own, asked, keys, _local_lists(k), "query long, list int, row long, part long, low long"), "lists")
    asked = grid(vectors, queries.join(_cutoffs(lists, k), "row", "left"), n, q)[1]
    return ranked(on_grid(own, asked, keys, _resolve(k), PAIR + "long"), k)
