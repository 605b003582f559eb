"""Approximate nearest neighbours by learned partitions.

Fit, on a sample of at most ``SAMPLE`` vectors chosen by a hash of the id: the
graph of each vector's nearest neighbours is cut into parts of equal size by
recursive bisection (the second direction of the graph's random walk, cut at
the median, then swaps that lower the cut), and a small network learns a
vector's part.  Index: every vector goes to its most probable part.  Search: a
query goes to its most probable parts - as many as the sample needs for
``RECALL`` of its own neighbours, and on until enough candidates were met - and
all vectors there are ranked by their exact cosine.

Parts are searched in chunks and blocks of bounded size, so a part may be as
large as its vectors make it (a third of all rows may be one vector).

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; rows that share an id are
candidates, and queries, of their own, and meet each other.  Vectors of another dimension than the most common one form
a part of their own for each dimension, which is searched whole.  With at most
four sampled vectors a part there is no graph and no router: all rows are one
part, and the search is exact.  With fewer candidates than k all are returned.
Ties go to the smaller vec_id.  The result has its own columns only, so other
columns may have any name; vectors of any length are compared whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import staged, with_arrow_columns
from riskloom.llm.vectors import BLOCK, CHUNK, PAIR, matrix, on_grid, packed, ranked, finite

SAMPLE, NEIGHBOURS = 4096, 10
#: The share of the sample's own neighbours that the probed parts must hold.
RECALL = 0.95
#: Candidates that a query meets at least, where there are so many.
ENOUGH = 256
_STEP = 128


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each unit vector, by cosine."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for s in range(0, len(x), 512):
        near = x[s:s + 512] @ x.T
        near[np.arange(len(near)), np.arange(s, s + len(near))] = -np.inf
        out[s:s + 512] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def _walk(edges: np.ndarray, n: int, v: np.ndarray, degree: np.ndarray) -> np.ndarray:
    return np.bincount(edges[0], v[edges[1]], n) / degree


def bisect_graph(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Sides (False, True) of n nodes, equal in size to one: the walk's second direction at the median, then swaps."""
    degree = np.maximum(np.bincount(edges[0], minlength=n), 1)
    v = rng.normal(size=n)
    for _ in range(60):
        v = 0.5 * (v + _walk(edges, n, v, degree))
        v -= (v * degree).sum() / degree.sum()
        v /= max(1e-300, np.abs(v).max())
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(10):
        other = np.bincount(edges[0], side[edges[0]] != side[edges[1]], n)
        gain = 2 * other - np.bincount(edges[0], minlength=n)
        a, b = (np.flatnonzero(side == s) for s in (False, True))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        good = np.flatnonzero(gain[a[:m]] + gain[b[:m]] > 0)
        take = good[:max(1, len(good) // 2)] if len(good) else good
        before = other.sum()
        side[a[take]], side[b[take]] = True, False
        if not len(take) or (side[edges[0]] != side[edges[1]]).sum() >= before:
            side[a[take]], side[b[take]] = False, True
            break
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part (0 to parts - 1, a power of two) for each node, all of nearly the same size."""
    n = len(near)
    a = np.repeat(np.arange(n), near.shape[1])
    edges = np.concatenate([np.stack([a, near.ravel()]), np.stack([near.ravel(), a])], 1)
    part, rng = np.zeros(n, np.int64), np.random.default_rng(seed)
    while part.max(initial=0) + 1 < parts:
        new = part * 2
        for p in range(part.max() + 1):
            own = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            inside = place[edges]
            inside = inside[:, (inside >= 0).all(0)]
            new[own] += bisect_graph(inside, len(own), rng)
        part = new
    return part


@dataclass
class Router:
    """A network of one hidden layer: unit vector to log odds of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def fit_router(x: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 40, seed: int = 7) -> Router:
    rng = np.random.default_rng(seed)
    net = Router(rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)) * 2, np.zeros(hidden),
                 rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts))
    params = [net.w1, net.b1, net.w2, net.b2]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 128):
            own, truth = x[order[s:s + 128]], part[order[s:s + 128]]
            h = np.maximum(own @ net.w1 + net.b1, 0)
            z = h @ net.w2 + net.b2
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), truth] -= 1
            p /= len(own)
            back = (p @ net.w2.T) * (h > 0)
            step += 1
            for g, p_, m, v in zip((own.T @ back, back.sum(0), h.T @ p, p.sum(0)), params, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= 0.005 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit_index(x: np.ndarray, parts: int, k: int) -> tuple[Router, int]:
    """The router of a sample, and how many parts must be probed so that RECALL of the k nearest are met.

    The graph and the router see three quarters of the sample; the probes are counted on the last one,
    for the neighbours that its vectors have among themselves.
    """
    x = unit(x)
    seen, fresh = x[:len(x) * 3 // 4], x[len(x) * 3 // 4:]
    net = fit_router(seen, balanced_parts(neighbour_graph(seen, NEIGHBOURS), parts), parts)
    order = np.argsort(-net.odds(fresh), 1, kind="stable")
    place = np.argsort(order, 1)
    needed = place[np.arange(len(fresh))[:, None], order[neighbour_graph(fresh, k), 0]]
    counts = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    return net, int(np.searchsorted(counts, RECALL)) + 1


def _nearest(k: int):
    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows, ids, mine, theirs = own["row"].to_numpy(), own["vec_id"].to_numpy(), matrix(own), matrix(asked)
        length = np.sqrt((mine * mine).sum(1))
        fair = mine / length[:, None]
        out = []
        for s in range(0, len(asked), _STEP):
            names, block = asked["row"].to_numpy()[s:s + _STEP], theirs[s:s + _STEP]
            near = unit(block) @ fair.T
            near[names[:, None] == rows[None, :]] = -np.inf
            for name, query_id, q, row in zip(names, asked["vec_id"].to_numpy()[s:s + _STEP], block, near):
                least = np.partition(row, -k)[-k] - 1e-9 if len(row) > k else -2.0
                left = np.flatnonzero((row >= least) & (row > -2))  # with room for rounding; then one sum a pair, always alike
                score = (mine[left] * q).sum(1) / (length[left] * np.sqrt((q * q).sum()))
                best = np.lexsort((ids[left], -score))[:k]
                out.append(pd.DataFrame({"query": name, "query_id": query_id, "row": rows[left][best], "vec_id": ids[left][best],
                                         "score": score[best]}))
        return pd.concat(out)
    return search


def index_size(n: int) -> int:
    """Parts: a power of two that grows as the square root of the vectors do; 4 to 256."""
    return 1 << int(np.clip(np.log2(max(n, 1)) / 2 - 3, 2, 8))


def nearest_neighbours(rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every row for which ``is_query`` (on vec_id) holds."""
    usable = finite(vector) & F.exists(vector, lambda x: x != 0)
    vectors = packed(rows.where(usable), key, F.col(vector))
    dims = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()  # as many groups as dimensions
    if dims is None:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    dim, n = dims
    parts = index_size(n)
    some = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", "raw").limit(SAMPLE).toPandas()
    net, probes = fit_index(matrix(some), parts, k) if len(some) > 4 * parts else (None, 1)

    def home(dims_: pa.Array, raws: pa.Array) -> list[pa.Array]:
        out = [-int(d) for d in dims_.to_numpy()]  # a dimension's own part; the learned ones count from 0
        usual = [i for i, d in enumerate(out) if d == -dim]
        if usual:
            x = np.frombuffer(b"".join(raws[i].as_py() for i in usual), np.float64).reshape(len(usual), dim)
            for i, p in zip(usual, net.odds(unit(x)).argmax(1) if net else [0] * len(usual)):
                out[i] = int(p)
        return [pa.array(out, pa.int32())]

    indexed = staged(with_arrow_columns(vectors, ["dim", "raw"], home, T.StructType([T.StructField("part", T.IntegerType())])), "index")
    counts = {r[0]: r[1] for r in indexed.groupBy("part").count().collect()}  # parts and dimensions

    def routes(part: pa.Array, raws: pa.Array) -> list[pa.Array]:
        out = [[p] for p in part.to_pylist()]
        usual = [i for i, p in enumerate(out) if p[0] >= 0]
        if net and usual:
            x = np.frombuffer(b"".join(raws[i].as_py() for i in usual), np.float64).reshape(len(usual), dim)
            for i, order in zip(usual, np.argsort(-net.odds(unit(x)), 1, kind="stable")):
                met = np.cumsum([counts.get(int(p), 0) for p in order])
                out[i] = [int(p) for p in order[:max(probes, int(np.searchsorted(met, ENOUGH + 1)) + 1)]]
        return [pa.array(out, pa.list_(pa.int32()))]

    asked = with_arrow_columns(indexed.where(is_query(F.col("vec_id"))), ["part", "raw"], routes, T.StructType(
        [T.StructField("parts", T.ArrayType(T.IntegerType()))])).drop("part").withColumn("part", F.explode("parts")).drop("parts")
    asked = staged(asked, "asked")
    wanted = {r[0]: r[1] for r in asked.groupBy("part").count().collect()}
    sizes = {p: (-(-c // CHUNK), -(-wanted.get(p, 0) // BLOCK)) for p, c in counts.items()}

    def cells(which: int):
        made = F.lit(1)
        for p, s in sizes.items():
            if s[which] > 1:
                made = F.when(F.col("part") == p, s[which]).otherwise(made)
        return made

    chunk = lambda seed, which: F.pmod(F.xxhash64("row", F.lit(seed)), cells(which)).cast("int")
    every = lambda which: F.explode(F.sequence(F.lit(0), cells(which) - 1))
    own = indexed.withColumn("chunk", chunk(1, 0)).withColumn("block", every(1))
    asked = asked.withColumn("block", chunk(2, 1)).withColumn("chunk", every(0))
    return ranked(on_grid(own, asked, ["part", "chunk", "block"], _nearest(k), PAIR + "double"), k)
