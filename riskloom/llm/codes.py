"""Vector code compression: one codebook for each part of a vector, entries found by an equal-average search.

Components become whole numbers, vectors are cut into equal consecutive
parts, and each part is coded by the index of its codebook's nearest entry.
A codebook's entries lie in the order of their component sums.  For a part
with component sum s, an entry with sum S is at a squared distance of at least
``(s - S)**2 / dimension``; the search starts where s falls among the sums and
goes outward on both sides, until the squared gap over the dimension strictly
exceeds the best distance.  So ties are seen, and go to the lower index.

The codebooks start as the parts of the smallest ids and are moved in rounds:
every task sums its own rows for each entry, Spark adds these up, and the
driver holds no more than the codebooks (entries x dimension whole numbers).
All rows take part in every round.

Edge cases: vectors that are null, empty, or hold a null or non-finite
component take no part.  Vectors of another dimension than the one of the
smallest id get a null code and error and take no part in the codebooks.  A
dimension that the parts don't divide gives its first parts one component more.
Null ids sort after all others; rows that share an id are rows of their own,
ordered by their components where the first entries are chosen.  With fewer
rows than entries the codebooks are smaller.  Equal labels, nulls together,
share one ``label_error``.  An empty table gives none.  The result has its own
columns only, so other columns of the input may have any name.  A task holds
one Arrow batch of vectors of any length.  Squared distances and sums must stay
within 63 bits, as their type does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, staged
from riskloom.llm.vectors import finite

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


def nearest(own: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``own`` the index of the nearest row of ``book``, the lowest of equals, and the squared distance."""
    sums = book.sum(1)
    order = np.argsort(sums, kind="stable")
    sums, entries, size = sums[order], book[order], own.shape[1]
    mine = own.sum(1)
    place = np.searchsorted(sums, mine)
    first = np.minimum(place, len(book) - 1)
    best = ((own - entries[first]) ** 2).sum(1)
    index = order[first]
    # both directions, each with the rows that it still has to go on for and the place it has reached
    sides = [[np.arange(len(own)), first + 1, 1], [np.arange(len(own)), first - 1, -1]]
    while any(len(side[0]) for side in sides):
        for side in sides:
            rows, at, step = side
            inside = (at >= 0) & (at < len(book))
            rows, at = rows[inside], at[inside]
            open_ = (sums[at] - mine[rows]) ** 2 <= size * best[rows]
            rows, at = rows[open_], at[open_]
            found = ((own[rows] - entries[at]) ** 2).sum(1)
            better = (found < best[rows]) | ((found == best[rows]) & (order[at] < index[rows]))
            best[rows[better]], index[rows[better]] = found[better], order[at[better]]
            side[0], side[1] = rows, at + step
    return index, best


@dataclass
class Codebooks:
    """For each part its entries as rows of whole numbers; ``cuts`` are the parts' edges in the vector."""

    cuts: np.ndarray
    books: list[np.ndarray]

    @property
    def dim(self) -> int:
        return int(self.cuts[-1])

    def parts(self, whole: np.ndarray) -> list[np.ndarray]:
        return [whole[:, a:b] for a, b in zip(self.cuts, self.cuts[1:])]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def _whole(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """The vectors of a batch that aren't null, as rows of floor(scale * x)."""
    return np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int64).reshape(-1, dim)


def _of_dimension(rows: DataFrame, vector: str, dim: int):
    return F.when(F.size(vector) == dim, F.col(vector).cast("array<double>"))


def _first_books(rows: DataFrame, key: str, vector: str, parts: int, entries: int, scale: int) -> Codebooks | None:
    found = [r[0] for r in rows.orderBy(F.col(key).asc_nulls_last(), vector).limit(entries).select(
        F.col(vector).cast("array<double>")).collect()]
    if not found:
        return None
    dim = len(found[0])
    whole = np.floor(np.array([v for v in found if len(v) == dim], np.float64) * scale).astype(np.int64)
    cuts = np.cumsum([0, *(len(c) for c in np.array_split(np.arange(dim), parts))])
    return Codebooks(cuts, [whole[:, a:b] for a, b in zip(cuts, cuts[1:])])


def _moved(rows: DataFrame, vector: str, now: Codebooks, scale: int) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that are nearest to it; unused ones stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in now.books]
        for batch in batches:
            whole = _whole(batch.column(0), now.dim, scale)
            for total, own, book in zip(totals, now.parts(whole), now.books):
                index = nearest(own, book)[0]
                np.add.at(total[:, -1], index, 1)
                for c in range(own.shape[1]):
                    np.add.at(total[:, c], index, own[:, c])
        for part, total in enumerate(totals):
            entry, place = (x.ravel() for x in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(entry), part), pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(total.ravel(), pa.int64())], names=["part", "entry", "place", "total"])

    sums = rows.select(_of_dimension(rows, vector, now.dim).alias("v")).where("v is not null").mapInArrow(
        run, "part int, entry int, place int, total long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))
    totals = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in now.books]
    for r in sums.collect():  # entries x (dimension + parts) numbers
        totals[r["part"]][r["entry"], r["place"]] = r["total"]
    books = []
    for total, book in zip(totals, now.books):
        count = total[:, -1:]
        books.append(np.where(count > 0, total[:, :-1] // np.maximum(count, 1), book))
    return Codebooks(now.cuts, books)


def fit(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks learned from all rows; None if no row has a usable vector."""
    small_batches(rows.sparkSession)
    rows = rows.where(finite(vector))
    books = _first_books(rows, key, vector, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _moved(rows, vector, books, scale)
    return books


def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows with a usable vector, their columns other than the vector, and ``code`` and ``error``.

    A column of ``rows`` with one of these two names is replaced.
    """
    digits = np.array([list(f"{i:02x}".encode()) for i in range(max(len(b) for b in books.books))], np.uint8)
    names = [c for c in rows.columns if c not in (vector, "code", "error")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(len(names))
            found = [nearest(own, book) for own, book in zip(books.parts(_whole(vectors, books.dim, scale)), books.books)]
            there = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            code, error = np.full(len(vectors), None, object), np.full(len(vectors), None, object)
            text = digits[np.stack([f[0] for f in found], 1)].reshape(len(there), -1)
            code[there] = [row.tobytes().decode() for row in text]
            error[there] = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             names=[*names, "code", "error"])

    small_batches(rows.sparkSession)
    source = rows.where(finite(vector)).select(*[F.col(f"`{c}`") for c in names], _of_dimension(rows, vector, books.dim).alias("v"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(run, kept + "code string, error long")


def compressed(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row with a usable vector."""
    books = fit(rows, key, vector)
    if books is None:
        return rows.where("1 = 0").select(
            F.col(key).alias(key), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    bare = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    coded = staged(encode(bare, books, "vector"), "codes")
    sums = coded.groupBy(F.col("label").alias("group")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("group"))).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
