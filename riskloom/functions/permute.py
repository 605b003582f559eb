"""Seeded permutations of the ranks 0 .. n - 1 as an expression: nothing is sorted or shuffled to permute rows.

A rank is a cell of a grid of ``a * b >= n`` cells with ``a, b`` about the square root of ``n``.  Rounds add a hash of one
coordinate to the other, which is a bijection of the grid; cells behind ``n`` (fewer than ``a``) are walked through until a
rank below ``n`` is met, which makes it a bijection of the ranks.  All arithmetic stays below 2^63, so Spark and SQL engines
give the same numbers.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prime modulus of the round hash: products of two remainders stay below 2^62.
PRIME = 2**31 - 1
ROUNDS = 8
#: Further walks through cells behind n.  A cell lies there with a chance below 1 / a, so one more walk is needed with a chance
#: of about a^-40 a rank; up to 40 columns they always suffice.  A rank that needs more is an error, never a wrong rank.
WALKS = 40
MSG_WALK = "A rank's walk did not end; take another seed."


def grid(n: int) -> tuple[int, int]:
    """(columns a, rows b) of the smallest grid with a = ceil(sqrt(n)) that holds n ranks."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, max(1, -(-n // a))


def round_constants(seed: int, stream: int) -> list[tuple[int, int, int]]:
    """Multiplier, addend and second addend of every round, from the md5 of seed, stream and round."""
    out = []
    for k in range(ROUNDS):
        digest = hashlib.md5(f"{seed}-{stream}-{k}".encode()).digest()
        m, s, t = (int.from_bytes(digest[4 * i:4 * i + 4], "big") % PRIME for i in range(3))
        out.append((max(m, 1), s, t))
    return out


def permuted_rank(rank: Column, n: int, seed: int, stream: int) -> Column:
    """The image of ``rank`` (0 <= rank < n) under permutation number ``stream`` of ``seed``; null gives null."""
    a, b = grid(n)
    long = lambda x: F.lit(x).cast("long")
    rounds = F.array(*[F.struct(long(m).alias("m"), long(s).alias("s"), long(t).alias("t"), F.lit(k % 2 == 0).alias("on_column"))
                       for k, (m, s, t) in enumerate(round_constants(seed, stream))])

    def hashed(x: Column, k: Column) -> Column:
        u = (x * k["m"] + k["s"]) % PRIME
        return (u * u + k["t"]) % PRIME

    def one_round(at: Column, k: Column) -> Column:
        column = F.when(k["on_column"], (at["column"] + hashed(at["row"], k)) % a).otherwise(at["column"])
        row = F.when(k["on_column"], at["row"]).otherwise((at["row"] + hashed(at["column"], k)) % b)
        return F.struct(column.alias("column"), row.alias("row"))

    def walked(cell: Column) -> Column:
        start = F.struct((cell % a).alias("column"), F.call_function("div", cell, long(a)).alias("row"))
        return F.aggregate(rounds, start, one_round, lambda at: at["row"] * long(a) + at["column"])

    first = walked(rank.cast("long"))
    if a * b == n:
        return first
    # further walks are taken only from cells behind n
    image = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda cell, _: F.when(cell >= n, walked(cell)).otherwise(cell))
    return F.when(image >= n, F.raise_error(F.lit(MSG_WALK)).cast("long")).otherwise(image)


def permuted_rank_sql(ranks: str, n: str, seed: int, streams: int, name: str = "image") -> str:
    """(stream, rank, ``name``): the same permutations in SQL, of relation ``ranks`` (column ``rank``) with ``n`` rows (a scalar query)."""
    consts = ", ".join(f"({s}, {k}, CAST({m} AS BIGINT), CAST({p} AS BIGINT), CAST({t} AS BIGINT))"
                       for s in range(streams) for k, (m, p, t) in enumerate(round_constants(seed, s)))
    hashed = lambda x: f"((({x} * c.m + c.p) % {PRIME}) * (({x} * c.m + c.p) % {PRIME}) + c.t) % {PRIME}"
    return f"""(
  WITH RECURSIVE _c(stream, k, m, p, t) AS (VALUES {consts}),
  _n AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM (
    SELECT n, CAST(greatest(1, ceil(sqrt(n))) AS BIGINT) AS a FROM (SELECT CAST(({n}) AS BIGINT) AS n))),
  _w AS (
    SELECT s.stream, r.rank, r.rank % _n.a AS col, r.rank // _n.a AS row, 0 AS k, _n.n, _n.a, _n.b
    FROM {ranks} r, _n, (SELECT DISTINCT stream FROM _c) s
    UNION ALL
    SELECT w.stream, w.rank, CASE WHEN w.k % 2 = 0 THEN (w.col + {hashed('w.row')}) % w.a ELSE w.col END,
           CASE WHEN w.k % 2 = 0 THEN w.row ELSE (w.row + {hashed('w.col')}) % w.b END,
           CASE WHEN w.k = {ROUNDS} THEN 1 ELSE w.k + 1 END, w.n, w.a, w.b
    FROM _w w JOIN _c c ON c.stream = w.stream AND c.k = w.k % {ROUNDS}
    WHERE w.k < {ROUNDS} OR w.row * w.a + w.col >= w.n
  )
  SELECT stream, rank, row * a + col AS {name} FROM _w WHERE k = {ROUNDS} AND row * a + col < n
)"""
