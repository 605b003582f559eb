"""Minimax contiguous sharding: equal texts stay together, the largest shard is as small as order allows.

Groups of equal texts are put in the order of their SHA-256.  The smallest
capacity with which a greedy left-to-right fill needs no more than the wanted
number of shards is found by search, many capacities per pass; the shards are
cut where that fill cuts.  All work on rows is DataFrame work: the driver
holds one pair of numbers for each of at most 65,536 digest prefixes, and asks
the sorted group table for the last group end at or below a target.

Edge cases: null texts form one group of size 1 a row, apart from the empty
texts (also size 1 a row).  Repeated rows are members of their group like any
other.  A group larger than an even share makes the capacity its own size.  An
empty table gives an empty result; shards that get no group do not appear.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import staged

#: Parts into which the members of one group are dealt, so that no group is ranked by one task.
SALTS = 1024
#: Capacities that one pass over the group ends tries.
ARITY = 32


def minimax_shards(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``bytes``.

    ``size`` is the UTF-8 length plus 1, ``slot`` counts from 0 without a gap inside a shard, in the
    order of the groups.
    """
    raw = F.col(text).cast("binary")
    rows = staged(docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(raw, 256), F.lit("null")).alias("digest"),
        F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int").alias("salt")), "rows")
    cells, totals = _cells(rows)
    cuts = _cuts(cells, totals, shards)
    law = F.lit("bytes").alias("law")
    placed = F.lit(0)
    for cut in cuts[:-1]:
        placed = placed + F.when(F.col("group_end") > F.lit(cut), 1).otherwise(0)
    cells = cells.withColumn("shard", placed.cast("int"))
    first = cells.groupBy("shard").agg(F.min("rows_before").alias("first_row"))  # as many rows as shards
    cells = cells.join(F.broadcast(first), "shard").select(
        "digest", "salt", "shard", (F.col("rows_before") - F.col("first_row")).alias("before"))
    own = Window.partitionBy("digest", "salt").orderBy("doc_id")
    return rows.join(cells, ["digest", "salt"]).select(
        "doc_id", "size", "text_crc32", law, "shard",
        (F.col("before") + F.row_number().over(own) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def _cells(rows: DataFrame) -> tuple[DataFrame, list]:
    """The (digest, salt) cells in order, with running totals; and each prefix's bytes for the driver."""
    sums = rows.groupBy("digest", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    digits = 2 if (n := rows.count()) < 20_000_000 else 3 if n < 300_000_000 else 4
    cells = staged(sums.withColumn("prefix", F.substring("digest", 1, digits)), "sums")
    totals = cells.groupBy("prefix").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    earlier = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 rows at most
    starts = totals.select("prefix", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes0"), "bytes")
    peers = Window.partitionBy("prefix").orderBy("digest")
    prior = Window.partitionBy("prefix").orderBy("digest", "salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("end0", F.sum("bytes").over(peers)).withColumn("n1", F.coalesce(F.sum("n").over(prior), F.lit(0)))
    whole = Window.partitionBy("prefix", "digest")
    cells = cells.join(F.broadcast(starts.drop("bytes")), "prefix").select(
        "prefix", "digest", "salt", F.sum("bytes").over(whole).alias("group_bytes"),
        (F.col("bytes0") + F.col("end0")).alias("group_end"), (F.col("n0") + F.col("n1")).alias("rows_before"))
    cells = staged(cells.sortWithinPartitions("prefix", "digest"), "cells")
    return cells, [(r["prefix"], r["bytes0"], r["bytes0"] + r["bytes"]) for r in starts.orderBy("prefix").collect()]


def _cuts(cells: DataFrame, totals: list, shards: int) -> list[int]:
    """The ends, in bytes, of the shards of the greedy fill with the smallest capacity that suffices."""
    if not totals:
        return [0]
    total, starts = totals[-1][2], [t[1] for t in totals]
    widest = cells.agg(F.max("group_bytes")).first()[0]

    def last_ends(targets: list[int]) -> list[int]:
        """The largest group end at or below each target; only prefixes that hold a target are read."""
        at = [bisect.bisect_right(starts, t) - 1 for t in targets]
        near = cells.where(F.col("prefix").isin(sorted({totals[i][0] for i in at})))
        found = near.agg(*[F.max(F.when((F.col("prefix") == totals[i][0]) & (F.col("group_end") <= t), F.col("group_end")))
                           .alias(f"t{k}") for k, (t, i) in enumerate(zip(targets, at))]).first()
        return [f if f is not None else totals[i][1] for f, i in zip(found, at)]

    def fills(capacities: list[int]) -> list[list[int]]:
        """The greedy cuts for each capacity; they end at the total where the capacity suffices."""
        cuts = [[0] for _ in capacities]
        for _ in range(shards):
            goals = [min(total, c[-1] + cap) for c, cap in zip(cuts, capacities)]
            asked = sorted({g for g in goals if g < total})
            known = dict(zip(asked, last_ends(asked))) if asked else {}
            for c, goal in zip(cuts, goals):
                c.append(known.get(goal, total))
        return [c[1:] for c in cuts]

    low, high = max(-(-total // shards), widest), -(-total // shards) + widest
    best = fills([high])[0]
    while low < high:
        step = max(1, -(-(high - low) // ARITY))
        tried = list(range(low, high, step))
        made = fills(tried)
        fit = next((k for k, c in enumerate(made) if c[-1] == total), None)
        if fit is None:
            low = tried[-1] + 1
        else:
            best, high = made[fit], tried[fit]
            low = tried[fit - 1] + 1 if fit else high
    return best
