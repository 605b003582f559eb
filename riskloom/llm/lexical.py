"""Ranked lexical search: each item's documents grouped by the mask of the item's terms that they hold.

One pass over the documents finds the terms of the items, of every whole text;
a second scores blocks of documents.  In a block every term has a bitmap of
its documents.  For an item the bitmaps are laid side by side, so that each
document's column is its mask; documents of one mask form a group.  A mask's
score can't exceed the sum of its terms' weighted largest entries in the
block.  Groups are scored in the order of that bound, until the k-th best
score known strictly exceeds the next bound.  A task carries the k best scores
from one block to the next, so later blocks finish sooner.  Scores are 64-bit
whole numbers and exact; blocks send at most k rows an item.

The items are a stated query set: they are dealt into sets of about
``TERMS`` terms at most, and each set reads the documents once more.  What a
task is sent (terms, weights, items of a set) is bounded by that.

Edge cases: a null or empty text has no term and counts in no statistic; an
item without terms, or none of whose terms occurs, has no rows.  Rows of one
item_id are one item, with the terms of all its rows; null item_ids are one
item.  Repeated doc_ids are documents of their own; equal scores go by
ascending doc_id, a null id last.  Texts of any length are read whole.  Empty
tables give no rows.  The result has its own columns only, so other columns of
the tables may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, staged, utf8_pieces
from riskloom.llm.words import word_hashes

#: Terms of a set of items, about; a longer item is a set of its own.
TERMS = 1 << 16
K = 10
#: Documents that are scored before the bound is looked at for the first time; doubled each time.
_STEP = 64
_INSIDE = np.ones(256, bool)
_INSIDE[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms of a block of texts, and each text's first term (one more entry at the end).

    The signs between terms are all of one byte, so a term is a run of other bytes inside a text.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order, with repeats."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = term_bounds(data, np.array([0, len(data)]))
    return [raw[a:b].translate(_LOWER) for a, b in zip(starts, ends)]


class Vocabulary:
    """The distinct terms of a set of items, found among a block's terms by hash and then byte by byte."""

    def __init__(self, terms: list[bytes]) -> None:
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms])
        starts = ends - [len(t) for t in terms]
        hashes = word_hashes(data, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.data, self.starts, self.sizes = data, starts[self.order], (ends - starts)[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for one that isn't there."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.hashes) or not len(starts):
            return found
        hashes = word_hashes(data, starts, ends)
        place = np.searchsorted(self.hashes, hashes)
        rows = np.flatnonzero(self.hashes[np.minimum(place, len(self.hashes) - 1)] == hashes)
        at = place[rows]
        lower = np.frombuffer(bytes(range(256)).translate(_LOWER), np.uint8)
        while len(rows):  # terms of one hash lie side by side; one round is enough unless two share a hash
            same = self.sizes[at] == (ends - starts)[rows]
            sizes = self.sizes[at] * same
            first = np.cumsum(sizes) - sizes
            steps = np.arange(sizes.sum()) - np.repeat(first, sizes)
            equal = lower[data[np.repeat(starts[rows], sizes) + steps]] == self.data[np.repeat(self.starts[at], sizes) + steps]
            misses = np.bincount(np.repeat(np.arange(len(rows)), sizes)[~equal], minlength=len(rows))
            hit = same & (misses == 0)
            found[rows[hit]] = self.order[at[hit]]
            rows, at = rows[~hit], at[~hit] + 1
            more = at < len(self.hashes)
            rows, at = rows[more], at[more]
            more = self.hashes[at] == hashes[rows]
            rows, at = rows[more], at[more]
        return found


def _postings(docs: DataFrame, key: str, text: str, words: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts): of every text with a term, its terms with repeats, and those of the vocabulary as arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, at in utf8_pieces(batch.column(1)):
                starts, ends, firsts = term_bounds(data, at)
                n = np.diff(firsts)
                number = words.find(data, starts, ends)
                row = np.repeat(np.arange(last - first), n)
                keep = number >= 0
                pair, counts = np.unique(row[keep] << 32 | number[keep], return_counts=True)
                some = np.flatnonzero(n)
                edges = np.searchsorted(pair >> 32, [*some, last - first]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x))
                         for x in ((pair & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int64))]
                ids = batch.column(0).slice(first, last - first).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n[some], pa.int64()), *lists],
                                                 names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[key].dataType.simpleString()}, n long, terms array<int>, counts array<long>")


@dataclass
class Block:
    """Documents of a scoring block: their ids, and for each pair of a term and a document the entry, by term, then document."""

    ids: list
    pairs: np.ndarray
    values: np.ndarray
    edges: np.ndarray
    bitmaps: dict[int, np.ndarray]

    @classmethod
    def of(cls, batch: pa.RecordBatch, n_terms: int, documents: int, length: int) -> Block:
        n = batch.column(1).to_numpy()
        m = np.array([100 - 90 + (90 * int(x) * documents) // length for x in n.tolist()], np.int64)
        lists = batch.column(2)
        row = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        term, tf = lists.flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy()
        pairs = term << 32 | row
        order = np.argsort(pairs)
        pairs, tf, row = pairs[order], tf[order], row[order]
        return cls(batch.column(0).to_pylist(), pairs, (1_000_000_000 * tf) // (1000 * tf + 8 * m[row]),
                   np.searchsorted(pairs >> 32, np.arange(n_terms + 1)), {})

    def bitmap(self, term: int) -> np.ndarray:
        if term not in self.bitmaps:
            bits = np.zeros(len(self.ids), np.uint8)
            bits[self.pairs[self.edges[term]:self.edges[term + 1]] & 0xFFFFFFFF] = 1
            self.bitmaps[term] = np.packbits(bits)
        return self.bitmaps[term]

    def groups(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents with a term, by mask: (documents, the groups' edges among them, each group's mask as a row of 0 and 1)."""
        maps = np.stack([self.bitmap(t) for t in terms.tolist()])
        holders = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, 0), count=len(self.ids)))
        bits = np.unpackbits(maps, axis=1, count=len(self.ids))[:, holders]
        packed = np.packbits(bits, axis=0).T
        keys = np.zeros((len(holders), -(-packed.shape[1] // 8) * 8), np.uint8)
        keys[:, :packed.shape[1]] = packed
        keys = keys.view(np.uint64)
        order = np.lexsort(keys.T)
        keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
        return holders[order], np.append(new, len(holders)), bits[:, order[new]].T

    def scores(self, rows: np.ndarray, masks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of documents whose masks are given row by row."""
        row, at = np.nonzero(masks)
        entries = self.values[np.searchsorted(self.pairs, terms[at] << 32 | rows[row])] * weights[at]
        return np.add.reduceat(entries, np.searchsorted(row, np.arange(len(rows))))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them all of the block's k best (with ties) that reach ``least``."""
        there = self.edges[terms + 1] > self.edges[terms]
        terms, weights = terms[there], weights[there]
        none = np.zeros(0, np.int64)
        if not len(terms):
            return none, none
        tops = np.array([self.values[self.edges[t]:self.edges[t + 1]].max() for t in terms]) * weights
        if tops.sum() < least:
            return none, none
        documents, edges, masks = self.groups(terms)
        bounds = masks @ tops
        order = np.argsort(-bounds, kind="stable")
        sizes = np.diff(edges)
        ends = np.cumsum(sizes[order])
        rows, found, at, step = [none], [none], 0, _STEP
        while at < len(order) and bounds[order[at]] >= least:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
            reached = order[at:upto]
            own = np.concatenate([documents[edges[g]:edges[g + 1]] for g in reached])
            score = self.scores(own, np.repeat(masks[reached], sizes[reached], axis=0), terms, weights)
            rows.append(own[score >= least])
            found.append(score[score >= least])
            at, step = upto, 2 * step
            if sum(map(len, found)) >= k:
                known = np.concatenate(found)
                least = max(least, int(np.partition(known, -k)[-k]))
        rows, found = np.concatenate(rows), np.concatenate(found)
        return rows[found >= least], found[found >= least]


def _order(entry: tuple) -> tuple:
    return -entry[0], entry[1] is None, entry[1]


def _ranked_set(pairs: list, docs: DataFrame, key: str, text: str, item_type: str, k: int) -> DataFrame:
    """The k best documents of every task and item of one set, whose (item, term) pairs are given."""
    terms = sorted({t for _, t in pairs})
    number = {t: i for i, t in enumerate(terms)}
    wanted: dict = {}
    for item, term in pairs:
        wanted.setdefault(item, []).append(number[term])
    postings = staged(_postings(docs, key, text, Vocabulary(terms)), "postings")
    documents, length = postings.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(terms), np.int64)
    for term, n in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the set's terms
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    items = list(wanted)
    asked = [np.array(sorted(wanted[i]), np.int64) for i in items]
    rows_at_once = max(64, (1 << 24) // max(map(len, asked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items]
        for batch in batches:
            for first in range(0, batch.num_rows, rows_at_once):
                block = Block.of(batch.slice(first, rows_at_once), len(terms), documents, length)
                for i, own in enumerate(asked):
                    least = best[i][-1][0] if len(best[i]) == k else 1
                    rows, scores = block.best(own, weight[own], k, least)
                    if len(rows):
                        best[i] = sorted([*best[i], *((s, block.ids[r]) for r, s in zip(rows.tolist(), scores.tolist()))], key=_order)[:k]
        if any(best):
            flat = [(i, d, s) for i, found in enumerate(best) for s, d in found]
            item, doc, score = zip(*flat)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, batch.column(0).type), pa.array(score, pa.int64())],
                                             names=["item", "doc_id", "score"])

    found = postings.mapInArrow(run, f"item int, doc_id {docs.schema[key].dataType.simpleString()}, score long")
    names = docs.sparkSession.createDataFrame(list(enumerate(items)), f"item int, item_id {item_type}")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = K, item_key: str = "item_id", item_text: str = "text", key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 of each item."""
    small_batches(docs.sparkSession)
    item_type = items.schema[item_key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t) for i, own in enumerate(batch.column(1).to_pylist()) for t in sorted(set(terms_of(own)))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _ in found], pa.int64())),
                                              pa.array([t for _, t in found], pa.binary())], names=["item_id", "term"])

    pairs = staged(items.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).mapInArrow(
        split, f"item_id {item_type}, term binary").distinct(), "terms")
    sets = -(-pairs.count() // TERMS)
    ranked = []
    for s in range(sets):
        own = pairs if sets == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(sets)) == s)
        own = [(r[0], bytes(r[1])) for r in own.collect()]
        if own:
            ranked.append(_ranked_set(sorted(own, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1])), docs, key, text, item_type, k))
    if not ranked:
        return docs.where("1 = 0").select(F.lit(None).cast(item_type).alias("item_id"), F.lit(0).alias("rank"),
                                          F.col(f"`{key}`").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
