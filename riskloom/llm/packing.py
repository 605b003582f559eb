"""Best-fit packing by linear grouping: documents into as few sequences of a fixed capacity as it can.

A packing is decided by how many pieces there are of each length, so the
driver plans on that histogram (at most ``capacity`` numbers, whatever the
input's size) and Spark deals the pieces out:

1. Pieces longer than a fraction of the capacity fall, by length, into a few
   groups of equal cardinality; each counts as the group's longest.
2. With so few sizes, fillings (configurations) are chosen: the longest size
   left is completed by the knapsack that wastes least, and that filling is
   repeated while its sizes last.
3. Actual lengths take the places of the rounded ones; sequences with the same
   actual lengths form one run.
4. The small pieces go, longest first, where they fit best; new sequences open
   only when nothing fits.

The plan is a list of segments: "pieces of this length with ranks a to b go to
sequences s, s + 1, ... at this offset".  Each piece gets its rank among the
pieces of its length (dealt over ``CELLS`` parts, so no length is ranked by one
task) and finds its segment by binary search.

Edge cases: a null or empty text is a piece of one token (the end token).
Repeated rows are packed once each.  Only documents longer than the capacity
are cut.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe import TextEncoder
from riskloom.llm.common import small_batches, staged

CAPACITY, END_ID = 4096, 1
#: (a piece is large from capacity / this on, groups); the plan with the fewest sequences is used.
TRIALS = ((4, 16), (2, 16), (4, 64), (8, 16))
CELLS = 256

_PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField(
    "start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


@functools.cache
def library_encoder(path: str) -> TextEncoder:
    """Ids by the tokenizers library's own model, word by word; one per worker process."""
    encoder = TextEncoder(path, lambda word: [])
    tokenize = encoder.tokenizer.model.tokenize
    encoder.word_ids = lambda word: [t.id for t in tokenize(word)]
    return encoder


def cut_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: (doc_id, piece, start, length, ids_crc32)."""
    small_batches(docs.sparkSession)
    end = np.uint32(END_ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(value.as_py() or "") + end
                n = len(ids) // 4
                for k, s in enumerate(range(0, n, capacity)):
                    part = ids[4 * s:4 * (s + capacity)]
                    rows.append((doc_id, k, s, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=_PIECES.fieldNames())

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, _PIECES)


class _Plan:
    """Runs of alike sequences, and the segments of pieces that fill them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.segments: list[tuple[int, int, int, int, int]] = []
        self.taken: Counter = Counter()
        self.rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sizes: list[int] = []

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        """The next ``count`` pieces of a length, one in each sequence from ``sequence`` on."""
        rank = self.taken[length]
        self.segments.append((length, rank, rank + count, sequence, offset))
        self.taken[length] += count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def leave(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if not self.rooms[room]:
                bisect.insort(self.sizes, room)
            self.rooms[room].append((sequence, count))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            k = bisect.bisect_left(self.sizes, length)
            if k == len(self.sizes):
                n = -(-count // (self.capacity // length))
                self.leave(self.capacity, self.open(n), n)
                continue
            room = self.sizes[k]
            sequence, n = self.rooms[room].pop()
            if not self.rooms[room]:
                del self.sizes[k]
            each = min(room // length, count)
            full = min(n, count // each)
            for j in range(each):
                self.place(length, full, sequence, self.capacity - room + j * length)
            self.leave(room, sequence + full, n - full)
            self.leave(room - each * length, sequence, full)
            count -= each * full


def _groups(large: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Lengths (descending) with counts, cut into groups of equal cardinality; a length may be in two groups."""
    share = -(-sum(n for _, n in large) // groups)
    out, room = [], 0
    for length, n in large:
        while n:
            if not room:
                out.append([])
                room = share
            out[-1].append([length, min(n, room)])
            n, room = n - out[-1][-1][1], room - out[-1][-1][1]
    return out


def _completion(sizes: list[int], left: list[int], first: int, room: int) -> dict[int, int]:
    """How many of each size (index first or later) fill the room best; of equal sums, the one found first."""
    came = np.full(room + 1, -1, np.int64)
    came[0] = len(sizes)
    for k in range(first, len(sizes)):
        for _ in range(min(left[k], room // sizes[k])):
            new = np.flatnonzero((came[sizes[k]:] < 0) & (came[:len(came) - sizes[k]] >= 0))
            if not len(new):
                break
            came[new + sizes[k]] = k
    at, used = int(np.flatnonzero(came >= 0)[-1]), Counter()
    while at:
        used[int(came[at])] += 1
        at -= sizes[int(came[at])]
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments (length, first rank, rank after the last, first sequence, offset) and the number of sequences."""
    made = min((_grouped_plan(histogram, capacity, *trial) for trial in TRIALS), key=lambda p: p.sequences)
    return made.segments, made.sequences


def _grouped_plan(histogram: dict[int, int], capacity: int, large: int, groups: int) -> _Plan:
    made = _Plan(capacity)
    if n := histogram.get(capacity, 0):
        made.place(capacity, n, made.open(n), 0)
    lengths = sorted(((x, n) for x, n in histogram.items() if 0 < x < capacity and n), reverse=True)
    pools = _groups([x for x in lengths if x[0] * large > capacity], groups)
    sizes, left = [p[0][0] for p in pools], [sum(n for _, n in p) for p in pools]
    for k in range(len(sizes)):
        while left[k]:
            left[k] -= 1
            used = Counter({k: 1}) + _completion(sizes, left, k, capacity - sizes[k])
            left[k] += 1
            times = min(left[j] // u for j, u in used.items())
            for j, u in used.items():
                left[j] -= u * times
            _substitute(made, pools, [j for j in sorted(used) for _ in range(used[j])], times)
    for length, n in lengths:
        if length * large <= capacity:
            made.best_fit(length, n)
    return made


def _substitute(made: _Plan, pools: list, slots: list[int], times: int) -> None:
    """Fill ``times`` sequences, one piece a slot, with actual lengths from the slots' groups, longest first."""
    taken = []
    for j in slots:
        need, own = times, []
        while need:
            length, n = pools[j][0]
            use = min(n, need)
            own.append((length, use))
            need -= use
            if use == n:
                pools[j].pop(0)
            else:
                pools[j][0][1] -= use
        taken.append(own)
    sequence = made.open(times)
    while taken[0]:
        run = min(own[0][1] for own in taken)
        offset = 0
        for own in taken:
            length, n = own[0]
            made.place(length, run, sequence, offset)
            offset += length
            if n == run:
                own.pop(0)
            else:
                own[0] = (length, n - run)
        made.leave(made.capacity - offset, sequence, run)
        sequence += run


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    pieces = staged(cut_documents(docs, path, text, key, capacity), "pieces").withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(CELLS)).cast("int"))
    cells = staged(pieces.groupBy("length", "cell").agg(F.count("*").alias("n")), "cells")  # capacity x CELLS rows at most
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = plan(histogram, capacity)
    segments.sort()
    columns = np.array(segments, np.int64).reshape(-1, 5).T.copy()
    table = docs.sparkSession.sparkContext.broadcast(columns)  # bounded by the capacity, not by the input

    earlier = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("length", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.join(before, ["length", "cell"]).select(
        *_PIECES.fieldNames(), (F.col("before") + F.row_number().over(own) - 1).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first, _, sequence, offset = table.value
        keys = lengths * (1 << 48) + first
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                names=[*_PIECES.fieldNames(), "sequence_id", "offset"])

    return ranked.mapInArrow(run, T.StructType([*_PIECES.fields, T.StructField("sequence_id", T.LongType()),
                                                T.StructField("offset", T.LongType())]))
