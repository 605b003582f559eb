"""N-gram Jaccard join by count vectors in R-trees.

A document is the set of its hashed word shingles.  The shingles are hashed
into groups; the counts of the groups are a point, and the sum of the smaller
coordinates of two points bounds the overlap of the sets from above.  Points
are packed into R-trees whose nodes keep the largest coordinates (and smallest
set) below them, so the same sum against a node bounds every point in it.
Surviving pairs are verified on the sets themselves.

One tree over all documents would prune nothing above its leaves, as the
counts of unrelated texts all lie close together; so the trees' upper level is
a routing that keeps every pair that can link:

1. ``sketch``: how many documents have each hashed shingle, about (a table of
   fixed size, summed over all documents).  It orders shingles, rare first.
2. Sets that are equal collapse to the one with the smallest id.
3. ``cells``: two sets that link share one of the first
   ``n - ceil(0.8 n) + 1`` shingles of each in that order.  Sets that share
   one meet in a cell; cells of the same sets are one cell.
4. In each cell an R-tree joins the points; a spanning forest of the pairs
   that pass the bound is kept.  In very large cells (the sketch knows them)
   all sets are tied to the first one instead, without a bound.
5. What is tied together forms a room: a superset of linked documents.  In each
   room a tree over finer points proposes pairs, their sets are compared, and
   pairs that are already connected are skipped.
6. Rooms of more than ``ROOM`` shingles are dealt into blocks, each with the
   room's first set; then only the sets not yet connected to that one meet the
   other blocks.  So a group of copies costs in proportion to its size.

Edge cases: a null or empty text, or one of white space, has no shingles and is
linked with nothing; fewer than five words are one shingle.  Repeated rows and
equal sets link.  Rows whose id is null or repeated are told apart by a key of
their own; a component's id is then the smallest one of its rows, null if all
are null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, staged, star_components, utf8_pieces
from riskloom.llm.words import mix, shingle_hashes, word_bounds, word_hashes

SIZE, PERCENT = 5, 80
#: Counters of the sketch (a power of two) and the pieces in which they travel.
SKETCH_BITS, SKETCH_PIECES = 20, 64
#: A shingle is hot when its counter exceeds both this and so many times the mean counter.
HOT, HOT_MEAN = 2000, 16
#: The most sets of a cell that a tree joins, and the most shingles (and sets) of a room's block.
CELL, ROOM, ROOM_SETS = 2000, 2_000_000, 2000
FAN = 16
#: The parts over which the rows of equal sets are dealt.
SALTS = 1024


def needed(a, b, percent: int = PERCENT):
    """The least overlap of sets of these sizes with a Jaccard similarity of at least ``percent``."""
    return -(-percent * (a + b) // (100 + percent))


def text_sets(texts: pa.Array, size: int = SIZE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    for _, _, data, at in utf8_pieces(texts):
        starts, ends, heads = word_bounds(data, at)
        words = word_hashes(data, starts, ends)
        for k in range(len(at) - 1):
            yield np.unique(shingle_hashes(words[heads[k]:heads[k + 1]], size))


def groups_for(n):
    """How many groups a set of n shingles is counted in: a power of two, about one for eight shingles."""
    return 1 << np.clip(np.ceil(np.log2(np.maximum(n, 1) / 8)), 5, 11).astype(int)


def point(own: np.ndarray, groups: int) -> np.ndarray:
    """Group counts of a set; the group is the low bits of the mixed hash, so halves fold onto each other."""
    return np.bincount((mix(own) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


class CountTree:
    """A packed R-tree over points in the order of their set sizes."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray, percent: int = PERCENT) -> None:
        self.percent, self.levels = percent, [(sizes, points)]
        while len(sizes) > FAN:
            at = np.arange(0, len(sizes), FAN)
            sizes, points = np.minimum.reduceat(sizes, at), np.maximum.reduceat(points, at, 0)
            self.levels.append((sizes, points))

    def after(self, i: int) -> np.ndarray:
        """The points behind i, with sets not smaller, whose overlap with i may suffice."""
        n, own = self.levels[0][0][i], self.levels[0][1][i]
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            sizes, points = self.levels[depth]
            nodes = nodes[(nodes + 1) * FAN ** depth > i + 1]
            nodes = nodes[sizes[nodes] * self.percent <= n * 100]
            bound = np.minimum(points[nodes], own).sum(1)
            nodes = nodes[bound >= needed(n, np.maximum(sizes[nodes], n), self.percent)]
            if depth:
                nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1][0])]
        return nodes[nodes > i]


class Ties:
    """Which of k things are connected."""

    def __init__(self, labels: np.ndarray) -> None:
        self.label = labels

    def join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]


def tied_in_cell(ids: np.ndarray, sizes: np.ndarray, raws: list[bytes]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of a cell that pass the bound."""
    ties = Ties(np.arange(len(ids)))
    groups = groups_for(sizes)
    for g in np.unique(groups):  # sizes of a link differ by a quarter at most, so their groups by a factor of two
        own = np.flatnonzero((groups == g) | (groups == 2 * g))
        own = own[np.argsort(sizes[own], kind="stable")]
        points = np.stack([np.frombuffer(raws[k], np.uint16).astype(np.int64).reshape(-1, g).sum(0) for k in own])
        tree = CountTree(sizes[own], points)
        for i in range(len(own) - 1):
            for j in tree.after(i):
                a, b = own[i], own[j]
                if ties.label[a] != ties.label[b]:
                    ties.join(a, b)
                    yield int(ids[a]), int(ids[b])


def linked_in_room(ids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, guest: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between sets, as many as connect what they connect; pairs that ``labels`` connects, or without a guest, are skipped.

    ``labels`` holds ids; where no row is a guest every pair counts.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, labels, guest, sets = ids[order], labels[order].copy(), guest[order], [sets[k] for k in order]
    sizes = np.array([len(s) for s in sets])
    ties, every = Ties(labels), not guest.any()
    start = 0
    while start < len(sets):  # points of like sizes, so that small sets need no fine groups
        stop = int(np.searchsorted(sizes, 2 * sizes[start], "right"))
        groups = int(min(2048, 4 * groups_for(sizes[start])))
        last = int(np.searchsorted(sizes, sizes[stop - 1] * 100 // PERCENT, "right"))
        tree = CountTree(sizes[start:last], np.stack([point(s, groups) for s in sets[start:last]]))
        for i in range(start, stop):
            near = tree.after(i - start) + start
            near = near[(every | guest[i] | guest[near]) & (ties.label[near] != ties.label[i])]
            while len(near):
                j, near = near[0], near[1:]
                same = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if same >= needed(len(sets[i]), len(sets[j])):
                    ties.join(i, j)
                    near = near[ties.label[near] != ties.label[i]]
                    yield int(ids[i]), int(ids[j])
        start = stop


def sketch(docs: DataFrame, text: str) -> np.ndarray:
    """How many sets have a shingle of each hash prefix: 2^SKETCH_BITS sums over all documents."""
    width = (1 << SKETCH_BITS) // SKETCH_PIECES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            for own in text_sets(batch.column(0)):
                held.append((own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                if len(held) >= 2000:
                    sums += np.bincount(np.concatenate(held), minlength=len(sums))
                    held = []
            if held:
                sums += np.bincount(np.concatenate(held), minlength=len(sums))
        lane = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(SKETCH_PIECES), pa.int32()), pa.array([lane] * SKETCH_PIECES, pa.int32()),
            pa.array([s.tobytes() for s in sums.astype(np.uint32).reshape(SKETCH_PIECES, width)], pa.binary())],
            names=["piece", "lane", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, raw in zip(batch.column(0).to_pylist(), batch.column(2)):
                more = np.frombuffer(raw.as_py(), np.uint32)
                sums[piece] = np.minimum(sums[piece].astype(np.int64) + more, 2 ** 32 - 1).astype(np.uint32) if piece in sums else more
        for piece, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([0], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["piece", "lane", "sums"])

    schema = "piece int, lane int, sums binary"
    parts = docs.select(text).mapInArrow(count, schema).repartition("piece", "lane").mapInArrow(add, schema)
    found = parts.repartition("piece").mapInArrow(add, schema).collect()  # SKETCH_PIECES rows, 4 MB in all
    out = np.zeros((SKETCH_PIECES, width), np.uint32)
    for row in found:
        out[row["piece"]] += np.frombuffer(row["sums"], np.uint32)
    return out.ravel()


def described(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, n, h1, h2, point, cold, hot) of every row: set size, set hash, group counts and the shingles that route it."""
    spark = docs.sparkSession
    counters = spark.sparkContext.broadcast(sketch(docs, text))  # 4 MB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counters.value
        hot_from = max(HOT, HOT_MEAN * float(table.mean()))
        for batch in batches:
            rows = []
            for own in text_sets(batch.column(1)):
                n = len(own)
                if not n:
                    rows.append((0, 0, 0, b"", [], []))
                    continue
                seen = table[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                chosen = np.argsort(seen, kind="stable")[:n - (-(-PERCENT * n // 100)) + 1]  # by counter, then by hash
                marks, warm = own[chosen].view(np.int64), seen[chosen] >= hot_from
                rows.append((n, int(mix(own ^ np.uint64(0xA5A5A5A5)).sum().view(np.int64)),
                             int(mix(own + np.uint64(0x5BD1E995)).sum().view(np.int64)),
                             np.minimum(point(own, int(groups_for(n))), 65535).astype(np.uint16).tobytes(),
                             marks[~warm], marks[warm]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, kinds)]], names=[
                "doc_id", "n", "h1", "h2", "point", "cold", "hot"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return staged(rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, point binary, cold array<long>, hot array<long>"), "sets")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each value of the first ``keys`` columns, from batches sorted by them."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        marks = np.stack([table.column(k).to_numpy() for k in range(keys)])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist(), table.num_rows]
        for s, e in zip(bounds, bounds[1:]):
            now = tuple(marks[:, s])
            if held and now != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(s, e - s))
            last = now
    if held:
        yield pa.concat_tables(held)


def edges_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _tied(firsts: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) that keep together all that may link, from one row for each distinct set (and the points in ``sets``)."""
    from pyspark.sql import Window

    marks = firsts.select(F.explode("cold").alias("mark"), F.col("doc_id").alias("a"))
    cell = Window.partitionBy("mark")
    shared = marks.select("a", F.count("*").over(cell).alias("k"), F.bit_xor(F.xxhash64("a")).over(cell).alias("cell"),
                          F.min("a").over(cell).alias("b")).where("k > 1")
    shared = staged(shared.groupBy("cell", "k", "a").agg(F.min("b").alias("b")), "cells")
    # a hot shingle's sets are tied to the first of them: sums with map-side combine, then a join that Spark may split
    hot = firsts.where(F.size("hot") > 0).select(F.explode("hot").alias("mark"), F.col("doc_id").alias("a"))
    tied = hot.join(hot.groupBy("mark").agg(F.min("a").alias("b")), "mark").select("a", "b")
    large = shared.where(F.col("k") > CELL).select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 2):
            found = list(tied_in_cell(rows.column(2).to_numpy(), rows.column(3).to_numpy(), rows.column(4).to_pylist()))
            if found:
                yield edges_of(found)

    small = shared.where(F.col("k") <= CELL).select("cell", "k", "a").join(
        sets.select(F.col("doc_id").alias("a"), "n", "point").hint("merge"), "a").select("cell", "k", "a", "n", "point")
    small = small.repartition("cell", "k").sortWithinPartitions("cell", "k").mapInArrow(run, "a long, b long")
    return small.unionByName(large).unionByName(tied)


def _links(rows: DataFrame) -> DataFrame:
    """Verified links of rooms dealt to (room, block, part): rows also have a, label, guest and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in runs(batches, 3):
            texts = own.column(6).combine_chunks()
            texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
            found = list(linked_in_room(own.column(3).to_numpy(), list(text_sets(texts)), own.column(4).to_numpy().copy(),
                                        own.column(5).to_numpy(zero_copy_only=False)))
            if found:
                yield edges_of(found)

    keys = ["room", "block", "part"]
    rows = rows.select(*keys, "a", "label", "guest", "text").repartition(*keys).sortWithinPartitions(*keys)
    return staged(rows.mapInArrow(run, "a long, b long"), "links")


def _owners(sets: DataFrame) -> DataFrame:
    """(doc_id, n, first) of every row: the smallest id among the rows of its set, its own where there is no other.

    A set may be that of a third of all rows: its rows are dealt over ``SALTS`` parts, which are aggregated before
    they meet, and the set's first id is given to each part that occurs.  Sets of one row aren't joined at all.
    """
    same = ["n", "h1", "h2"]
    rows = sets.select("doc_id", *same, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    parts = rows.where("n > 0").groupBy(*same, "salt").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("x"))
    whole = parts.groupBy(*same).agg(F.min("m").alias("first"), F.max("x").alias("x"), F.collect_list("salt").alias("salts"))
    given = whole.where("first <> x").select(*same, F.explode("salts").alias("salt"), "first")
    return rows.join(given.hint("merge"), [*same, "salt"], "left").select("doc_id", "n", F.coalesce("first", "doc_id").alias("first"))


def own_ids(docs: DataFrame, key: str = "doc_id") -> bool:
    """Whether every row has an id, and one that no other row has."""
    return not docs.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n")).where("k is null or n > 1").limit(1).count()


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest id that links reach, its own included."""
    if own_ids(docs, key):
        return components_by_key(docs, text, key)
    rows = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
                              F.col(text).alias("text")), "rows")
    found = components_by_key(rows, "text", "row").withColumnRenamed("doc_id", "row")
    # a component may be that of a third of all rows: dealt over parts, as in _owners
    found = staged(found.join(rows.select("row", "id").hint("merge"), "row").withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.lit(SALTS))), "found")
    parts = found.groupBy("component_id", "salt").agg(F.min("id").alias("m"))
    whole = parts.groupBy("component_id").agg(F.min("m").alias("least"), F.collect_list("salt").alias("salts"))
    given = whole.select("component_id", F.explode("salts").alias("salt"), "least")
    return found.join(given.hint("merge"), ["component_id", "salt"]).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))


def components_by_key(docs: DataFrame, text: str, key: str) -> DataFrame:
    """As ``jaccard_components``, for keys that are neither null nor repeated."""
    small_batches(docs.sparkSession)
    sets = described(docs, text, key)
    owners = staged(_owners(sets), "owners")
    copies = owners.where("doc_id <> first").select("doc_id")
    # joins whose sides both grow with the input are merge joins at every size, none a broadcast
    firsts = sets.where("n > 0").join(copies.hint("merge"), "doc_id", "left_anti")

    rooms = star_components(_tied(firsts, sets))
    rooms = rooms.unionByName(rooms.select(F.col("component").alias("node"), "component").distinct())
    rooms = rooms.join(owners.groupBy(F.col("doc_id").alias("node")).agg(F.max("n").alias("n")), "node")
    sizes = rooms.groupBy("component").agg(_parts_of_sum())
    members = staged(rooms.join(sizes, "component").select(
        F.col("component").alias("room"), F.col("node").alias("a"), "n", "blocks"), "members")
    texts = docs.select(F.col(key).cast("long").alias("a"), F.col(text).alias("text"))
    at_home = members.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pivots = at_home.where("a = room and blocks > 1").withColumn("home", F.col("block")).withColumn("block", everywhere).where(
        "block <> home").drop("home")
    fixed = {"part": F.lit(0), "label": F.col("a"), "guest": F.lit(False)}
    links = _links(at_home.unionByName(pivots).join(texts.hint("merge"), "a").withColumns(fixed))

    if members.where("blocks > 1").limit(1).count():
        links = links.unionByName(_straggler_links(at_home.where("blocks > 1"), links, texts))
    reached = star_components(links)
    return owners.join(reached.withColumnRenamed("node", "first"), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"))


def _parts_of_sum():
    sets, size = F.count("*"), F.sum("n")
    return F.greatest(F.ceil(sets / ROOM_SETS), F.ceil(size / ROOM), F.lit(1)).cast("int").alias("blocks")


def _straggler_links(at_home: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of the sets of large rooms that the room's first set has not reached: each meets every block of its room."""
    known = star_components(links)
    at_home = staged(at_home.join(known.withColumnRenamed("node", "a"), "a", "left").select(
        "room", "a", "n", "blocks", "block", F.coalesce("component", "a").alias("label")), "reached")
    main = at_home.where("a = room").select("room", F.col("label").alias("main"))
    guests = at_home.join(main, "room").where("label <> main").drop("main")
    parts = guests.groupBy("room").agg(_parts_of_sum()).withColumnRenamed("blocks", "parts")
    guests = guests.join(parts, "room").withColumn("part", F.pmod(F.xxhash64("a", F.lit(1)), F.col("parts")).cast("int"))
    visits = guests.withColumn("home", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # in a part of a block: its residents (but for the part's own guests) and the part's guests
    residents = at_home.join(parts, "room").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    residents = residents.join(guests.select("a", F.col("part").alias("own")), "a", "left").where("own is null or own <> part")
    columns = ["room", "block", "part", "a", "label"]
    rows = visits.select(*columns).withColumn("guest", F.lit(True)).unionByName(
        residents.select(*columns).withColumn("guest", F.lit(False)))
    return _links(rows.join(texts.hint("merge"), "a"))
