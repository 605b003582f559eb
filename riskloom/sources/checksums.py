"""SHA-256 of files of any size.

SHA-256 is a chain: a block of a file needs the state after the block before, so one file's blocks can't be hashed side by
side.  They needn't be hashed by one task either: the state is 112 bytes and can be handed on.  A large file is cut
where Spark cuts text files, its bytes are staged once, and in turn after turn a task takes up the state of the
turn before and hashes a bounded stretch of it.  Files are independent, so a turn hashes its stretch of all of them at once.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Files up to this size are hashed whole; of larger ones a turn hashes about TURN_BYTES, staged in rows of at most BLOCK_BYTES.
LARGE_FILE, TURN_BYTES, BLOCK_BYTES = 256 << 20, 128 << 20, 4 << 20

MSG_UNREAD = "{name}: {done} of {size} bytes were read."


def _chained_sha256():
    """(the state after more bytes, the hex digest of a state), or None where Python's own libcrypto can't be called: hashlib doesn't
    hand out its state.  Made here, so that the tasks need no import of this module."""
    def library():
        import ctypes

        import _hashlib
        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        return lib, ctypes.c_uint32 * 28  # SHA256_CTX

    def context(state: bytes | None):
        lib, kind = library()
        if state:
            return lib, kind.from_buffer_copy(state)
        held = kind()
        lib.SHA256_Init(held)
        return lib, held

    def after(state: bytes | None, data: bytes) -> bytes:
        lib, held = context(state)
        lib.SHA256_Update(held, data, len(data))
        return bytes(held)

    def digest(state: bytes) -> str:
        import ctypes
        lib, held = context(state)
        out = ctypes.create_string_buffer(32)
        lib.SHA256_Final(out, held)
        return out.raw.hex()

    try:
        digest(after(None, b""))
    except (ImportError, AttributeError, OSError):
        return None
    return after, digest


def _staged_bytes(spark: SparkSession, folder: str, pattern: str, larger_than: int, turn_bytes: int) -> DataFrame:
    """(file, start, seq, data, turn): the bytes of the large files in rows, in the order of start and seq, staged by turn.

    The text reader cuts a file at any byte and gives its lines as they are; a line's end is put back.  The last line gets one too,
    which is one byte too many unless the file ends so.  A stretch without a line feed is one row (up to 2 GB, as for ``binaryFile``)."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(folder).where(F.col("_metadata.file_size") > larger_than)
    lines = lines.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                         F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"))
    block = BLOCK_BYTES

    def joined(batches):
        seq = 0
        for batch in batches:
            # lines of one split come one after another
            file, start = batch["file"], batch["start"]
            new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1]))
            ends = [int(i) + 1 for i in np.flatnonzero(new.to_numpy(zero_copy_only=False))]
            for a, b in zip([0, *ends], [*ends, batch.num_rows]):
                data = b"".join(batch["line"].slice(a, b - a).to_pylist())
                for at in range(0, len(data), block):
                    yield pa.RecordBatch.from_pylist([{"file": file[a].as_py(), "start": start[a].as_py(), "seq": seq, "data": data[at:at + block]}])
                    seq += 1

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/checksums-{uuid.uuid4().hex}"
    rows = lines.mapInArrow(joined, "file string, start long, seq long, data binary")
    # bytes of compressed files: neither a dictionary nor a codec would make them smaller
    rows.withColumn("turn", F.floor(F.col("start") / turn_bytes)).write.partitionBy("turn").option("compression", "none") \
        .option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema("file string, start long, seq long, data binary, turn long").parquet(path)


def _large_checksums(spark: SparkSession, folder: str, pattern: str, larger_than: int, turn_bytes: int, sizes: dict[str, int]) -> dict[str, str]:
    """file -> SHA-256 of the files larger than ``larger_than``, whose ``sizes`` are given."""
    after, digest = _chained_sha256()
    staged = _staged_bytes(spark, folder, pattern, larger_than, turn_bytes)
    reached: dict[str, tuple[bytes | None, int]] = {}  # a state and a count a file

    for turn in range(max(sizes.values()) // turn_bytes + 1):
        before = dict(reached)

        def hashed(batches, before=before):
            now = dict(before)
            seen = set()
            for batch in batches:
                for file, data in zip(batch["file"].to_pylist(), batch["data"].to_pylist()):
                    state, done = now.get(file, (None, 0))
                    data = data[:max(0, sizes[file] - done)]
                    now[file] = after(state, data), done + len(data)
                    seen.add(file)
            yield pa.RecordBatch.from_pylist([{"file": f, "state": now[f][0], "done": now[f][1]} for f in seen],
                                             pa.schema([("file", pa.string()), ("state", pa.binary()), ("done", pa.int64())]))

        part = staged.where(F.col("turn") == turn).repartition(len(sizes), "file").sortWithinPartitions("file", "start", "seq")
        made = part.select("file", "data").mapInArrow(hashed, "file string, state binary, done long")
        reached |= {r["file"]: (bytes(r["state"]), r["done"]) for r in made.collect()}
    for file, size in sizes.items():
        done = reached.get(file, (None, 0))[1]
        if done != size:
            raise ValueError(MSG_UNREAD.format(name=file, done=done, size=size))
    return {file: digest(state) for file, (state, _) in reached.items()}


def file_checksums(spark: SparkSession, folder: str, pattern: str = "*.parquet", larger_than: int = LARGE_FILE,
                   turn_bytes: int = TURN_BYTES) -> DataFrame:
    """(name, sha256, size_bytes), one row a file of ``folder`` whose name fits ``pattern``.

    Files up to ``larger_than`` bytes are hashed whole, each by one task.  A larger one is staged in the checkpoint folder and hashed in
    stretches of about ``turn_bytes``, one job a stretch; the driver holds one state a file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name, size = F.regexp_extract("path", r"[^/]+$", 0).alias("name"), F.col("length").alias("size_bytes")
    whole = files.select(name, F.sha2("content", 256).alias("sha256"), size)
    if _chained_sha256() is None:
        return whole
    large = files.where(F.col("length") > larger_than).select(name, size, "_metadata.file_name").collect()  # one row a file
    if not large:
        return whole
    found = _large_checksums(spark, folder, pattern, larger_than, turn_bytes, {r["file_name"]: r["size_bytes"] for r in large})
    rows = [(r["name"], found[r["file_name"]], r["size_bytes"]) for r in large]
    small = files.where(F.col("length") <= larger_than).select(name, F.sha2("content", 256).alias("sha256"), size)
    return small.unionByName(spark.createDataFrame(rows, "name string, sha256 string, size_bytes long"))
