"""SHA-256 of files in turns against hashlib's own."""
import hashlib
import random

import pytest

from riskloom.plans import registry as R
from riskloom.sources import checksums as S


def _files(folder):
    random.seed(4)
    made = {
        "random.parquet": random.randbytes(3_000_001),
        "ends in line feed.parquet": random.randbytes(700_000) + b"\n",
        "ends in two.parquet": random.randbytes(900_000) + b"\r\n\n",
        "line feeds.parquet": b"\n" * 400_000,
        "none%20at+all.parquet": bytes(500_000),
        "text.parquet": "ä\r\nß \n".encode() * 70_000,
        "at the limit.parquet": random.randbytes(300_000),
        "small.parquet": b"PAR1\n",
        "other.csv": random.randbytes(400_000),
    }
    for name, data in made.items():
        (folder / name).write_bytes(data)
    return {(n, hashlib.sha256(d).hexdigest(), len(d)) for n, d in made.items() if n.endswith(".parquet")}


@pytest.mark.parametrize("split", ["65536", "100000", "128m"])
def test_files_hashed_in_turns_have_their_own_sha256(spark, tmp_path, split):
    want = _files(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = S.file_checksums(spark, str(tmp_path), larger_than=300_000, turn_bytes=250_000).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {tuple(r) for r in S.file_checksums(spark, str(tmp_path)).collect()} == want


def test_no_large_file_is_read_whole(spark, tmp_path):
    want = _files(tmp_path)
    # a file beyond this limit is refused by the reader of whole files
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "300000")
    try:
        got = S.file_checksums(spark, str(tmp_path), larger_than=300_000).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {tuple(r) for r in got} == want


def test_fingerprint_of_files_beyond_the_readers_limit(spark, tmp_path, monkeypatch):
    want = _files(tmp_path)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "300000")
    monkeypatch.setattr(S.file_checksums, "__defaults__", ("*.parquet", 300_000, 1_000_000))
    try:
        got = R.QUERIES["dataset_fingerprint"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert [r[0] for r in got] == [hashlib.sha256("".join(sorted(f"{n}:{h}" for n, h, _ in want)).encode()).hexdigest()]


def test_a_state_is_taken_up_where_it_was_left():
    after, digest = S._chained_sha256()
    state = after(after(after(None, b"abc"), b""), b"d" * 1000)
    assert digest(state) == digest(state) == hashlib.sha256(b"abc" + b"d" * 1000).hexdigest()
