"""WARC archives: written whole, normalised to one gzip member a record with an index beside, and read back.

``write_archives`` makes archives that are one gzip stream each, as many
crawlers do.  ``normalise`` inflates each such file once, as a stream, rewrites
every record as a member of its own and writes a sidecar (``.idx``: one JSON
line a record with its offset and length).  ``read_records`` opens members by
these offsets.

All files lie in the shared checkpoint folder and are opened through Arrow's
file systems.  A task writes under a name of its own and then moves the file
to its final name, so a task that is run again replaces what it wrote.

Edge cases: a null payload is empty; a null URL gives no target; a null id is
written as ``none`` and read back as null.  Of records with equal payloads all
rows with the largest id are responses (so repeated rows are), the others
revisit that id.  Signs that a header can't hold are percent-encoded.  Very
long payloads pass through the normaliser in pieces.  No row, no file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import shared_path, staged

#: Bytes before compression at which a writer begins its next file.
FILE_BYTES = 64 << 20
_PIECE = 1 << 18
#: Parts that the pages of one payload are dealt over.
SALTS = 1024
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "archive string, offset long, length long, record_id string, record_type string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='/:?#[]@!$&()*+,;=%~')}")
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``refers_to``: the largest id among the equal payloads, null for that record itself.

    A payload may be that of a third of all pages: its rows are dealt over ``SALTS`` parts, which are aggregated before
    they meet, and its response is given to each part that occurs; so no task joins, or then writes, all of them.
    """
    raw = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    keyed = pages.withColumns({"_sha": F.sha2(raw, 256), "_size": F.octet_length(raw)})
    keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    parts = keyed.where(F.col("_size") >= least_bytes).groupBy("_sha", "_salt").agg(F.max(key).alias("_m"), F.count("*").alias("_n"))
    whole = parts.groupBy("_sha").agg(F.max("_m").alias("_response"), F.sum("_n").alias("_n"), F.collect_list("_salt").alias("_salts"))
    shared = whole.where("_n > 1").select("_sha", F.explode("_salts").alias("_salt"), "_response")
    joined = keyed.join(shared, ["_sha", "_salt"], "left")
    other = F.col("_response").isNotNull() & ~F.col("_response").eqNullSafe(F.col(key))
    return joined.withColumn("refers_to", F.when(other, F.col("_response"))).drop("_sha", "_size", "_salt", "_response")


class _Out:
    """A file that gets its final name when it is closed."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = _open(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.own = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.stream, self.size = self.fs.open_output_stream(self.own, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.own, self.path)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record a row (a row with ``refers_to`` is a revisit); each file is one gzip stream. Returns (archive, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, out, squeeze, raw, records = TaskContext.get().partitionId(), [], None, None, 0, 0

        def finish() -> None:
            out.write(squeeze.flush())
            out.close()
            made.append((f"{folder}/whole-{part:06d}-{len(made):06d}.warc.gz", records))

        for batch in batches:
            for page_id, target, text, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    out = _Out(f"{folder}/whole-{part:06d}-{len(made):06d}.warc.gz")
                    squeeze, raw, records = zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                data = record(page_id, target, (text or "").encode(), refers_to, date)
                out.write(squeeze.compress(data))
                raw, records = raw + len(data), records + 1
                if raw >= FILE_BYTES:
                    finish()
                    out = None
        if out is not None:
            finish()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*made)], names=["archive", "records"])

    rows = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(payload).cast("string"), F.col("refers_to").cast("long"))
    return staged(rows.mapInArrow(run, "archive string, records long"), "archives")


class Inflated:
    """The bytes inside a gzip file of one or more members, read as a stream."""

    def __init__(self, stream) -> None:
        self.stream, self.inflate, self.held = stream, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        while True:
            if self.inflate.eof:
                rest = self.inflate.unused_data
                if not rest and not (rest := self.stream.read(_PIECE)):
                    return False
                self.inflate = zlib.decompressobj(31)
            elif not (rest := self.inflate.unconsumed_tail or self.stream.read(_PIECE)):
                raise EOFError("the gzip stream ends inside a member")
            got = self.inflate.decompress(rest, 4 * _PIECE)
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with the mark; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise EOFError("the archive ends inside a record's header")
                return None
        out = bytes(self.held[:at + len(mark)])
        del self.held[:at + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise EOFError("the archive ends inside a record")
            out = bytes(self.held[:n])
            del self.held[:n]
            n -= len(out)
            yield out


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:]) if k}


def normalise_file(archive: str, target: str) -> list[tuple]:
    """Rewrite every record of an archive as its own member of ``target``, with ``target``.idx beside it; the index rows."""
    fs, path = _open(archive)
    out, rows = _Out(target), []
    with fs.open_input_stream(path, compression=None) as stream:
        source = Inflated(stream)
        while (head := source.until(_END)) is not None:
            fields, start, squeeze = _fields(head), out.size, zlib.compressobj(6, zlib.DEFLATED, 31)
            out.write(squeeze.compress(head))
            for piece in source.pieces(int(fields["content-length"]) + len(_END)):
                out.write(squeeze.compress(piece))
            out.write(squeeze.flush())
            rows.append((target, start, out.size - start, fields["warc-record-id"], fields["warc-type"]))
    out.close()
    side = _Out(f"{target}.idx")
    for row in rows:
        side.write(json.dumps(dict(zip(("offset", "length", "record_id", "record_type"), row[1:]))).encode() + b"\n")
    side.close()
    return rows


def normalise(archives: DataFrame) -> DataFrame:
    """Normalise every archive (column ``archive``); the rows of all sidecars: (archive, offset, length, record_id, record_type)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = normalise_file(archive, archive.replace("/whole-", "/member-"))
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=[
                    "archive", "offset", "length", "record_id", "record_type"])

    spread = archives.select("archive").repartition(max(1, archives.count()))  # a file is a task's unit of work
    return staged(spread.mapInArrow(run, INDEX), "index")


def parse(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record; a response's payload is checked."""
    head, _, rest = data.partition(_END)
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(_END)
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not what its header says")
    return _page(fields["warc-record-id"]), size, digest, fields["warc-type"], _page(fields.get("warc-refers-to"))


def read_records(index: DataFrame) -> DataFrame:
    """The records at the index's offsets: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, stream = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*[c.to_pylist() for c in batch.columns[:3]]):
                if archive != opened:
                    if stream is not None:
                        stream.close()
                    fs, path = _open(archive)
                    opened, stream = archive, fs.open_input_file(path)
                stream.seek(offset)
                rows.append(parse(zlib.decompress(stream.read(length), 31)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=[x.split()[0] for x in RECORDS.split(", ")])
        if stream is not None:
            stream.close()

    return index.select("archive", "offset", "length").mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back every page: the records as the archives hold them."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_records(normalise(write_archives(with_revisits(pages, least_bytes=least_bytes), folder)))
