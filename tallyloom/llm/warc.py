"""Web archives packed in ZIP files: written by tasks, read back by ranges.

A package is a ZIP file whose members are stored: ``archive/data.warc.gz``, a gzip member per
WARC record, and ``indexes/index.cdxj``, a line per record with its place in the former. Of the
records with equal payloads one is a response and the others revisit it, without the payload.

Reading takes two steps. Tasks read the directories of packages, ZIP64 ones too, find the stored
members and cut the index into blocks of neighbouring records. The blocks are dealt out anew, and
each is read as one range of the package, which is never extracted: a package of any size is shared by
many tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zipfile
from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.tables import tidy
from tallyloom.llm.zip_directory import members, stored_range
from tallyloom.operators.hot_join import LEAST_ROWS, hot_key_join, pieces
from tallyloom.sinks.scratch import materialize

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of records after which a package is closed, of a block, and of what a task reads.
PACKAGE_BYTES, BLOCK_BYTES, TASK_BYTES = 128 << 20, 4 << 20, 32 << 20
#: Packages whose directories one task reads.
TASK_PACKAGES = 32
DATE = "2000-01-01T00:00:00Z"
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(url: str) -> str:
    """The URL with control characters percent-encoded, so that it fits a header."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _sort_key(url: str) -> str:
    """Host from its last label on, then the rest: neighbours in an index are neighbours on a site."""
    host, slash, rest = url.partition("://")[2].partition("/")
    return (",".join(reversed(host.lower().split("."))) + ")" + slash + rest).replace(" ", "%20")


def record_bytes(key: object, url: str | None, payload: bytes, refers_to: object) -> bytes:
    """A WARC record: a response, or a revisit of the record ``refers_to`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if key is None else key}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a record, fields of its HTTP response and the payload. Raises ValueError if it is damaged."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


class _Package:
    """A package that is being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid4().hex}.wacz"
        files, inner = FileSystem.from_uri(self.path)
        files.create_dir(inner.rpartition("/")[0], recursive=True)
        self.sink = files.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
        self.records = self.zip.open(RECORDS, "w", force_zip64=True)
        self.written, self.lines = 0, []

    def add(self, key: object, url: str | None, payload: bytes, refers_to: object) -> None:
        data = gzip.compress(record_bytes(key, url, payload, refers_to), 6, mtime=0)
        self.records.write(data)
        place = {"url": url, "filename": RECORDS, "offset": self.written, "length": len(data)}
        self.lines.append(f"{_sort_key(_one_line(url or ''))} {DATE} {json.dumps(place)}\n")
        self.written += len(data)

    def close(self) -> tuple[str, int, int]:
        self.records.close()
        self.zip.writestr(INDEX, "".join(sorted(self.lines)))
        self.zip.close()
        size = self.sink.tell()
        self.sink.close()
        return self.path, size, len(self.lines)


def write_packages(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
    hot_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Writes a record per row below ``folder``; path, bytes and records of each package.

    The payload is the column's UTF-8, of a null none. Of rows with equal payloads of at least ``least_bytes``
    those of the largest key are responses and the others revisit them; smaller payloads are all
    responses. A null key is smaller than any other: alone, it is a response. Rows that repeat a key and
    payload become records alike. Control characters of a URL are percent-encoded, a null URL has no field. Other
    columns are not read. No rows give no packages. ``folder`` must be reached by all executors. Only
    packages in the result count: a task that was lost may leave others behind.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(payload, F.lit("")).cast("binary").alias("payload")
    ).withColumn("sum", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least_bytes
    groups = materialize(
        rows.where(large)
        .groupBy("sum")
        .agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1),
        "warc_groups",
    )
    told = hot_key_join(
        rows, groups.drop("copies"), ["sum"], pieces(groups, ["sum"], "copies", least=hot_rows), ["key", "url"], "left"
    ).select(
        "key", "url", "payload", F.when(~F.col("key").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(("path", "bytes", "records"), package.close()))])

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for row in range(batch.num_rows):
                package = package or _Package(folder)
                package.add(*(column[row].as_py() for column in columns))
                if package.written >= package_bytes:
                    yield closed()
                    package = None
        if package:
            yield closed()

    return told.mapInArrow(tidy(run), "path string, bytes long, records long")


def _blocks(path: str) -> list[dict]:
    """Neighbouring records of a package: place of the first and the length of each."""
    files, inner = FileSystem.from_uri(path)
    with files.open_input_file(inner) as source:

        def read(offset: int, length: int) -> bytes:
            return source.read_at(length, offset)

        of = {member.name: member for member in members(read, source.size())}
        lines = read(*stored_range(read, of[INDEX])).decode().splitlines() if INDEX in of else []
        starts = {name: stored_range(read, of[name])[0] for name in of if name.startswith("archive/")}
    places = []
    for line in lines:
        entry = json.loads(line.split(" ", 2)[2])
        places.append((starts[entry["filename"]] + int(entry["offset"]), int(entry["length"])))
    blocks: list[dict] = []
    for start, length in sorted(places):
        last = blocks[-1] if blocks else None
        if last and last["start"] + last["length"] == start and last["length"] + length <= BLOCK_BYTES:
            last["length"] += length
            last["lengths"].append(length)
        else:
            blocks.append({"path": path, "start": start, "length": length, "lengths": [length]})
    return blocks


_BLOCK = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("lengths", pa.list_(pa.int64()))]
)
_RECORD = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _bare(identifier: str | None) -> str | None:
    return None if identifier is None else identifier.strip("<>")


def _read_record(data: bytes, with_payload: bool) -> dict:
    fields, http, payload = parse_record(gzip.decompress(data))
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size = len(payload)
    if kind == "revisit":
        size = int(http["content-length"]) if "content-length" in http else None
    elif digest and digest != payload_digest(payload):
        raise ValueError("a payload that is not what its digest says")
    return {
        "record_id": _bare(fields.get("warc-record-id")),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _bare(fields.get("warc-refers-to")),
        "payload": payload if with_payload and kind != "revisit" else None,
    }


def read_packages(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row per record of the packages of (path, bytes): record_id, record_type, target_uri, payload_bytes and
    payload_digest of the full payload (of a revisit, as it says), refers_to and payload (null unless
    ``with_payload``, and of a revisit).

    Packages may be of any size and order, and hold several archives; records are found by their
    index. Payloads are held against their digests. Raises ValueError at a damaged package or record, and at
    members that are compressed. Packages without an index, and no packages, give no rows.
    """
    count, size = packages.agg(F.count(F.lit(1)), F.sum("bytes")).first()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist(_blocks(path), schema=_BLOCK)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                files, inner = FileSystem.from_uri(block["path"])
                with files.open_input_file(inner) as source:
                    data = memoryview(source.read_at(block["length"], block["start"]))
                rows, at = [], 0
                for length in block["lengths"]:
                    rows.append(_read_record(data[at : at + length], with_payload))
                    at += length
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    blocks = (
        packages.select("path")
        .repartition(max(1, ceil(count / TASK_PACKAGES)), "path")
        .mapInArrow(find, "path string, start long, length long, lengths array<long>")
    )
    return blocks.repartition(max(1, ceil((size or 0) / TASK_BYTES)), "path", "start").mapInArrow(
        tidy(read),
        "record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, "
        "refers_to string, payload binary",
    )


def key_of(column: str, kind: str = "long") -> Column:
    """The key of the row whose record a record id names; null if it had none."""
    return F.regexp_extract(column, f"^{_ID}(.*)$", 1).try_cast(kind)
