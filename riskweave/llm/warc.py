"""WARC records in ZIP packages, read by range.

A package is a ZIP file with two stored members: ``archive/data.warc.gz`` (one
gzip member per record) and ``indexes/index.jsonl`` (offset and length of each
record in it).  The reader takes only what it needs: the end of the file, the
central directory (ZIP64 too), the index, then ranges of records; nothing is
extracted.  Packages lie in shared storage and are opened by URI.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
#: A package is closed at this many bytes or records, whichever comes first.
PACKAGE_BYTES = 256 << 20
PACKAGE_RECORDS = 100_000
#: Bytes of records that are read at once.
RANGE_BYTES = 4 << 20
#: Tasks that packages or ranges are dealt to.
MAX_TASKS = 20_000
#: Payloads smaller than this are never revisits.
MIN_REVISIT_BYTES = 0

RECORD_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
                 "payload_bytes long, payload_digest string, payload binary")


def file_system(uri: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(record_id: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit of an
    identical payload with the HTTP head only (whose Content-Length is the
    full payload's)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    uri = "".join(c for c in uri if c >= " ")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
             f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", "Content-Type: application/http; msgtype=response"]
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """A row of RECORD_SCHEMA; the digest of a response is computed and must
    equal the one it states."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next((int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")),
                len(payload))
    digest = named["warc-payload-digest"].removeprefix("sha1:")
    if named["warc-type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of {named['warc-record-id']} is damaged")
    refers = named.get("warc-refers-to")
    return (named["warc-record-id"].strip("<>"), named["warc-type"], named.get("warc-target-uri"),
            refers.strip("<>") if refers else None, size, digest,
            payload if named["warc-type"] == "response" else None)


class Package:
    """Writer of one package; records go straight to storage, the index follows."""

    def __init__(self, folder: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.zip"
        system, path = file_system(self.uri)
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, record_id: str, record: bytes) -> None:
        packed = zlib.compressobj(1, zlib.DEFLATED, 31)
        raw = packed.compress(record) + packed.flush()
        self.data.write(raw)
        self.index.append(json.dumps({"id": record_id, "offset": self.at, "length": len(raw)}))
        self.at += len(raw)

    def full(self) -> bool:
        return self.at >= PACKAGE_BYTES or len(self.index) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index), self.at


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write ``record_id, uri, payload, refers_to`` rows; ``path, records, bytes``
    of the packages.

    The list of packages is committed as a table: a task that is run again
    writes packages of its own, and those of its lost attempt are in no list.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)

    def run(batches: Iterator) -> Iterator:
        package, frame = None, None
        for pdf in batches:
            frame = type(pdf)
            for record_id, uri, payload, refers in zip(pdf["record_id"], pdf["uri"], pdf["payload"], pdf["refers_to"]):
                package = package or Package(folder)
                package.add(record_id, make_record(record_id, uri, bytes(payload), refers))
                if package.full():
                    yield frame([package.close()], columns=["path", "records", "bytes"])
                    package = None
        if package:
            yield frame([package.close()], columns=["path", "records", "bytes"])

    return materialize(records.select("record_id", "uri", "payload", "refers_to")
                       .mapInPandas(run, "path string, records long, bytes long"), "packages")


class ZipDirectory:
    """Members of a ZIP file, from its end and its central directory."""

    def __init__(self, file, size: int) -> None:
        self.file = file
        tail_at = max(0, size - 65_557)
        tail = self._read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = self._read(tail_at + end - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            end64 = self._read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<QQQ", end64, 32)
        raw, at = self._read(start, length), 0
        self.members: dict[str, tuple[int, int, int]] = {}  # method, stored bytes, local header
        for _ in range(count):
            if raw[at:at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            method, = struct.unpack_from("<H", raw, at + 10)
            packed, plain, n, m, k = struct.unpack_from("<IIHHH", raw, at + 20)
            header, = struct.unpack_from("<I", raw, at + 42)
            name = raw[at + 46:at + 46 + n].decode()
            extra, x = raw[at + 46 + n:at + 46 + n + m], 0
            while x + 4 <= len(extra):
                kind, width = struct.unpack_from("<HH", extra, x)
                if kind == 1:  # the 64-bit values of the fields that overflow, in this order
                    wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, x + 4))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header = next(wide) if header == 0xFFFFFFFF else header
                x += 4 + width
            self.members[name] = (method, packed, header)
            at += 46 + n + m + k

    def _read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def stored(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes in the package."""
        method, length, header = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored")
        n, m = struct.unpack("<HH", self._read(header + 26, 4))
        return header + 30 + n + m, length

    def read(self, name: str) -> bytes:
        return self._read(*self.stored(name))


def record_ranges(paths: DataFrame) -> DataFrame:
    """``path, offset, lengths`` of runs of records of about RANGE_BYTES, from
    each package's index."""

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            for path in pdf["path"]:
                system, local = file_system(path)
                with system.open_input_file(local) as file:
                    members = ZipDirectory(file, file.size())
                    start, _ = members.stored(DATA)
                    lines = members.read(INDEX).decode().splitlines()
                rows, taken = [], RANGE_BYTES
                for entry in map(json.loads, lines):
                    if taken + entry["length"] > RANGE_BYTES:
                        rows.append((path, start + entry["offset"], []))
                        taken = 0
                    rows[-1][2].append(entry["length"])
                    taken += entry["length"]
                if rows:
                    yield type(pdf)(rows, columns=["path", "offset", "lengths"])

    return paths.select("path").mapInPandas(run, "path string, offset long, lengths array<int>")


def _dealt(rows: DataFrame) -> DataFrame:
    """Small rows that stand for much reading: a task each, up to MAX_TASKS
    (by their size alone, adaptive execution would put them all in one)."""
    return rows.repartition(max(1, min(rows.count(), MAX_TASKS)))


def read_packages(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the packages (rows of RECORD_SCHEMA), read range by range."""
    columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            for path, offset, lengths in zip(pdf["path"], pdf["offset"], pdf["lengths"]):
                system, local = file_system(path)
                with system.open_input_file(local) as file:
                    file.seek(int(offset))
                    raw = file.read(int(sum(lengths)))
                rows, at = [], 0
                for n in lengths:
                    row = parse_record(zlib.decompress(raw[at:at + n], 31))
                    rows.append(row if with_payload else row[:-1] + (None,))
                    at += n
                yield type(pdf)(rows, columns=columns)

    ranges = materialize(record_ranges(_dealt(paths)), "record-ranges")
    return _dealt(ranges).mapInPandas(run, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC records in ZIP packages;
    the table of packages.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the largest id is the response, the others revisit it.  A null html is an
    empty payload, a null url an empty target.  Pages without an id are
    revisits if a page with an id has their payload, else responses; rows
    that repeat an id and its payload are written alike.  Other columns are
    ignored; an empty table writes no package.

    Equal payloads meet as one digest per task before the shuffle, and the
    join that brings the decision back is one AQE can split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("uri"), payload.alias("payload"))
    base = base.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    tops = (base.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
            .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "top"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    refers = F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")),
                    F.concat(F.lit("urn:page:"), F.col("top").cast("string")))
    return write_packages(base.join(tops, "digest", "left").select(
        name.alias("record_id"), "uri", "payload", refers.alias("refers_to")), folder)


def page_of(urn: str) -> Column:
    """Page id of a record id; null if it has none."""
    return F.expr(f"try_cast(nullif(substring({urn}, 10), '') as bigint)")
