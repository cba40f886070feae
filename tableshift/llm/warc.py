"""WARC archives packed in ZIP files: written from rows, and read by range without extraction.

A package holds a stored member ``archive/data.warc.gz`` (one gzip member per record) and a stored member
``indexes/index.jsonl`` (one line per record: offset, length). The reader parses the end record, the ZIP64 records where
there are any, and the central directory, finds the stored members, reads the index and then only the records' byte ranges.
Files are opened with pyarrow's file systems, so a folder may be local, on HDFS or in an object store.
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

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.session import cut_lineage, work_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
SPAN = 4 << 20  # bytes that one range read covers
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member. A revisit has no payload, but names its digest and the response."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {_EPOCH}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {name(refers_to)}"]
    block = _HTTP + (payload if kind == "response" else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    whole = "WARC/1.1\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record's gzip member."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = raw[end + 4:end + 4 + int(headers["Content-Length"])]
    return headers, block[block.index(b"\r\n\r\n") + 4:]


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class Package:
    """Writes one ZIP package as a stream; the index waits in memory, about 40 bytes per record."""

    def __init__(self, system: pafs.FileSystem, path: str):
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, member: bytes) -> None:
        self.member.write(member)
        self.index.append(json.dumps({"offset": self.at, "length": len(member)}))
        self.at += len(member)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        self.out.close()


def write_packages(rows: DataFrame, folder: str, package_bytes: int = 64 << 20) -> DataFrame:
    """Write (page_id, url, payload, digest, record_type, refers_to) rows as packages; return the table (path, records).

    A task's package closes once it holds ``package_bytes``. Names are unique to an attempt and only finished tasks are listed,
    so what a lost executor leaves behind is never read.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        open_, path = None, ""
        done = lambda: pa.RecordBatch.from_pydict({"path": [path], "records": [len(open_.index)]})
        for batch in batches:
            for r in zip(*[batch.column(c) for c in ("record_type", "page_id", "url", "digest", "payload", "refers_to")]):
                kind, page, url, digest, payload, refers = (x.as_py() for x in r)
                if open_ is None:
                    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}.wacz"
                    open_ = Package(system, path)
                open_.add(record(kind, page, url, digest, (payload or "").encode(), refers))
                if open_.at >= package_bytes:
                    open_.close()
                    yield done()
                    open_ = None
        if open_ is not None:
            open_.close()
            yield done()

    columns = rows.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return cut_lineage(columns.mapInArrow(write, "path string, records bigint"))


def members(file: pa.NativeFile) -> dict[str, tuple[int, int, int]]:
    """The central directory: {name: (method, place of the data, stored size)}; ZIP64 records are followed."""
    size = file.size()
    tail_at = max(0, size - 65_557 - 20)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06", 0, max(4, len(tail) - 18))  # 22 bytes at least
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature may also stand in the comment
    if end < 0:
        raise ValueError("no end record: not a ZIP file")
    _, count, length, at = struct.unpack_from("<HHII", tail, end + 8)
    if 0xFFFF in (count,) or 0xFFFFFFFF in (length, at):
        if tail[end - 20:end - 16] != b"PK\x06\x07":
            raise ValueError("ZIP64 locator missing")
        place, = struct.unpack_from("<Q", tail, end - 20 + 8)
        record64 = file.read_at(56, place)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record missing")
        count, length, at = struct.unpack_from("<QQQ", record64, 32)
    directory, found, p = file.read_at(length, at), {}, 0
    for _ in range(count):
        if directory[p:p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, p + 20)
        header, = struct.unpack_from("<I", directory, p + 42)
        name = directory[p + 46:p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = directory[p + 46 + n:p + 46 + n + m], 0
        while q + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # only the fields that overflowed are there, in this order
                values = iter(struct.unpack_from(f"<{width // 8}Q", extra, q + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            q += 4 + width
        local = file.read_at(30, header)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("damaged local header")
        found[name] = (method, header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        p += 46 + n + m + k
    return found


def locate(listing: DataFrame, folder: str) -> DataFrame:
    """(path, at, lengths): neighbouring records of each package in spans of about ``SPAN`` bytes, from its index."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_file(path) as file:
                    parts = members(file)
                    (archive_method, start, _), (index_method, at, size) = parts[ARCHIVE], parts[INDEX]
                    if archive_method or index_method:
                        raise ValueError(f"{path}: members must be stored, not compressed")
                    entries = [json.loads(x) for x in file.read_at(size, at).decode().splitlines()]
                spans: list[list] = []
                for e in entries:
                    if spans and sum_ + e["length"] <= SPAN and spans[-1][0] + sum_ == start + e["offset"]:
                        spans[-1][1].append(e["length"])
                        sum_ += e["length"]
                    else:
                        spans.append([start + e["offset"], [e["length"]]])
                        sum_ = e["length"]
                for k in range(0, len(spans), 1024):
                    some = spans[k:k + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(some)), pa.array([s[0] for s in some], pa.int64()),
                         pa.array([s[1] for s in some], pa.list_(pa.int64()))], ["path", "at", "lengths"])
    return listing.select("path").mapInArrow(find, "path string, at bigint, lengths array<bigint>")


READ_SCHEMA = ("page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, "
               "named_digest string, payload_bytes bigint, payload binary")


def read_records(spans: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the spans, each span with one range read. ``payload_bytes`` and ``payload_digest`` come from what
    was read and are null for revisits; ``named_digest`` is the header's. ``payload`` is null unless asked for."""
    number = lambda x: int(x[10:-1]) if x and len(x) > 11 else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "named_digest", "payload_bytes", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path, at, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "lengths"))):
                with system.open_input_file(path) as file:
                    data, p, rows = file.read_at(sum(lengths), at), 0, []
                for n in lengths:
                    headers, payload = parse(data[p:p + n])
                    p += n
                    whole = headers["WARC-Type"] == "response"
                    rows.append((number(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Type"],
                                 number(headers.get("WARC-Refers-To")), base32_sha1(payload) if whole else None,
                                 headers["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload) if whole else None,
                                 payload if whole and payloads else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return spans.repartition("path", "at").mapInArrow(read, READ_SCHEMA)


def marked(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
           least_bytes: int = 0, filter_blocks: int = 1 << 14) -> DataFrame:
    """Rows for ``write_packages``: of equal payloads of at least ``least_bytes`` the largest id is the response.

    Payloads are not shuffled unless a blocked Bloom filter of the repeated digests says that they may be repeated.
    """
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("hex"))
    counted = rows.filter(F.octet_length("payload") >= least_bytes)
    repeated = cut_lineage(counted.groupBy("hex").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                           .filter("n > 1").select("hex", "first"))
    tested = may_contain(rows, "hex", blocked_bloom(repeated, "hex", filter_blocks), filter_blocks)
    digest = F.expr(_BASE32)
    alone = tested.filter("not bloom_hit").withColumn("first", F.col("page_id"))
    met = (tested.filter("bloom_hit").join(repeated.withColumn("met", F.lit(True)), "hex", "left")
           .withColumn("first", F.when(F.col("met") & (F.octet_length("payload") >= least_bytes), F.col("first"))
                       .otherwise(F.col("page_id"))).drop("met"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("first"))
    return alone.unionByName(met).select(
        "page_id", "url", "payload", digest.alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


# Five hexadecimal digits are four letters of base32.
_BASE32 = ("array_join(flatten(transform(sequence(0, 7), i -> transform(sequence(3, 0, -1), j -> substring("
           "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(shiftright(cast(conv(substring(hex, 5 * i + 1, 5), 16, 10) as int), "
           "5 * j) & 31 as int) + 1, 1)))), '')")


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write every page as a WARC record, read the packages back: (page_id, payload_bytes, payload_digest, record_type,
    refers_to), one row per page, with length and digest taken from the payloads read; a revisit takes those of its response.

    A null payload is empty; null ids sort first and are read back as null; rows that repeat an id and a payload are all
    responses; a null URL is written empty; other columns are ignored. An empty table gives an empty result.
    """
    folder = folder or work_folder(spark, "packages")
    listing = write_packages(marked(pages, least_bytes=least_bytes), folder)
    records = cut_lineage(read_records(locate(listing.repartition("path"), folder), folder).drop("payload", "url"))
    responses = records.filter("record_type = 'response'")
    known = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named_digest")).agg(
        F.max("payload_bytes").alias("known_bytes"))
    revisits = (records.filter("record_type = 'revisit'").join(known, ["refers_to", "named_digest"], "left")
                .select("page_id", F.col("known_bytes").alias("payload_bytes"),
                        F.when(F.col("known_bytes").isNotNull(), F.col("named_digest")).alias("payload_digest"),
                        "record_type", "refers_to"))
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(revisits)
