import base64
import hashlib
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableshift.llm import warc


def brute(rows, least=0):
    largest = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= least and (body not in largest or (i or -1) > (largest[body] if largest[body] is not None else -1)):
            largest[body] = i
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        first = largest.get(body, i)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://b/\r\nx: y", None), (4, "u", ""), (5, "u", "é" * 200_000),
        (6, "u", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (None, "u", "<p>same</p>"), (2, None, "<p>same</p>"), (7, "u", "other")]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, hex string")


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, pages, least):
    got = warc.archive_round_trip(spark, pages(ROWS), least_bytes=least).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ROWS, least)


def test_nothing(spark, pages):
    assert warc.archive_round_trip(spark, pages([])).collect() == []


def test_packages_roll_over_and_payloads_come_back(spark, pages, tmp_path):
    rows = [(i, f"http://x/{i}", f"page {i} " * 50) for i in range(300)]
    listing = warc.write_packages(warc.marked(pages(rows)), str(tmp_path), package_bytes=2000)
    assert listing.count() > 5 and listing.agg(F.sum("records")).first()[0] == 300
    back = warc.read_records(warc.locate(listing, str(tmp_path)), str(tmp_path), payloads=True).collect()
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in back} == set(rows)


def test_directory_with_zip64_comment_and_leading_bytes(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.comment = b"a comment with PK\x05\x06 in it"
        with z.open("big.bin", "w", force_zip64=True) as f:
            f.write(b"stored bytes")
        z.writestr("sub/é.txt", "more")
        z.writestr(zipfile.ZipInfo("packed"), b"0" * 999, compress_type=zipfile.ZIP_DEFLATED)
    raw = path.read_bytes()
    found = warc.members(pa.BufferReader(raw))
    assert [found[n][0] for n in ("big.bin", "sub/é.txt", "packed")] == [0, 0, 8]
    for name, want in (("big.bin", b"stored bytes"), ("sub/é.txt", b"more")):
        _, at, size = found[name]
        assert raw[at:at + size] == want


def test_more_entries_than_16_bits(tmp_path):
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"{i}"), b"")
    with open(path, "rb") as f:
        assert len(warc.members(pa.PythonFile(f, mode="r"))) == 66_000


def test_damaged_files():
    with pytest.raises(ValueError):
        warc.members(pa.BufferReader(b"no archive at all"))
