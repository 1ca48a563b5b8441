import base64
import hashlib
import io
import zipfile

import pytest

from riskweave.llm import warc
from riskweave.llm.warc import ZipDirectory, archive_pages, file_system, page_of, parse_record, read_packages
from riskweave.session import shared_dir

SCHEMA = "page_id long, url string, html string, digest string, top long, n long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, 2) for i, u, h in rows], SCHEMA)


ROWS = ([(i, f"http://x/{i}", f"<p>page {i % 17} é\r\n\r\nWARC/1.1</p>" * (i % 5)) for i in range(120)]
        + [(200, None, None), (201, "http://a\r\nb", ""), (202, "u", "x" * 300_000), (None, "u", "alone"),
           (203, "u", "with none"), (None, "v", "with none")])


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 4000)
    packages = archive_pages(pages(spark, ROWS).repartition(3), shared_dir(spark, "warc-test"))
    got = read_packages(packages)
    rows = got.select(page_of("record_id").alias("page"), page_of("refers_to").alias("refers"), "*").collect()
    top = {}
    for i, _, h in ROWS:
        if i is not None:
            top[h or ""] = max(top.get(h or "", -1), i)
    assert len(rows) == len(ROWS)
    payload = {r.page: r.payload for r in rows if r.record_type == "response" and r.page is not None}
    html = {i: h or "" for i, _, h in ROWS}
    for r in rows:
        if r.page is None:
            continue
        raw = html[r.page].encode()
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if r.page == top[html[r.page]]:
            assert r.record_type == "response" and r.refers is None and bytes(r.payload) == raw
        else:
            assert r.record_type == "revisit" and r.refers == top[html[r.page]] and bytes(payload[r.refers]) == raw
    assert sorted((r.record_type, r.refers) for r in rows if r.page is None) == [("response", None), ("revisit", 203)]


def test_small_payloads_are_all_responses(spark):
    packages = archive_pages(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]),
                             shared_dir(spark, "warc-test"), min_bytes=3)
    assert sorted(r.record_type for r in read_packages(packages).collect()) == ["response"] * 3 + ["revisit"]


def test_empty_table(spark):
    packages = archive_pages(pages(spark, []), shared_dir(spark, "warc-test"))
    assert packages.count() == 0 and read_packages(packages).count() == 0


def test_packages_are_plain_zip_files(spark):
    packages = archive_pages(pages(spark, ROWS).coalesce(1), shared_dir(spark, "warc-test"))
    row = packages.first()
    system, path = file_system(row.path)
    with system.open_input_file(path) as f:
        whole = f.read()
        directory = ZipDirectory(f, f.size())
        with zipfile.ZipFile(io.BytesIO(whole)) as z:
            assert set(z.namelist()) == set(directory.members)
            for name in z.namelist():
                assert z.read(name) == directory.read(name)


def test_zip64_directory():
    # a directory whose sizes, offset and count are only in the ZIP64 fields
    import struct

    data, name = b"hello world", b"archive/data.warc.gz"
    local = struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), 0) + name + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name),
                          len(extra), 0, 0, 0, 0, 2**32 - 1) + name + extra
    at = len(local) + len(central)
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<IIQI", 0x07064B50, 0, at, 1)
    end = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 65535, 65535, 2**32 - 1, 2**32 - 1, 0)
    raw = local + central + end64 + locator + end
    directory = ZipDirectory(io.BytesIO(raw), len(raw))
    assert directory.members == {"archive/data.warc.gz": (0, len(data), 0)}
    assert directory.read("archive/data.warc.gz") == data
    with pytest.raises(ValueError):
        ZipDirectory(io.BytesIO(b"no zip"), 6)


def test_damage_is_an_error():
    record = warc.make_record("urn:page:1", "u", b"payload", None)
    assert parse_record(record)[-1] == b"payload"
    with pytest.raises(ValueError):
        parse_record(record.replace(b"payload", b"paylord"))
