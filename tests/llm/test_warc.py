import base64
import hashlib
import io
import zipfile

import pytest

from murmullo.llm.warc_zip import (
    DATA, INDEX, archive_pages, members, parse, read_archives, record, records, write_archives,
)

SCHEMA = "page_id bigint, url string, html string, payload_digest string"


class Bytes:
    """An open archive in memory that says which ranges were read."""

    def __init__(self, data):
        self.data, self.reads = data, []

    def size(self):
        return len(self.data)

    def read_at(self, n, offset):
        self.reads.append((offset, n))
        return self.data[offset:offset + n]


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def _expected(rows, least=0):
    newest = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            key = html or ""
            newest[key] = max(page_id, newest.get(key, page_id))
    out = []
    for page_id, _, html, *_ in rows:
        body, top = html or "", newest.get(html or "")
        old = len(body.encode()) >= least and top is not None and (page_id is None or page_id < top)
        out.append((page_id, len(body.encode()), _digest(html), "revisit" if old else "response", top if old else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>uno</p>", "x"), (2, "http://a/2", "<p>dos ñ 😀</p>", "x"), (3, "http://a/3", "<p>uno</p>", "x"),
    (4, None, None, None), (5, "http://a/5\r\nX: y", "", "x"), (None, "http://a/6", "<p>uno</p>", "x"),
    (7, "http://a/7", "<p>uno</p>", "x"), (7, "http://a/7", "<p>uno</p>", "x"), (None, "u", "solo sin id", "x"),
    (8, "http://a/8", "largo\r\n\r\n" * 50_000, "x"), (9, "", "\r\n\r\n", "x"),
]


def test_pages_come_back(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert sorted(map(tuple, archive_pages(pages).collect()), key=str) == _expected(ROWS)
    assert sorted(map(tuple, archive_pages(pages, least=10).collect()), key=str) == _expected(ROWS, 10)
    assert archive_pages(pages.limit(0)).collect() == []


def test_payloads_and_addresses_come_back(spark, tmp_path):
    many = [(i, f"http://b/{i}", f"<b>{i % 40}</b>" * (i % 7), None) for i in range(300)]
    folder = str(tmp_path / "w")
    write_archives(spark.createDataFrame(many, SCHEMA).repartition(2), folder, archive_bytes=5000)
    found = {r.page_id: r for r in read_archives(spark, folder).collect()}
    assert len(list((tmp_path / "w/archives").iterdir())) > 3
    for page_id, url, html, _ in many:
        r = found[page_id]
        assert r.url == url
        payload = r.payload if r.record_type == "response" else found[r.refers_to].payload
        assert bytes(payload) == html.encode()


def test_the_packages_are_zip_files(spark, tmp_path):
    folder = str(tmp_path / "w")
    write_archives(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), folder)
    (path,) = (tmp_path / "w/archives").iterdir()
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.namelist() == [DATA, INDEX]
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
        data, index = z.read(DATA), z.read(INDEX)
    part = Bytes(path.read_bytes())
    place = members(part)
    assert part.data[place[DATA][0]:][:place[DATA][1]] == data
    assert part.data[place[INDEX][0]:][:place[INDEX][1]] == index
    assert len(list(records(part))) == len(ROWS)


def test_a_zip64_directory(monkeypatch):
    """Small limits make the library write the 64-bit fields."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out, bodies = io.BytesIO(), {f"m{i}": bytes([i]) * (50 + 100 * i) for i in range(5)}
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, body in bodies.items():
            z.writestr(name, body)
        z.writestr(zipfile.ZipInfo("packed"), b"x" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"PK? a comment"
    data = out.getvalue()
    assert b"PK\x06\x06" in data
    found = members(Bytes(data))
    assert set(found) == set(bodies)  # packed members cannot be read in place
    assert {n: data[a:a + size] for n, (a, size) in found.items()} == bodies


def test_only_ranges_are_read(spark, tmp_path):
    rows = [(i, "u", f"{i} " * 3000, None) for i in range(200)]
    folder = str(tmp_path / "w")
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    (path,) = (tmp_path / "w/archives").iterdir()
    part = Bytes(path.read_bytes())
    reader = records(part)
    next(reader)
    assert max(n for _, n in part.reads) < 1 << 21


def test_damage_is_told():
    with pytest.raises(ValueError, match="not a ZIP"):
        members(Bytes(b"nothing"))
    raw = record(1, "u", b"payload", None, False)
    fields, payload = parse(raw)
    assert payload == b"payload" and fields["WARC-Record-ID"] == "<urn:page:1>"
    with pytest.raises(ValueError, match="digest"):
        parse(raw.replace(b"payload\r\n\r\n", b"paylaod\r\n\r\n"))
    with pytest.raises(ValueError, match="not a WARC"):
        parse(b"HTTP/1.1 200 OK\r\n\r\n")
