"""WARC records in ZIP packages, read in place.

A task packs its pages into archives with two stored (uncompressed) members:
``archive/data.warc.gz``, a gzip member for each record, and
``indexes/index.cdxj``, one line per record with its offset and length. The reader
finds the members through the end record, the ZIP64 locator and the central
directory, reads the index, and then reads byte ranges of the archive, some
records at a time; nothing is extracted.

Of pages with equal payloads the one with the largest ``page_id`` is a response,
the others are revisits without a payload that name it; so pages that share
the largest id are all responses, and a null ``page_id`` is smaller than any other.
If all ids of a payload are null, all are responses. Payloads under ``least``
bytes are always responses. Null HTML is an empty payload, a null URL an empty
target. The digests are grouped with partial aggregates; the join back can be
split where one payload has very many pages.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmullo.llm.common import stage
from murmullo.llm.files import filesystem, part_name
from murmullo.session import ship_package, work_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ARCHIVE = 64 << 20
_RANGE = 1 << 20


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    value = urn[len("<urn:page:"):-1]
    return int(value) if value else None


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = _HTTP if revisit else _HTTP + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record; the payload's digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
    return fields, payload


def _gzip(data: bytes) -> bytes:
    """A gzip member without a time stamp, so equal records are equal bytes."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _packing(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(5)])

        def archive(first: tuple) -> tuple[str, int]:
            store, path, address, _ = part_name(folder, ".wacz")
            index, offset, row = [], 0, first
            with store.open_output_stream(path) as out, zipfile.ZipFile(
                out, "w", zipfile.ZIP_STORED, allowZip64=True
            ) as package:
                with package.open(DATA, "w", force_zip64=True) as data:
                    while row is not None:
                        page_id, url, html, refers_to, revisit = row
                        packed = _gzip(record(page_id, url, html.encode(), refers_to, revisit))
                        data.write(packed)
                        index.append(json.dumps({
                            "id": page_id, "offset": offset, "length": len(packed)}))
                        offset += len(packed)
                        row = next(pages, None) if offset < most else None
                package.writestr(INDEX, "".join(f"{line}\n" for line in index))
            return address, len(index)

        pages = rows()
        while (first := next(pages, None)) is not None:
            address, n = archive(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([address]), pa.array([n], pa.int64())], names=["path", "n_records"]
            )

    return run


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = _ARCHIVE
) -> None:
    """Pack all pages into archives in ``folder`` and list them in its manifest."""
    ship_package(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    digested = pages.select(
        F.col("page_id").cast("bigint"), F.coalesce("url", F.lit("")).alias("url"),
        html.alias("html"), F.sha1(html).alias("_digest"),
    )
    newest = stage(
        digested.filter(F.octet_length("html") >= least)
        .groupBy("_digest").agg(F.max("page_id").alias("_newest"))
        .filter(F.col("_newest").isNotNull())
        .select(F.col("_digest").alias("_d"), "_newest"),
        "warc-newest",
    )
    older = F.col("_newest").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("_newest"))
    )
    (
        digested.join(newest, digested["_digest"] == newest["_d"], "left")
        .select("page_id", "url", "html", F.when(older, F.col("_newest")).alias("_refers"),
                older.alias("_revisit"))
        .mapInArrow(_packing(f"{folder}/archives", archive_bytes), "path string, n_records bigint")
        .write.parquet(f"{folder}/manifest")
    )


def _zip64_values(extra: bytes, wanted: int) -> list[int]:
    """The 64-bit numbers of an extra field that stand for saturated ones."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{wanted}Q", extra, at + 4))
        at += 4 + size
    raise ValueError("a ZIP64 field is missing")


def members(part) -> dict[str, tuple[int, int]]:
    """Offset and size of every stored member of an open archive.

    ``part`` needs ``size()`` and ``read_at(n, offset)``.
    """
    size = part.size()
    tail_at = max(0, size - (1 << 16) - 22)
    tail = part.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP archive")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        locator = tail.rfind(b"PK\x06\x07", 0, end)
        (where,) = struct.unpack_from("<Q", tail, locator + 8)
        end64 = part.read_at(56, where)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = part.read_at(length, start), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        offset, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n].decode()
        large = [v == 0xFFFFFFFF for v in (full, packed, offset)]
        if any(large):
            values = iter(_zip64_values(directory[at + 46 + n:at + 46 + n + m], sum(large)))
            full, packed, offset = (
                next(values) if big else v for big, v in zip(large, (full, packed, offset))
            )
        if method == 0:
            local = part.read_at(30, offset)
            names, extras = struct.unpack_from("<HH", local, 26)
            found[name] = (offset + 30 + names + extras, full)
        at += 46 + n + m + k
    return found


def records(part) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an open archive, through its index, in ranges of about a megabyte."""
    place = members(part)
    data, _ = place[DATA]
    at, size = place[INDEX]
    lines = [json.loads(x) for x in part.read_at(size, at).decode().splitlines()]
    i = 0
    while i < len(lines):
        first, j, end = lines[i]["offset"], i, lines[i]["offset"]
        while j < len(lines) and (j == i or end - first < _RANGE) and lines[j]["offset"] == end:
            end += lines[j]["length"]
            j += 1
        together = part.read_at(end - first, data + first)
        for line in lines[i:j]:
            begin = line["offset"] - first
            yield parse(zlib.decompress(together[begin:begin + line["length"]], 31))
        i = j


def _unpacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def given(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
        )

    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, name = filesystem(path)
            rows, size = [], 0
            with store.open_input_file(name) as part:
                for fields, payload in records(part):
                    revisit = fields["WARC-Type"] == "revisit"
                    rows.append((
                        _page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"],
                        fields["WARC-Type"],
                        _page(fields["WARC-Refers-To"]) if revisit else None,
                        int(fields["X-Payload-Length"]),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        None if revisit else payload,
                    ))
                    size += len(payload)
                    if size >= 4 * _RANGE or len(rows) >= 10_000:
                        yield given(rows)
                        rows, size = [], 0
            if rows:
                yield given(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives that the manifest of ``folder`` lists."""
    parts = spark.read.schema("path string, n_records bigint").parquet(f"{folder}/manifest")
    many = max(1, parts.count())
    return parts.select("path").repartition(many, "path").mapInArrow(
        _unpacking, "page_id bigint, url string, record_type string, refers_to bigint, "
        "payload_bytes bigint, payload_digest string, payload binary",
    )


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = work_dir(pages.sparkSession, "warc-zip")
    write_archives(pages, folder, least)
    return read_archives(pages.sparkSession, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
