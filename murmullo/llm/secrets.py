"""Find secrets in texts, also where they are encoded, however often.

A worklist starts with the text itself. Every layer on it is scanned for secrets and
searched for encodings: URL escapes and Unicode escapes are undone through the whole
layer, runs of base64 become layers of their own, and bytes that begin like a gzip, zlib,
bzip2, xz or zstandard stream are unpacked. What comes out is a new layer, until nothing
new comes out; a layer that was there already, with the same place, is not taken up
again, so streams that unpack to themselves end. Each layer knows for every character
which part of the text it comes from, so a finding is given as a span of the text: exact
behind escapes, the whole encoded run behind base64.

Kinds: an assignment of a value of 12 characters or more to a name such as ``password``,
an access key id of 18 characters or more, a run of 16 or more hexadecimal digits. Spans
are in code points, the end exclusive, and are those of the whole match.

A null text counts as an empty one and has no spans. Rows may repeat; nothing is
shuffled, and all other columns stay as they are. Each text is read whole; a task keeps
a slice of a batch, and the layers of one text, in memory. Unpacked bytes are bounded by
``UNPACKED`` for a text: what would go beyond is not unpacked, and ``n_unread`` counts it.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import row_struct, sliced
from murmullo.session import ship_package

KINDS = ("assign", "access", "hex")
UNPACKED = 64 << 20
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
# Both are maximal runs, so the shortest length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_VALUE = 12

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
_UNICODE_UNIT = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
# A run, or lines of one length with a last one that may be shorter.
_BASE64 = re.compile(
    r"[A-Za-z0-9+/_-]{60,}(?:\r?\n[A-Za-z0-9+/_-]{60,})*\r?\n[A-Za-z0-9+/_-]+={0,2}"
    r"|[A-Za-z0-9+/_-]{16,}={0,2}")
_LINE = re.compile(r"[^\r\n]{16,}")
_JOINT = re.compile(r"[^+/_-]{16,}")
_URL_SAFE = str.maketrans("-_", "+/")
_CONTROLS = re.compile(r"[\x00-\x08\x0E-\x1A\x1C-\x1F]")


@dataclass
class Layer:
    """What an encoding held: text or bytes, the way to it, and where it comes from.

    ``begin`` and ``end`` give, per character, its part of the text; a pair of numbers
    holds for all of a layer; None says that the layer is the text.
    """

    content: str | bytes
    path: tuple[str, ...]
    place: tuple[int, int] | tuple[np.ndarray, np.ndarray] | None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.place is None:
            return start, end
        begin, until = self.place
        if isinstance(begin, np.ndarray):
            return int(begin[start]), int(until[end - 1])
        return begin, until


def findings(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of the secrets that a text shows openly."""
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= _VALUE:
            yield "assign", m.start(), m.end()
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _url(run: str) -> Iterator[tuple[str, int]]:
    """Characters of a run of URL escapes and how long each was."""
    raw = bytes.fromhex(run.replace("%", ""))
    at = 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                yield raw[at:at + n].decode(), 3 * n
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield chr(raw[at]), 3  # no UTF-8: the byte as it is
            at += 1


def _unicode(run: str) -> Iterator[tuple[str, int]]:
    """Characters of a run of Unicode escapes; two surrogates make one."""
    high = None
    for m in _UNICODE_UNIT.finditer(run):
        point, size = int(next(g for g in m.groups() if g), 16), m.end() - m.start()
        if high and 0xDC00 <= point < 0xE000:
            yield chr(0x10000 + ((high[0] - 0xD800) << 10) + point - 0xDC00), high[1] + size
            high = None
            continue
        if high:
            yield "\ufffd", high[1]
            high = None
        if 0xD800 <= point < 0xDC00:
            high = point, size
        else:
            yield chr(point) if point < 0x110000 and not 0xDC00 <= point < 0xE000 else "\ufffd", size
    if high:
        yield "\ufffd", high[1]


def _unescaped(layer: Layer, name: str, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with one kind of escapes undone, and where every character was."""
    text = layer.content
    pieces, begins, ends, last = [], [], [], 0
    for m in pattern.finditer(text):
        start = m.start()
        pieces.append(text[last:start])
        begins.append(np.arange(last, start))
        ends.append(np.arange(last + 1, start + 1))
        chars, sizes = zip(*decode(m.group()))
        until = start + np.cumsum(sizes)
        pieces.append("".join(chars))
        begins.append(until - np.array(sizes))
        ends.append(until)
        last = m.end()
    if not pieces:
        return None
    pieces.append(text[last:])
    begins.append(np.arange(last, len(text)))
    ends.append(np.arange(last + 1, len(text) + 1))
    begin, end = np.concatenate(begins), np.concatenate(ends)
    if layer.place is None:
        place = begin, end
    elif isinstance(layer.place[0], np.ndarray):
        place = layer.place[0][begin], layer.place[1][end - 1]
    else:
        place = layer.place
    return Layer("".join(pieces), (*layer.path, name), place)


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    """Runs of base64 (also its URL form, with or without padding) that hold text or a
    packed stream: the whole run, else its lines, else their parts between ``+ / _ -``."""
    for m in _BASE64.finditer(layer.content):
        for start, end, content in _held(m.group(), m.start(), (_LINE, _JOINT)):
            yield Layer(content, (*layer.path, "base64"), layer.origin(start, end))


def _held(run: str, at: int, cuts: tuple[re.Pattern, ...]) -> Iterator[tuple[int, int, str | bytes]]:
    content = _base64(run)
    if content is not None:
        yield at, at + len(run), content
    elif cuts:
        for part in cuts[0].finditer(run):
            yield from _held(part.group(), at + part.start(), cuts[1:])


def _base64(run: str) -> str | bytes | None:
    run = run.translate(_URL_SAFE).replace("\r", "").replace("\n", "").rstrip("=")
    if len(run) % 4 == 1:
        return None
    try:
        raw = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None
    if _unpacker(raw):
        return raw
    return _as_text(raw)


def _as_text(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return None if _CONTROLS.search(text) else text


def _unpacker(raw: bytes):
    """Name and unpacking object for bytes that begin like a packed stream."""
    if raw[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return "zlib", zlib.decompressobj()
    if raw[:3] == b"BZh":
        return "bzip2", bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor(format=lzma.FORMAT_XZ)
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        return "zstd", None
    return None


def _unpacked(raw: bytes, most: int) -> tuple[str, bytes | None] | None:
    """Format and content of a packed stream; None as content if it is above ``most``."""
    known = _unpacker(raw)
    if known is None:
        return None
    name, unpacker = known
    try:
        if name == "zstd":
            with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as stream:
                out = stream.read(most + 1)
        else:
            out = unpacker.decompress(raw, most + 1)
    except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
        return None
    return name, None if len(out) > most else out


@dataclass
class Finding:
    kind: str
    start: int
    end: int
    path: tuple[str, ...]


def scan(text: str, most: int = UNPACKED) -> tuple[list[Finding], int, int]:
    """All findings of a text, each span once with its shortest way; the number of layers
    behind the text; the number of packed streams left unread."""
    found: dict[tuple[str, int, int], Finding] = {}
    work, layers, unread, left = [Layer(text, (), None)], 0, 0, most
    seen: set[bytes] = set()
    while work:
        # First in, first out: the shortest way to a layer comes first.
        now, work = work, []
        for layer in now:
            new: list[Layer] = []
            if isinstance(layer.content, bytes):
                out = _unpacked(layer.content, left)
                if out is not None:
                    name, raw = out
                    if raw is None:
                        unread += 1
                    else:
                        left -= len(raw)
                        content = raw if _unpacker(raw) else _as_text(raw)
                        if content is not None:
                            new.append(Layer(content, (*layer.path, name), layer.place))
            else:
                for kind, start, end in findings(layer.content):
                    span = (kind, *layer.origin(start, end))
                    found.setdefault(span, Finding(*span, layer.path))
                if "%" in layer.content:
                    new.append(_unescaped(layer, "url", _URL, _url))
                if "\\" in layer.content:
                    new.append(_unescaped(layer, "unicode", _UNICODE, _unicode))
                new += _base64_layers(layer)
            for candidate in new:
                if candidate is not None and (key := _key(candidate)) not in seen:
                    seen.add(key)
                    layers += 1
                    work.append(candidate)
    rank = {kind: i for i, kind in enumerate(KINDS)}
    order = sorted(found.values(), key=lambda f: (f.start, rank[f.kind], f.end))
    return order, layers, unread


def _key(layer: Layer) -> bytes:
    content = layer.content if isinstance(layer.content, bytes) else layer.content.encode(
        "utf-8", "surrogatepass")
    begin, end = layer.place
    ends = (begin[:1].tobytes() + end[-1:].tobytes()) if isinstance(begin, np.ndarray) else b"%d:%d" % (begin, end)
    return hashlib.blake2b(ends + b"|" + content, digest_size=16).digest()


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                   ("path", pa.string())])


def _scanner(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, 1):
                spans, layers, unread = [], [], []
                for value in batch.column(1):
                    found, n, skipped = scan(value.as_py() or "", most)
                    spans.append([(f.kind, f.start, f.end, ">".join(f.path)) for f in found])
                    layers.append(n)
                    unread.append(skipped)
                sizes = np.concatenate(([0], np.cumsum([len(s) for s in spans]))).astype(np.int32)
                flat = [x for s in spans for x in s]
                parts = [pa.array([x[i] for x in flat], _SPAN.field(i).type) for i in range(4)]
                listed = pa.ListArray.from_arrays(
                    pa.array(sizes), pa.StructArray.from_arrays(parts, fields=list(_SPAN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), listed, pa.array(layers, pa.int64()), pa.array(unread, pa.int64())],
                    names=["_doc", "secrets", "n_layers", "n_unread"])

    return run


def with_secrets(docs: DataFrame, text: str = "text", most: int = UNPACKED) -> DataFrame:
    """Every row as ``_doc`` with ``secrets`` (kind, start, end and the encodings they are
    behind, outermost first), ``n_layers`` and ``n_unread``."""
    ship_package(docs.sparkSession)
    rows = docs.select(row_struct(docs).alias("_doc"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(
        _scanner(most), f"_doc {kind}, secrets array<struct<kind: string, start: bigint, "
        "end: bigint, path: string>>, n_layers bigint, n_unread bigint",
    )


def _written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_table(docs: DataFrame, most: int = UNPACKED) -> DataFrame:
    """Per row: how many secrets of each kind stand openly, a digest of these, all spans."""
    found = with_secrets(docs.select(F.col("doc_id").alias("id"), "text"), most=most)
    plain = F.filter("secrets", lambda s: s["path"] == "")

    def counted(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("_doc.id").alias("doc_id"),
        *map(counted, KINDS),
        F.sha2(_written(plain), 256).alias("base_sha256"), _written(F.col("secrets")).alias("spans"),
        "n_layers", "n_unread",
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", most: int = UNPACKED) -> DataFrame:
    """The rows with every span of a secret replaced; spans that overlap are one."""
    step = "named_struct('at', 0L, 'out', '')"
    found = with_secrets(docs, most=most)
    # Spans come by start: what one ends at, the next may begin before.
    folded = F.expr(f"""aggregate(secrets, {step}, (a, s) -> CASE
        WHEN s.end <= a.at THEN a
        WHEN s.start < a.at THEN named_struct('at', s.end, 'out', a.out)
        ELSE named_struct('at', s.end, 'out', concat(
            a.out, substring(_doc.text, int(a.at + 1), int(s.start - a.at)), '{mark}')) END,
        a -> concat(a.out, substring(_doc.text, int(a.at + 1))))""")
    return found.select(*[
        (F.when(F.size("secrets") > 0, folded).otherwise(F.col("_doc.text")) if c == "text"
         else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
