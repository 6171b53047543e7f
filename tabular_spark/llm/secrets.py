"""Secret scans through nested encodings.

A document is a worklist of layers, the text itself first. Each layer is scanned with the same
patterns and unwrapped in every way that applies: percent escapes, Unicode and character
references, and base64 runs, also over line breaks. Bytes are layers too: they are inflated, all
members, as often as they are compressed, and what is valid in them is read as text. What comes
out is a new layer unless it has been seen at this place of the document before (so cycles end),
until none is new. Every layer
keeps, for each of its characters, the stretch of the document that it stands for, so that a find
in any layer is a span of the document.

Base64 is read at all four offsets of a run, as a run may begin inside a path or a word, and bytes
as UTF-8 and UTF-16. Compressed data is inflated as a stream; what exceeds ``WINDOW`` bytes is
scanned window by window, each with the last ``OVERLAP`` bytes of the one before. All its finds
stand for one stretch of the document, so one cut by a window's border is found in either part;
only encoded data inside it that is itself longer than the overlap may be cut.

Cases: a null text counts as empty and has no spans; repeated rows stay; texts of any length are
scanned whole; only the named columns are read. All that a document's layers inflate to is scanned
up to ``RATIO`` bytes for each of its characters (more than deflated data can hold, read in every
way) and ``WINDOW`` bytes beside; only decompression bombs, nested or of other kinds, exceed it,
and ``unopened`` counts the layers that were left there.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
from collections.abc import Iterator
from html.entities import html5
from itertools import chain
from urllib.parse import unquote_to_bytes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import text_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A mark that is itself escaped, once or many times over, is undone with what it marks: one layer, not one for each time.
PERCENT_UNIT, UNICODE_UNIT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})"), re.compile(r"\\(?:u005[cC])*u([0-9A-Fa-f]{4})")
PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\(?:u005[cC])*u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&(?:#38;|#[xX]26;|amp;)*(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
BASE64_URL = re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")
#: Tried at the start of a run only and never given back, so that a long run is read once.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/]++)++={0,2}")
WRAPPED_URL = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9_-]++)++={0,2}")
#: Escaped bytes with the plain characters around them, as escapes are written only where needed.
PERCENT_BYTES, ESCAPED_BYTES = re.compile(r"[!-~]+"), re.compile(r"[ -~]+")
#: How compressed data starts; what bytes without any secret or further layer lack (the shortest have 12 such characters in a row), in UTF-16 too.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
SHOWN = re.compile(rb"[\t\r\n -~]{8}")
WIDE = (("utf-16-le", re.compile(rb"(?:[\t\r\n -~]\x00){8}")), ("utf-16-be", re.compile(rb"(?:\x00[\t\r\n -~]){8}")))
ZEROS = re.compile(rb"\x00*")
#: Inflated bytes in a piece of the stream, in a window, and common to two windows; inflated bytes for each character of a document.
PIECE, WINDOW, OVERLAP, RATIO = 1 << 20, 16 << 20, 1 << 20, 4096

SPANS = "doc_id {kind}, spans array<struct<kind: string, start: long, end: long, base: boolean, layer: string>>, unopened int"


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the patterns in one layer; leftmost, not overlapping per kind."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


class Layer:
    """A text, and for each of its characters, or for all of them, the stretch of the document it stands for."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None, name: str = "", whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.name, self.whole = text, starts, ends, name, whole

    @property
    def base(self) -> bool:
        return self.starts is None and self.whole is None

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.whole or ((start, end) if self.starts is None else (self.starts[start], self.ends[end - 1]))

    def replaced(self, pattern: re.Pattern, decode, name: str) -> Layer | None:
        """The layer with each match that ``decode`` accepts put into plain characters."""
        parts, starts, ends, last = [], [], [], 0

        def mapped(first: int, end: int, length: int | None = None) -> None:
            """The characters of a stretch stand for themselves, or ``length`` new ones for all of it."""
            if self.whole is None:
                each = [self.span(i, i + 1) for i in range(first, end)] if length is None else [self.span(first, end)] * length
                starts.extend(a for a, _ in each)
                ends.extend(b for _, b in each)

        for m in pattern.finditer(self.text):
            pieces = decode(m[0])
            if pieces is None:
                continue
            parts.append(self.text[last : m.start()])
            mapped(last, m.start())
            at = m.start()
            for chars, width in pieces:
                parts.append(chars)
                mapped(at, at + width, len(chars))
                at += width
            last = m.end()
        if not parts:
            return None
        parts.append(self.text[last:])
        mapped(last, len(self.text))
        return Layer("".join(parts), starts, ends, f"{self.name}/{name}", self.whole)


def characters(data: bytes) -> list[tuple[str | None, int]]:
    """The characters of UTF-8 bytes and how many bytes each takes; None for a byte that isn't of one."""
    return [(None, 1) if "\udc80" <= c <= "\udcff" else (c, len(c.encode())) for c in data.decode("utf-8", "surrogateescape")]


def percent_pieces(run: str) -> list[tuple[str, int]] | None:
    units = list(PERCENT_UNIT.finditer(run))
    at, out = 0, []
    found = characters(bytes.fromhex("".join(u[1] for u in units)))
    if all(c is None for c, _ in found):
        return None
    for c, n in found:
        start, end = units[at].start(), units[at + n - 1].end()
        out.append((run[start:end] if c is None else c, end - start))
        at += n
    return out


def unicode_pieces(run: str) -> list[tuple[str, int]] | None:
    if run[0] == "&":
        name = run[:-1].rpartition(";")[2].lstrip("&")
        if name[0] != "#":
            marks = len(run) - len(name) - 1
            if chars := html5.get(f"{name};"):
                return [(chars, len(run))]
            return [("&", marks), (f"{name};", len(name) + 1)] if marks > 1 else None
        found = [(int(name[2:], 16) if name[1] in "xX" else int(name[1:]), len(run))]
    elif run[1] == "x":
        try:
            return [(c, 4 * len(c.encode())) for c in bytes.fromhex(run.replace("\\x", "")).decode()]
        except UnicodeDecodeError:
            found = [(int(run[i + 2 : i + 4], 16), 4) for i in range(0, len(run), 4)]
    elif run[1] == "U" or run[2] == "{":
        found = [(int(run.strip("\\uU{}"), 16), len(run))]
    else:
        units = [(int(u[1], 16), len(u[0])) for u in UNICODE_UNIT.finditer(run)]
        found, i = [], 0
        while i < len(units):
            if 0xD800 <= units[i][0] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][0] < 0xE000:
                found.append((0x10000 + (units[i][0] - 0xD800 << 10) + units[i + 1][0] - 0xDC00, units[i][1] + units[i + 1][1]))
                i += 2
            else:
                found.append(units[i])
                i += 1
    if any(code > 0x10FFFF or 0xD800 <= code < 0xE000 for code, _ in found):
        return None
    return [(chr(code), width) for code, width in found]


def machine_for(data: bytes):
    """A decompressor for how the data starts; None if it isn't compressed."""
    import bz2
    import lzma
    import zlib

    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def unframed(data: bytes) -> Iterator[bytes]:
    """Pieces of what the frames of zstd data hold, as far as they are sound."""
    import zstandard

    reader = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
    try:
        while part := reader.read(PIECE):
            yield part
    except zstandard.ZstdError:
        pass


def inflated(data: bytes) -> Iterator[bytes]:
    """Pieces of what gzip, zlib, bzip2, xz or zstd data holds, all members and what follows them, as far as it is sound; none if it is none of them."""
    if data[:4] == b"\x28\xb5\x2f\xfd":
        yield from unframed(data)
        return
    at, members = 0, 0
    while at < len(data) and (machine := machine_for(data[at : at + 16])) is not None:
        got = False
        try:
            while at < len(data) and not machine.eof:
                chunk = data[at : at + 4096]
                at += len(chunk)
                while True:
                    part = machine.decompress(chunk, PIECE)
                    if part:
                        got = True
                        yield part
                    chunk = getattr(machine, "unconsumed_tail", b"")
                    if machine.eof or not (chunk or len(part) == PIECE or not getattr(machine, "needs_input", True)):
                        break
        except Exception:  # unsound from here on
            return
        members += machine.eof or got
        if not machine.eof:
            return
        at = ZEROS.match(data, at - len(machine.unused_data)).end()
    if members and at < len(data):
        yield data[at:]


class Budget:
    """The bytes that a document's layers may still inflate to, and how many layers were left for want of them."""

    def __init__(self, text: str):
        self.left, self.unopened = WINDOW + RATIO * len(text), 0


def windows(pieces: Iterator[bytes], budget: Budget) -> Iterator[bytes]:
    """The pieces joined to windows that share the overlap."""
    window, new = bytearray(), False
    for piece in pieces:
        budget.left -= len(piece)
        if budget.left < 0:
            budget.unopened += 1
            break
        window += piece
        new = True
        if len(window) >= WINDOW:
            yield bytes(window)
            del window[:-OVERLAP]
            new = False
    if new:
        yield bytes(window)


def begins(data: bytes, at: int, enough: int = 4096) -> bool:
    """Whether compressed data may begin here: of gzip and zlib the first bytes give something, of other kinds they are sound."""
    import zstandard

    head = data[at : at + enough]
    zstd = head[:4] == b"\x28\xb5\x2f\xfd"
    machine = zstandard.ZstdDecompressor().decompressobj() if zstd else machine_for(head)
    if machine is None:
        return False
    for i in range(0, len(head), 64):
        try:
            if machine.decompress(head[i : i + 64]) or machine.eof:
                return True
        except Exception:  # unsound from here on
            return False
    return head[:1] not in (b"\x1f", b"\x78")


class Bytes:
    """Decoded bytes, the stretch of the document that all stand for, and where known those of each byte."""

    def __init__(self, data: bytes, span: tuple[int, int], name: str, each=None):
        self.data, self.whole, self.name, self.each = data, span, name, each

    def opened(self, budget: Budget) -> list[Layer | Iterator[Bytes]]:
        pieces = inflated(self.data)
        first = next(pieces, None)
        if first is not None:
            return [self.inside(chain((first,), pieces), budget)]
        found = []
        if SHOWN.search(self.data):
            found.append(self.layer("utf-8", 0, self.name))
        for encoding, pattern in WIDE:
            for odd in sorted({m.start() % 2 for m in pattern.finditer(self.data)}):
                found.append(self.layer(encoding, odd, f"{self.name}/{encoding}"))
        return found

    def inside(self, pieces: Iterator[bytes], budget: Budget) -> Iterator[Bytes]:
        for window in windows(pieces, budget):
            yield Bytes(window, self.whole, f"{self.name}/compressed")

    def layer(self, encoding: str, at: int, name: str) -> Layer:
        """The text of the bytes from a place on."""
        if self.each is None:
            return Layer(self.data[at:].decode(encoding, "replace"), name=name, whole=self.whole)
        if encoding == "utf-8":
            chars = [("\ufffd" if c is None else c, n) for c, n in characters(self.data[at:])]
        else:
            chars = [(c, 4 if c > "\uffff" else 2) for c in self.data[at:].decode(encoding, "replace")]
        starts, ends = [], []
        for _, n in chars:
            a, b = self.each(at, min(at + n, len(self.data)))
            starts.append(a)
            ends.append(b)
            at += n
        return Layer("".join(c for c, _ in chars), starts, ends, name)


def base64_runs(text: str) -> Iterator[tuple[list[int] | range, str, bytes | None]]:
    """(places, characters, other alphabet) of the runs, and of runs over line breaks as a whole and by lines of one width."""
    other = "-" in text or "_" in text
    for pattern, wrapped, alphabet in ((BASE64, WRAPPED, None), (BASE64_URL, WRAPPED_URL, b"-_")):
        if alphabet and not other:
            continue
        for m in pattern.finditer(text):
            if not alphabet or "-" in m[0] or "_" in m[0]:
                yield range(m.start(), m.end()), m[0], alphabet
        for m in wrapped.finditer(text) if "\n" in text else ():
            if alphabet and "-" not in m[0] and "_" not in m[0]:
                continue
            lines = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^\s]+", m[0])]
            groups, i = [(0, len(lines))], 0
            while i < len(lines):
                width, j = lines[i][1] - lines[i][0], i + 1
                while j < len(lines) and lines[j][1] - lines[j][0] == width:
                    j += 1
                if j < len(lines) and lines[j][1] - lines[j][0] < width:
                    groups.append((i, j + 1))
                groups.append((i, j))
                i = j
            for i, j in dict.fromkeys(groups):
                if j > i + 1:
                    places = [k for a, b in lines[i:j] for k in range(a, b)]
                    yield places, "".join(text[a:b] for a, b in lines[i:j]), alphabet


def base64_layers(layer: Layer) -> Iterator[Bytes]:
    """The bytes of each run at each offset, and compressed data inside them."""
    for all_places, run, other in base64_runs(layer.text):
        for offset in range(4):
            places, body = all_places[offset:], run[offset:].rstrip("=")
            if len(body) % 4 == 1:
                body = body[:-1]
            try:
                data = base64.b64decode(body + "=" * (-len(body) % 4), altchars=other)
            except (binascii.Error, ValueError):
                continue

            def each(at: int, end: int, places=places, length=len(body)) -> tuple[int, int]:
                return layer.span(places[at * 4 // 3], places[min(length, -(end * 4 // -3)) - 1] + 1)

            span = layer.span(places[0], places[-1] + 1)
            yield Bytes(data, span, f"{layer.name}/base64", each)
            if machine_for(data) is None:
                for start in MAGIC.finditer(data, 1):
                    if begins(data, start.start()):
                        yield Bytes(data[start.start() :], span, f"{layer.name}/base64")


def escaped_layers(layer: Layer) -> Iterator[Bytes]:
    """Compressed data whose bytes are escaped."""
    for mark, pattern, name in (("%", PERCENT_BYTES, "url"), ("\\x", ESCAPED_BYTES, "unicode")):
        for m in pattern.finditer(layer.text) if mark in layer.text else ():
            if mark not in m[0]:
                continue
            try:
                data = unquote_to_bytes(m[0]) if mark == "%" else codecs.escape_decode(m[0].rstrip("\\").encode())[0]
            except ValueError:
                continue
            for start in MAGIC.finditer(data):
                if not begins(data, start.start()):
                    continue
                yield Bytes(data[start.start() :], layer.span(m.start(), m.end()), f"{layer.name}/{name}")


def find(text: str) -> tuple[list[tuple[str, int, int, bool, str]], int]:
    """All spans of one document, sorted, and the number of layers not opened to their end."""
    found: dict[tuple[int, int, int], tuple[bool, str]] = {}
    work: list[Layer | Bytes | Iterator[Bytes]] = [Layer(text)]
    seen: set[tuple[bytes, int, int]] = set()
    budget = Budget(text)
    while work:
        layer = work.pop()
        if isinstance(layer, Bytes):
            new = layer.opened(budget)
        elif not isinstance(layer, Layer):
            # the next window, with all its layers, before the one after it
            new = [next(layer, None)]
            if new[0] is not None:
                work.append(layer)
        else:
            for kind, start, end in scan(layer.text):
                a, b = layer.span(start, end)
                key = (a, KINDS.index(kind), b)
                if key not in found or layer.base:
                    found[key] = (layer.base, layer.name)
            new = []
            if "%" in layer.text:
                new.append(layer.replaced(PERCENT, percent_pieces, "url"))
            if "\\" in layer.text or "&" in layer.text:
                new.append(layer.replaced(UNICODE, unicode_pieces, "unicode"))
            new += base64_layers(layer)
            new += escaped_layers(layer)
        for x in new:
            if isinstance(x, Bytes):
                key = (hashlib.blake2b(x.data).digest(), *x.whole)
            elif isinstance(x, Layer):
                key = (hashlib.blake2b(x.text.encode("utf-8", "surrogatepass"), person=b"text").digest(), *(x.span(0, len(x.text)) if x.text else (0, 0)))
            else:
                if x is not None:
                    work.append(x)
                continue
            if key not in seen:
                seen.add(key)
                work.append(x)
    return [(KINDS[k], a, b, base, name) for (a, k, b), (base, name) in sorted(found.items())], budget.unopened


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, unopened) of every document; spans in code points, end exclusive, sorted by start and kind."""
    slim = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("layer", pa.string())]))
        for batch in batches:
            found = [find(x.as_py()) for x in batch.column(1)]
            rows = [[dict(zip(("kind", "start", "end", "base", "layer"), s)) for s in spans] for spans, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), pa.array([b for _, b in found], pa.int32())], ["doc_id", "spans", "unopened"])

    return slim.mapInArrow(run, SPANS.format(kind=slim.schema["doc_id"].dataType.simpleString()))


def op3(docs: DataFrame) -> DataFrame:
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base, counts = F.filter("spans", lambda s: s["base"]), [number(k) for k in KINDS]
    return secrets(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), "unopened")
