"""Secrets in texts and in what is encoded inside them.

A worklist starts with the text. Each layer is scanned with the base patterns and unwrapped: URL
escapes, ``\\uXXXX`` and ``\\xXX`` escapes, base64 runs, also those broken into lines, and compressed
data found under base64. What comes out is a new layer, unless a layer of the same content from the
same place was seen (so cycles end, and a blob that stands twice is read at both places), until
nothing is left. Every character of a layer knows the code points of the text it comes from: its own
escape, the characters of a base64 run that hold its bits, or the whole run where that is compressed.
So a find in a layer is reported with its place in the text.

Spans are code points, end exclusive, ordered by start, then kind. Base spans (depth 0) always
stay; a deeper find with the kind and place of another is not reported twice. Finds in compressed
data all have the place of their run; the scan reports each different one as a span of its own.

Defined results: null and empty text have no spans; equal rows are scanned each; decoded bytes that
are not UTF-8 count as one unknown character each, and what stands between them is scanned; of damaged
compressed data, what was read before the damage is scanned; a layer that grows beyond ``LAYER_BYTES``
when decompressed is scanned in windows that overlap by ``OVERLAP`` bytes (so a decompression bomb
costs time, not memory, and only compressed data longer than the overlap can be cut by a window).
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.llm.rows import SLICE_BYTES, slices, texts_of, tidy

LAYER_BYTES = 64 << 20
OVERLAP = 8 << 20

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")

# Both alphabets in one run. Its separators may also stand before or behind what is encoded; they are 62 and 63,
# which next to encoded text never decode to a character that a base pattern takes.
_BASE64 = re.compile(r"([A-Za-z0-9+/_-]{16,})={0,2}")
# The same over single line ends, with the indent of the next line. Atomic, and from a run's begin only: one pass.
_BROKEN = re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++)={0,2}")
_LINE_END = re.compile(r"[\r\n \t]+")
# How the first bytes of _MAGIC begin in base64.
_PACKED = re.compile(r"(?=H4s|e(?:A[E-H]|F[4-7]|J[w-z]|N[o-r])|Qlpo|/Td6WFoA)")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|\\u\{[0-9A-Fa-f]{1,6}\}")
_MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"BZh", b"\xfd7zXZ\x00")

# What any span or further layer needs at least; decoded data without it is passed over.
_WORTH = re.compile(rb"""[dDtTnNyY]["']?\x20*[:=]|%[0-9A-Fa-f]{2}|\\[ux]|[A-Za-z0-9+/_-]{16}""")
_STEP_IN, _STEP_OUT = 4 << 10, 1 << 20

SPANS = "array<struct<kind string, start bigint, end bigint, depth int>>"

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*b"0123456789abcdef"]] = True
_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"]] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns, leftmost and not overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A decoded text; ``begin[i]`` and ``end[i]`` bound the root's code points behind character i.

    In a ``packed`` layer, which was compressed, many characters have one place.
    """

    def __init__(self, text: str, begin: np.ndarray, end: np.ndarray, depth: int, packed: bool = False):
        self.text, self.begin, self.end, self.depth, self.packed = text, begin, end, depth, packed

    def key(self) -> bytes:
        """Hash of content and origin."""
        digest = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=24)
        for place in (self.begin, self.end):
            digest.update(place[: None if place.strides[0] else 1].tobytes())
        return digest.digest()

    @classmethod
    def root(cls, text: str) -> Layer:
        at = np.arange(len(text))
        return cls(text, at, at + 1, 0)

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with every match decoded; None where nothing changes."""
        texts, begins, ends, last = [], [], [], 0
        for match in pattern.finditer(self.text):
            new, width = decode(match.group())
            if new is None:
                continue
            stop = match.start() + np.cumsum(width)
            texts += [self.text[last : match.start()], new]
            begins += [self.begin[last : match.start()], self.begin[stop - width]]
            ends += [self.end[last : match.start()], self.end[stop - 1]]
            last = match.end()
        if not texts:
            return None
        texts.append(self.text[last:])
        begins.append(self.begin[last:])
        ends.append(self.end[last:])
        return Layer("".join(texts), np.concatenate(begins), np.concatenate(ends), self.depth + 1, self.packed)

    def children(self) -> Iterator[Layer]:
        """One at a time, so that few windows of a large layer are held."""
        yield from self.inner()
        for pattern, decode in ((_ESCAPE, _from_escape), (_URL, _from_url)):
            if (child := self.replaced(pattern, decode)) is not None:
                yield child

    def inner(self) -> Iterator[Layer]:
        """Content of the base64 runs, compressed or not, whatever characters it holds."""
        for match in _BASE64.finditer(self.text):
            yield from self._decoded(match[1], np.arange(match.start(), match.end()))
        for match in _BROKEN.finditer(self.text):
            at = np.arange(match.start(), match.end())
            breaks = np.concatenate([np.arange(*gap.span()) for gap in _LINE_END.finditer(match.group())])
            yield from self._decoded(_LINE_END.sub("", match[1]), np.delete(at, breaks))

    def _decoded(self, run: str, at: np.ndarray) -> Iterator[Layer]:
        """Content of a run whose characters, and padding, stand at the places ``at`` of this layer."""
        run = run.replace("-", "+").replace("_", "/")
        packed = [m.start() for m in _PACKED.finditer(run)]
        # Four characters make three bytes, so what begins within the run is read by one of four phases.
        for phase in range(4):
            raw = _from_base64(run[phase:])
            for first in packed:
                if first % 4 == phase:
                    for data in _unpacked(memoryview(raw)[(first - phase) // 4 * 3 :]):
                        yield self._within(data, at[first], at[-1])
            if _WORTH.search(raw):
                text, size = _characters(raw)
                byte = np.cumsum(size) - size
                begin = self.begin[at[phase + byte * 4 // 3]]
                end = self.end[at[phase + (8 * (byte + size - 1) + 7) // 6]]
                yield Layer(text, begin, end, self.depth + 1, self.packed)

    def _within(self, data: bytes, first: int, last: int) -> Layer:
        """A layer of which all characters come from the characters ``first`` to ``last``."""
        text, _ = _characters(data)
        return Layer(text, np.broadcast_to(self.begin[first], len(text)), np.broadcast_to(self.end[last], len(text)), self.depth + 1, True)


def _from_url(run: str) -> tuple[str, np.ndarray]:
    text, size = _characters(bytes.fromhex(run.replace("%", "")))
    return text, 3 * size


def _from_escape(run: str) -> tuple[str | None, np.ndarray]:
    """The text and how many characters of the run stand behind each of its characters."""
    if run.startswith("\\x"):
        text, size = _characters(bytes.fromhex(run.replace("\\x", "")))
        return text, 4 * size
    if run.startswith("\\u{"):
        point = int(run[3:-1], 16)
        return chr(point) if point < 0x110000 and not 0xD800 <= point < 0xE000 else None, np.array([len(run)])
    points = _points(bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "surrogatepass"))
    return _text(points), np.where(points > 0xFFFF, 12, 6)


def _from_base64(run: str) -> bytes:
    """What whole bytes the run holds."""
    held = len(run) - (len(run) % 4 == 1)
    return binascii.a2b_base64(run[:held] + "=" * (-held % 4))


def _decompressed(raw: memoryview) -> Iterator[bytes]:
    """The content of all members in pieces; of damaged data, the pieces before the damage."""
    at = 0
    while bytes(raw[at : at + 6]).startswith(_MAGIC):
        if raw[at] == 0x42:
            opener = bz2.BZ2Decompressor()
        elif raw[at] == 0xFD:
            opener = lzma.LZMADecompressor()
        else:
            opener = zlib.decompressobj(47)
        try:
            while not opener.eof and at < len(raw):
                piece = raw[at : at + _STEP_IN]
                at += len(piece)
                yield opener.decompress(piece, _STEP_OUT)
                while not opener.eof:  # zlib hands back what it did not read, the others keep it
                    kept = getattr(opener, "unconsumed_tail", b"")
                    data = opener.decompress(kept, _STEP_OUT)
                    if not data:
                        break
                    yield data
        except (OSError, EOFError, zlib.error, lzma.LZMAError):
            return
        at -= len(opener.unused_data)
        while at < len(raw) and raw[at] == 0:  # padding between members
            at += 1


def _unpacked(raw: memoryview) -> Iterator[bytes]:
    """The content in windows of about ``LAYER_BYTES``, each beginning with the last ``OVERLAP`` bytes of the one before."""
    held, new = bytearray(), False
    for data in _decompressed(raw):
        held += data
        new = new or bool(data)
        if len(held) >= LAYER_BYTES:
            yield bytes(held)
            del held[:-OVERLAP]
            new = False
    if new:
        yield bytes(held)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _text(points: np.ndarray) -> str:
    """The text of code points, with an unknown character for each lone surrogate."""
    return np.where((points >= 0xD800) & (points < 0xE000), np.uint32(0xFFFD), points).tobytes().decode("utf-32-le")


def _characters(data: bytes) -> tuple[str, np.ndarray]:
    """The text and the number of bytes behind each character; a byte that is not UTF-8 is one character."""
    if data.isascii():
        return data.decode("ascii"), np.ones(len(data), np.int64)
    points = _points(data.decode("utf-8", "surrogateescape"))
    stray = (points >= 0xD800) & (points < 0xE000)
    return _text(points), np.where(stray, 1, 1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000))


def find(text: str, each: bool = False) -> list[tuple[str, int, int, int]]:
    """All spans ``(kind, start, end, depth)`` of one text; with ``each``, one for each find of compressed data."""
    found: dict[tuple[int, int, int, str], int] = {(*span, ""): 0 for span in base_spans(text)}
    seen: set[bytes] = set()
    work = [iter([Layer.root(text)])] if "%" in text or "\\" in text or _BASE64.search(text) else []
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if (key := layer.key()) in seen:
            continue
        seen.add(key)
        if layer.depth:
            for start, kind, end in base_spans(layer.text):
                place = (int(layer.begin[start:end].min()), kind, int(layer.end[start:end].max()))
                found.setdefault((*place, layer.text[start:end] if each and layer.packed else ""), layer.depth)
        work.append(layer.children())
    return [(KINDS[kind], start, end, depth) for (start, kind, end, _), depth in sorted(found.items())]


def suspects(texts: list[str]) -> np.ndarray:
    """Which texts can hold a span at all; the others need no pattern."""
    marked = np.fromiter(("AKIA" in t or ":" in t or "=" in t or "%" in t or "\\" in t for t in texts), bool, len(texts))
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    for table, least in ((_HEX_BYTE, 24), (_RUN_BYTE, 16)):
        breaks = np.flatnonzero(~table[data])  # the separator is one, so no run leaves its text
        long = breaks[np.diff(breaks, prepend=-1) > least]
        marked[np.searchsorted(ends, long, side="right")] = True
    return marked


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))
        names = ("kind", "start", "end", "depth")
        for part in slices(batches, "text"):
            texts = texts_of(part)
            spans = [[dict(zip(names, s)) for s in find(t, each=True)] if maybe else [] for t, maybe in zip(texts, suspects(texts))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, with every span replaced by ``mark``; null text stays null."""

    def clean(value: str) -> str:
        parts, last = [], 0
        for _, start, end, _ in find(value):
            if end <= last:
                continue
            if start >= last:
                parts += [value[last:start], mark]
            last = end
        return "".join([*parts, value[last:]])

    at = docs.columns.index(text)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for part in slices(batches, text, SLICE_BYTES // 2):
            texts = texts_of(part)
            maybe = suspects(texts)
            if maybe.any():
                valid = part.column(at).is_valid().to_pylist()
                new = [(clean(t) if m else t) if v else None for t, m, v in zip(texts, maybe, valid)]
                part = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
            yield part

    return docs.mapInArrow(run, schema)
