r"""Secrets in plain text and below layers of encoding.

Each text is a worklist of layers. A layer is scanned with the patterns; URL
escapes, ``\u``, ``\x`` and ``&#`` escapes, base64 and compressed runs in it give
further layers, until none is new. A layer whose content was seen at the same
place of the document ends its branch, so cycles end. Decoded bytes are a layer
whatever they hold: UTF-8, or UTF-16 and UTF-32 with a byte order mark, with bad
bytes replaced; the patterns alone tell secrets from noise. Every character of a layer
knows the span of the original text that it comes from, and so does each find.

Base64 may begin anywhere in a run, which also goes on over line breaks, with
indents: the run is decoded from each of its first four characters, and unpacked
wherever a compressed header stands in it. What is only found so has the span of
the characters that hold it, and is left out inside a find of the whole run.

Null and empty texts have no spans. Repeated rows and null ids get a row each;
columns other than ``doc_id`` and ``text`` are not looked at. Spans count code
points, the end is exclusive. A compressed run that grows beyond ``MAX_LAYER``
bytes is no layer: it would not fit a worker.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import small_batches

MAX_LAYER = 64 << 20
# Compressed bytes are fed in steps, so that damage costs the step it lies in.
STEP = 1 << 16
MASK = "[SECRET]"

# Fixed patterns of the base scan, in their order of kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are maximal, so the length can be part of the pattern.
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+")
RUN_BREAK = re.compile(r"\s+")
# How gzip, bzip2, xz and zlib data begin in base64.
PACKED = re.compile(r"(?=H4sI|Qlpo|/Td6WFoA|e[A-P])")
PACKED_STEPS = (1 << 8, 1 << 16)


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Layer(NamedTuple):
    """Text whose character i stands for [starts[i], ends[i]) of the original.

    No array stands for the original itself; a single span for a layer that comes
    from one run as a whole.
    """

    text: str
    starts: np.ndarray | int | None = None
    ends: np.ndarray | int | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def place(self) -> tuple[int, int] | None:
        """The run the layer comes from, None if it is the text as a whole."""
        return (self.starts, self.ends) if isinstance(self.starts, int) else None


def base_spans(text: str) -> list[Span]:
    """The finds of the fixed patterns in a text, by start, then kind."""
    spans = [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _url(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")


def _escapes(run: str) -> str:
    codes = [int(m[1] or m[2] or m[4] or "0", 16) if m[3] is None else int(m[3]) for m in ESCAPE.finditer(run)]
    units = "".join(chr(code) if code < 0x110000 else "�" for code in codes)
    # Surrogate halves written as two escapes are one character.
    return units.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def _unescaped(layer: Layer, runs: re.Pattern, decode: Callable[[str], str]) -> Layer | None:
    """The layer with all runs of escapes decoded; None if it has none."""
    text, found, at = layer.text, [], 0
    pieces: list[str] = []
    for match in runs.finditer(text):
        plain = decode(match[0])
        found.append((at, match.start(), match.end(), len(plain)))
        pieces += [text[at : match.start()], plain]
        at = match.end()
    if not found:
        return None
    pieces.append(text[at:])
    whole = "".join(pieces)
    if isinstance(layer.starts, int):
        return Layer(whole, layer.starts, layer.ends)
    if layer.starts is None:
        places = np.arange(len(text) + 1, dtype=np.int32 if len(text) < 1 << 31 else np.int64)
        layer = Layer(text, places[:-1], places[1:])
    starts, ends = [], []
    for before, start, end, size in found:
        low, high = layer.origin(start, end)
        starts += [layer.starts[before:start], np.full(size, low, layer.starts.dtype)]
        ends += [layer.ends[before:start], np.full(size, high, layer.ends.dtype)]
    return Layer(
        whole,
        np.concatenate([*starts, layer.starts[at:]]),
        np.concatenate([*ends, layer.ends[at:]]),
    )


def _packer(raw: bytes):  # noqa: ANN202
    """What decompresses bytes that begin so, None for others."""
    if raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 2 and int.from_bytes(raw[:2], "big") % 31 == 0):
        return zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _unpacked(raw: bytes) -> bytes | None:
    """What a compressed run holds, None for other bytes.

    Members that follow each other are one text. A run that is cut short or damaged
    gives what decodes, and one that grows beyond ``MAX_LAYER`` nothing.
    """
    pieces, room = [], MAX_LAYER
    while room > 0 and (packer := _packer(raw)) is not None:
        at = 0
        try:
            while at < len(raw) and not packer.eof and room > 0:
                plain = packer.decompress(raw[at : at + STEP], room)
                at += STEP
                # What did not fit is asked for again with no more input.
                while plain:
                    pieces.append(plain)
                    room -= len(plain)
                    more = getattr(packer, "unconsumed_tail", b"")
                    waiting = more or not getattr(packer, "needs_input", True)
                    plain = packer.decompress(more, room) if room > 0 and waiting and not packer.eof else b""
        except (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError):
            break
        if not packer.eof:
            break
        raw = packer.unused_data + raw[at:]
    return b"".join(pieces) or None if room > 0 else None


def _readable(raw: bytes) -> str | None:
    """The text of bytes, through any number of compressed layers; None for a cycle."""
    seen = set()
    while (plain := _unpacked(raw)) is not None:
        digest = hashlib.sha256(plain).digest()
        if digest in seen:
            return None
        seen.add(digest)
        raw = plain
    code = "utf-8"
    if raw.startswith((codecs.BOM_UTF32_LE, codecs.BOM_UTF32_BE)):
        code = "utf-32"
    elif raw.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
        code = "utf-16"
    return raw.decode(code, "replace")


def _base64(layer: Layer) -> Iterator[Layer]:
    for match in BASE64_RUN.finditer(layer.text):
        run = match[0].rstrip("=").replace("-", "+").replace("_", "/")
        if len(run) % 4 == 1:
            continue
        try:
            raw = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
        except binascii.Error:
            continue
        text = _readable(raw)
        if text is not None:
            yield Layer(text, *layer.origin(*match.span()))


def _decoded(run: str) -> bytes:
    """Bytes of a run of the usual alphabet; an end of one character holds none."""
    run = run[:-1] if len(run) % 4 == 1 else run
    return base64.b64decode(run + "=" * (-len(run) % 4))


def _unpacked_at(run: str, at: int) -> tuple[bytes, int] | None:
    """What the data compressed from there holds, and the end of its characters.

    Decoded in steps that grow, so that a header by chance costs a short one. It
    is one by chance as well if gzip has no data after the longest step: a file
    name of 48 KB.
    """
    packer = _packer(_decoded(run[at : at + 8]))
    if packer is None:
        return None
    pieces, size, fed = [], 0, 0
    low, (step, longest) = at, PACKED_STEPS
    while low < len(run):
        raw = _decoded(run[low : low + step])
        low, step = low + step, min(4 * step, longest)
        try:
            plain = packer.decompress(raw, MAX_LAYER - size)
        except (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError):
            return None
        pieces.append(plain)
        size += len(plain)
        fed += len(raw)
        if packer.eof:
            rest = packer.unused_data + (_decoded(run[low:]) if _packer(packer.unused_data + _decoded(run[low : low + 8])) else b"")
            # Members that follow need not begin where characters do.
            if (more := _unpacked(rest)) is not None:
                return b"".join([*pieces, more]), len(run)
            used = fed - len(packer.unused_data)
            return b"".join(pieces), min(len(run), at + -(-used * 8 // 6))
        if size >= MAX_LAYER or (not size and low - at > longest and run[at] in "He"):
            return None
    # Cut short: what decoded so far.
    return (b"".join(pieces), len(run)) if size else None


def _shifted(layer: Layer) -> Iterator[Layer]:
    """Layers of base64 that does not fill one run of one line."""
    runs = [(m[0].rstrip("="), m.start(), False) for m in BASE64_RUN.finditer(layer.text)]
    if "\n" in layer.text:
        wrapped = [(m[0], m.start(), True) for m in WRAPPED_RUN.finditer(layer.text)]
        ends = [start + len(run) for run, start, _ in wrapped]
        # A run of one line is part of the wrapped run that covers it.
        starts = [start for _, start, _ in wrapped]
        runs = [r for r in runs if not (at := bisect_right(starts, r[1])) or ends[at - 1] <= r[1]] + wrapped
    for found, start, wrapped in runs:
        if wrapped:
            run = RUN_BREAK.sub("", found)
            if len(run) < 16:
                continue
            places = np.concatenate([np.arange(m.start(), m.end()) for m in re.finditer(r"\S+", found)]) + start
        else:
            run, places = found, None
        run = run.replace("-", "+").replace("_", "/")

        def origin(first: np.ndarray, last: np.ndarray) -> tuple:
            """Spans in the original of the characters from first to last, each."""
            first, last = (first + start, last + start) if places is None else (places[first], places[last])
            if layer.starts is None:
                return first, last + 1
            if isinstance(layer.starts, int):
                return layer.starts, layer.ends
            return layer.starts[first], layer.ends[last]

        for shift in range(4):
            raw = np.frombuffer(_decoded(run[shift:]), np.uint8)
            if not shift and not wrapped and raw.all():
                continue  # the run as a whole is this layer
            # Without the zeros of UTF-16 and UTF-32; only ASCII is in secrets and runs.
            kept = np.flatnonzero(raw)
            text = raw[kept].tobytes().decode("latin-1")
            if any(sign.search(text) for sign in SIGNS):
                bits = kept * 8
                yield Layer(text, *origin(shift + bits // 6, shift + (bits + 7) // 6))
        for match in PACKED.finditer(run):
            at = match.start()
            unpacked = None if at == 0 and not wrapped else _unpacked_at(run, at)
            text = _readable(unpacked[0]) if unpacked else None
            if text:
                low, high = origin(np.array([at]), np.array([unpacked[1] - 1]))
                whole = (low, high) if isinstance(low, int) else (int(low[0]), int(high[0]))
                yield Layer(text, *whole)


# What makes a layer worth a place for each of its characters.
SIGNS = (ASSIGN, ACCESS, HEX, BASE64_RUN, WRAPPED_RUN, URL_RUN, ESCAPE_RUN)


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """The base finds, and all finds with those of decoded layers."""
    base = base_spans(text)
    found = set(base)
    seen = set()
    whole = [Layer(text)]
    _search(_below(whole[0]), seen, found, whole)
    # What is found in parts of runs counts where whole runs show nothing.
    parts: set[Span] = set()
    work = [part for layer in whole for part in _shifted(layer)]
    while work:
        layers: list[Layer] = []
        _search(work, seen, parts, layers)
        work = [part for layer in layers for part in _shifted(layer)]
    return base, sorted(found | _outside(parts, found))


def _outside(parts: set[Span], found: set[Span]) -> set[Span]:
    """The parts that are inside no find of their kind, nor inside another part."""
    kept: set[Span] = set()
    reach = dict.fromkeys(range(len(KINDS)), -1)
    order = [(s.start, -s.end, 0, s) for s in found] + [(s.start, -s.end, 1, s) for s in parts]
    for _, end, part, span in sorted(order):
        if part and span.end > reach[span.kind]:
            kept.add(span)
        reach[span.kind] = max(reach[span.kind], -end)
    return kept


def _search(work: list[Layer], seen: set, found: set[Span], layers: list[Layer]) -> None:
    """Adds the finds in the layers and all below them, and the layers not seen before."""
    while work:
        layer = work.pop()
        digest = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        if (layer.place(), digest) in seen:
            continue
        seen.add((layer.place(), digest))
        for span in base_spans(layer.text):
            start, end = layer.origin(span.start, span.end)
            found.add(Span(start, span.kind, end))
        layers.append(layer)
        work += _below(layer)


def _below(layer: Layer) -> list[Layer]:
    """The layers one decoding step below."""
    below = list(_base64(layer))
    if "%" in layer.text:
        below.append(_unescaped(layer, URL_RUN, _url))
    if "\\" in layer.text or "&#" in layer.text:
        below.append(_unescaped(layer, ESCAPE_RUN, _escapes))
    return [one for one in below if one is not None]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[span.kind]}:{span.start}:{span.end}" for span in spans)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: finds of every document as (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_secrets(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([rows(f[side]) for f in found], kind) for side in (0, 1))],
                names=["doc_id", "base", "spans"],
            )

    small_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spans = "array<struct<kind: string, start: long, end: long>>"
    return texts.mapInArrow(run, f"doc_id long, base {spans}, spans {spans}")


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with each run of overlapping spans replaced once."""
    pieces, at = [], 0
    for span in spans:
        if span.start >= at:
            pieces += [text[at : span.start], mask]
        at = max(at, span.end)
    return "".join([*pieces, text[at:]])


def mask_secrets(documents: DataFrame, mask: str = MASK) -> DataFrame:
    """The documents with all secrets masked in their texts; nulls stay null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else masked(t, find_secrets(t)[1], mask) for t in texts], dtype=object)

    small_batches(documents.sparkSession)
    return documents.withColumn("text", clean(F.col("text").cast("string")))
