"""Secret scans with a recursive decoding worklist.

Patterns are first matched on the text itself. Then every layer found in it (URL escapes, Unicode escapes, base64,
compressed data) is unwrapped, matched again and put on the worklist, until nothing new turns up. A layer that was
unwrapped before at the same place is not followed again, which ends cycles such as data that decompresses to itself.
Escapes keep a start and an end in the original text for each decoded character; what comes out of base64 is mapped to
the span of the encoded run. Compressed data is unpacked to its end, member by member, and read in windows that overlap,
so that memory is bounded by a window and the longest run without a break.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import common
from opinara.llm.spans import Span, digests, with_spans

# Fixed values of the base patterns. Letters of a name may have either case, but only ASCII ones.
KINDS = ("assign", "access", "hex")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
EITHER = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token")
)
ASSIGN = re.compile(rf"(?:{EITHER}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# Runs that are too short never pass, and cannot hide a longer one, so the lengths stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
SHORTEST_VALUE = 12

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
URL_SAFE = str.maketrans("-_", "+/")
# Lines of one base64 run; the places where compressed data may start; what bytes must hold to hold a match or a layer.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
NARROW, WIDE = re.compile(rb"[\x20-\x7e]{16}"), re.compile(rb"(?:[\x20-\x7e]\x00){16}")
# Bytes of a window, of its overlap at least, and of compressed data handed on at once where output cannot be bounded.
# A window is never cut inside a run of RUN_BYTES, which no match and no encoded run reaches beyond by an overlap.
WINDOW, OVERLAP, FEED = 1 << 20, 1 << 16, 256
RUN_BYTES = bytes(set(range(128)) - set(range(1, 32)) - set(b"!$()*,.<>?@[]^`|~\x7f") | {10, 13})
INFLATE = type(zlib.decompressobj())
BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError)
REPLACEMENT = "[SECRET]"
REPLACED = "\ufffd"


@dataclass(frozen=True)
class Layer:
    """A decoded text and where each of its characters stands in the original; ``whole`` if all stand at one place."""

    text: str
    starts: list[int] | None = None
    ends: list[int] | None = None
    whole: tuple[int, int] | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]


def matches(text: str) -> Iterator[Span]:
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= SHORTEST_VALUE:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def rewritten(layer: Layer, pieces: list[tuple[int, int, list[tuple[str, int, int]]]]) -> Layer | None:
    """The layer with the pieces (start, end, decoded characters with their places) put in."""
    if not pieces:
        return None
    text, starts, ends, at = [], [], [], 0

    def copy(start: int, end: int) -> None:
        text.append(layer.text[start:end])
        for i in range(start, end) if not layer.whole else ():
            a, b = layer.span(i, i + 1)
            starts.append(a)
            ends.append(b)

    for start, end, decoded in pieces:
        copy(at, start)
        for character, first, last in decoded:
            text.append(character)
            a, b = layer.span(first, last)
            starts.append(a)
            ends.append(b)
        at = end
    copy(at, len(layer.text))
    if layer.whole:
        return Layer("".join(text), whole=layer.whole)
    return Layer("".join(text), starts, ends)


def unwrap_url(layer: Layer) -> Layer | None:
    pieces = []
    for m in URL_RUN.finditer(layer.text) if "%" in layer.text else ():
        decoded = bytes.fromhex(m.group().replace("%", "")).decode(errors="surrogateescape")
        at, characters = m.start(), []
        for c in decoded:
            width = 3 * len(c.encode(errors="surrogateescape"))
            characters.append((REPLACED if "\ud800" <= c <= "\udfff" else c, at, at + width))
            at += width
        pieces.append((m.start(), m.end(), characters))
    return rewritten(layer, pieces)


def unwrap_unicode(layer: Layer) -> Layer | None:
    pieces = []
    for m in ESCAPE.finditer(layer.text) if "\\" in layer.text or "&#" in layer.text else ():
        start, end = m.span()
        if m.lastindex is None:
            units = bytes.fromhex(m.group().replace("\\u", ""))
            at, characters = start, []
            for c in units.decode("utf-16-be", "surrogatepass"):
                width = 6 * (len(c.encode("utf-16-be", "surrogatepass")) // 2)
                characters.append((REPLACED if "\ud800" <= c <= "\udfff" else c, at, at + width))
                at += width
        else:
            number = int(m.group(m.lastindex), 10 if m.lastindex == 5 else 16)
            if number > 0x10FFFF or 0xD800 <= number < 0xE000 or not number:
                continue
            characters = [(chr(number), start, end)]
        pieces.append((start, end, characters))
    return rewritten(layer, pieces)


def opened(head: bytes):
    """A decompressor for data that starts with ``head``, or None if it starts as none that is known here."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(lzma.FORMAT_XZ)
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def member(tool, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of some bytes, in pieces, then the bytes after the end of the member as its value."""
    if isinstance(tool, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
        yield tool.decompress(data, WINDOW)
        while not tool.eof and not tool.needs_input:
            yield tool.decompress(b"", WINDOW)
    elif isinstance(tool, INFLATE):
        piece = tool.decompress(data, WINDOW)
        while piece and not tool.eof:
            yield piece
            piece = tool.decompress(tool.unconsumed_tail, WINDOW)
        yield piece
    else:
        # A block of 4 bytes can stand for 128 KB, and this interface gives all of them at once.
        for at in range(0, len(data), FEED):
            yield tool.decompress(data[at : at + FEED])
            if tool.eof:
                return tool.unused_data + data[at + FEED :]
    return tool.unused_data if tool.eof else b""


def unpacked(chunks: Iterator[bytes], rests: list[int] | None = None) -> Iterator[bytes]:
    """What compressed data holds, through all its members and as far as it is whole, then what follows the last one.

    ``rests`` gets the bytes left of a chunk after each member.
    """
    tool, data = None, b""
    try:
        for chunk in chunks:
            data += chunk
            while data:
                if tool is None:
                    # Members may be padded by zeros.
                    data = data.lstrip(b"\0")
                    if len(data) < 6:
                        break
                    tool = opened(data)
                    if tool is None:
                        yield data
                        yield from chunks
                        return
                data = yield from member(tool, data)
                if tool.eof:
                    tool = None
                    if rests is not None:
                        rests.append(len(data))
        if tool is None and data:
            yield data
    except BROKEN:
        return


def nested(data: bytes, depth: int, rests: list[int] | None = None) -> Iterator[bytes]:
    """The bytes below so many layers of compression."""
    chunks = iter([data])
    for level in range(depth):
        chunks = unpacked(chunks, None if level else rests)
    return chunks


def compressed(data: bytes, rests: list[int]) -> Iterator[Iterator[bytes]]:
    """What data holds below each layer of compression, until it is no more compressed or repeats an upper layer."""
    seen, depth = {hashlib.sha256(data).digest()}, 1
    while True:
        yield nested(data, depth, rests)
        head = b""
        for piece in nested(data, depth):
            head += piece
            if len(head) >= 6:
                break
        if not opened(head):
            return
        digest = hashlib.sha256()
        for piece in nested(data, depth):
            digest.update(piece)
        if digest.digest() in seen:
            return
        seen.add(digest.digest())
        depth += 1


def windows(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes in stretches that overlap; each run of RUN_BYTES stands whole in one of them."""
    held, need = bytearray(), WINDOW
    for chunk in chunks:
        held += chunk
        if len(held) < need:
            continue
        keep = min(len(held.rstrip(RUN_BYTES)), len(held) - OVERLAP)
        if keep < len(held) // 2:
            need = 2 * len(held)
            continue
        yield bytes(held)
        del held[:keep]
        need = len(held) + WINDOW
    if held:
        yield bytes(held)


def readable(data: bytes) -> list[str] | None:
    """Texts that bytes hold, as UTF-8 and as UTF-16 of either order, with replacements for what is no text, or None."""
    found = [data.decode(errors="replace")] if NARROW.search(data) else []
    if WIDE.search(data):
        found += [data[start:].decode("utf-16-le", errors="replace") for start in (0, 1)]
    return found or None


def contents(run: str) -> Iterator[str]:
    """Texts in a base64 run, which may start anywhere in it, and in compressed data there."""
    run = run.translate(URL_SAFE)
    for phase in range(4):
        body = run[phase:]
        body = body[: len(body) - (len(body) % 4 == 1)]
        data, done = binascii.a2b_base64(body + "=" * (-len(body) % 4)), 0
        yield from readable(data) or ()
        for m in MAGIC.finditer(data):
            if m.start() < done:
                continue
            rests: list[int] = []
            inside = data[m.start() :]
            for chunks in compressed(inside, rests):
                for window in windows(chunks):
                    yield from readable(window) or ()
            if rests:
                done = len(data) - min(rests)


def wrapped(text: str) -> Iterator[tuple[int, int, str]]:
    """Base64 runs over lines of one length, but for the first one and a shorter last one: start, end and joined run."""
    m = WRAPPED.search(text)
    while m:
        lines = [x.span() for x in LINE.finditer(text, m.start(), m.end())]
        size = [b - a for a, b in lines]
        count = 2
        while count < len(lines) and size[count - 1] >= size[count] and (count == 2 or size[count - 1] == size[count - 2]):
            count += 1
        yield lines[0][0], lines[count - 1][1], "".join(text[a:b] for a, b in lines[:count])
        m = WRAPPED.search(text, lines[count - 1][1] if count < len(lines) else m.end())


def unwrap_base64(layer: Layer) -> Iterator[Layer]:
    single = ((*m.span(), m.group()) for m in BASE64_RUN.finditer(layer.text))
    for start, end, run in (*single, *wrapped(layer.text)):
        for _ in range(2):
            end += layer.text.startswith("=", end)
        for text in contents(run):
            yield Layer(text, whole=layer.span(start, end))


def below(layer: Layer) -> Iterator[Layer]:
    yield from (x for x in (unwrap_url(layer), unwrap_unicode(layer)) if x)
    yield from unwrap_base64(layer)


def layers(text: str) -> Iterator[Layer]:
    """All layers below a text, each once per place; one branch is followed at a time."""
    key = lambda x: (hashlib.sha256(x.text.encode(errors="surrogatepass")).digest(), x.whole)
    seen, stack = {key(Layer(text))}, [below(Layer(text))]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        elif (known := key(inner)) not in seen:
            seen.add(known)
            stack.append(below(inner))
            yield inner


def find(text: str) -> tuple[set[Span], set[Span]]:
    """Base spans, and further ones from the layers below."""
    base = set(matches(text))
    more: set[Span] = set()
    for layer in layers(text):
        more.update((kind, *layer.span(start, end)) for kind, start, end in matches(layer.text))
    return base, more - base


def scan(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with its secrets as an array of (kind, start, end, base) in order of start and kind.

    Null and empty texts have none; whole texts are scanned, however long; repeated rows get the same spans; a column
    named ``spans`` is replaced; an empty table stays empty. ``base`` is false for what only a decoded layer shows.
    """
    return with_spans(docs, text, spans, KINDS, lambda: find)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by REPLACEMENT, and the length corrected where there is such a column."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else redacted(t) for t in batch.column(text).to_pylist()]
        at = batch.schema.get_field_index(text)
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    clean = common.map_batches(docs, schema, work)
    if n_chars in docs.columns:
        clean = clean.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return clean


def redacted(text: str) -> str:
    base, more = find(text)
    out, at = [], 0
    for _, start, end in sorted([*base, *more], key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], REPLACEMENT]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.documents(spark, folder).select("doc_id", "text")
    return digests(scan(docs).drop("text"), KINDS)
