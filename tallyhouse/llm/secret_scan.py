"""Secrets in texts and in what the texts encode.

Every text is a first layer. A worklist takes a layer, scans it, and makes new layers of it: the
layer with its percent escapes undone, the layer with its Unicode and byte escapes and character
references undone, and one for each base64 word whose bytes, unpacked if they are compressed, are
readable text. A base64 word may be glued to a path or prefix and may be wrapped over lines, so the
word, joined with the lines that go on, is also decoded from its first four characters on, and each
readable stretch, and compressed content wherever it begins, is a layer too; a layer
that was met before, here or on the way to here, is not entered again, so the list ends. A layer
keeps, for every character, the span of the original text that it comes from, so a find in any layer
is given as a span of the original text.

Kinds: ``assign`` (a name such as password, a separator and a value of at least 6 characters),
``access`` (AKIA and capitals or digits, at least 20 in all) and ``hex`` (at least 24 lower-case
hexadecimal digits). Matches are leftmost and do not overlap within a kind and layer. The finds of
the first layer are the base; deeper layers add spans, base spans always stay.

Defined results: null and empty texts have no find; documents without id are scanned; equal spans
found on several ways are given once; every character of compressed content maps to the whole base64
word. Bytes that are not readable UTF-8 are not a layer. Compressed content is all members of its
bytes, one after the other, and what follows them; if that is not readable as a whole, each member is
a layer, of one that is not readable its readable stretches. It is read as a stream: beyond ``MOST_UNPACKED`` characters it is scanned in pieces,
one at a time, cut only where no match and no encoded part can go on, and counted in ``n_cut``. So
memory grows with a stretch that has no such place, and with nothing else. Other columns of the
input are neither read nor required.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame

# Bytes unpacked at once, and characters of a piece.
MOST_UNPACKED = 64 << 20

# The three kinds and their least sizes.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")

PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
# The same, wrapped over lines.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{12,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)*={0,2}")
BASE64_PART = re.compile(r"[A-Za-z0-9+/_-]+")
# Readable bytes of a length that the shortest match has.
STRETCH = re.compile(
    rb"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}"
)
LAST_CONTROL = re.compile(rb"(?s).*[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
GZIP = re.compile(rb"\x1f\x8b\x08")
LONG_HEX = re.compile(r"[0-9a-f]{24}")
# Up to the last place where a text may be cut: after a character that is in no pattern above, or
# between two plain words, which no separator can join once escapes are undone.
CUT = re.compile(
    r"""(?s).*(?:[^A-Za-z0-9+/_.=\-"':%\\&#;{}\x20\r\n\t]|[\x20\n][A-Za-z0-9]+(?=\x20[A-Za-z0-9]))"""
)

Span = tuple[int, int]
Find = tuple[int, int, int]

RESULT_SCHEMA = (
    "doc_id BIGINT, base ARRAY<STRUCT<kind STRING, start INT, end INT>>, "
    "found ARRAY<STRUCT<kind STRING, start INT, end INT, layer INT>>, n_layers INT, n_cut INT"
)


def scan(text: str) -> list[Find]:
    """(start, kind, end) of the matches in one layer, by start and then kind."""
    found: list[Find] = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if LONG_HEX.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


class Layer:
    """A decoded text, the original span of each character, and the texts on the way to it."""

    def __init__(self, text: str, spans: list[Span] | Span | None, depth: int) -> None:
        self.text, self.spans, self.depth = text, spans, depth

    def original(self, start: int, end: int) -> Span:
        if self.spans is None:
            return start, end
        if isinstance(self.spans, tuple):
            return self.spans
        part = self.spans[start:end]
        return min(a for a, _ in part), max(b for _, b in part)


def _plain(text: str) -> int:
    """How many characters are printable or end lines and columns."""
    if text.isprintable():
        return len(text)
    return sum(c.isprintable() or c in "\t\r\n" for c in text)


def readable(raw: bytes) -> str | None:
    """The text of bytes that are UTF-8 and almost wholly printable."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and _plain(text) >= 0.95 * len(text) else None


class Reading:
    """Whether bytes that come in parts are readable."""

    def __init__(self) -> None:
        self.decoder = codecs.getincrementaldecoder("utf-8")()
        self.size = self.plain = 0
        self.valid = True

    def add(self, part: bytes, final: bool = False) -> None:
        try:
            text = self.decoder.decode(part, final) if self.valid else ""
        except UnicodeDecodeError:
            self.valid, text = False, ""
        self.size += len(text)
        self.plain += _plain(text)

    def readable(self) -> bool:
        self.add(b"", True)
        return self.valid and self.size > 0 and self.plain >= 0.95 * self.size


def _packing(raw: bytes) -> int | None:
    """The window bits that zlib takes for gzip or zlib bytes."""
    if raw[:2] == b"\x1f\x8b":
        return 31
    return 15 if len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0 else None


def unpacked(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(member, bytes) of compressed bytes in parts of bounded size, member after member to the end;
    what follows the last whole one and cannot be unpacked comes as it is. Raises zlib.error if the
    first member cannot be unpacked."""
    member, rest = 0, raw
    while rest:
        mode, start = _packing(rest), rest
        if mode is None:
            yield member, rest
            return
        stream = zlib.decompressobj(mode)
        try:
            more = True
            while more:
                out = stream.decompress(rest, MOST_UNPACKED)
                rest = stream.unconsumed_tail
                more = not stream.eof and bool(out or rest)
                if out:
                    yield member, out
        except zlib.error:
            if not member:
                raise
            yield member + 1, start
            return
        rest = stream.unused_data.lstrip(b"\0")
        member += 1


def _pieces(parts: Iterable[tuple[int, bytes]]) -> Iterator[str]:
    decoder, text = codecs.getincrementaldecoder("utf-8")(), ""
    for _, part in parts:
        text += decoder.decode(part)
        if len(text) >= MOST_UNPACKED and (whole := CUT.match(text)):
            yield text[: whole.end()]
            text = text[whole.end() :]
    if text:
        yield text


def _stretches(parts: Iterable[tuple[int, bytes]]) -> Iterator[str]:
    """The readable stretches of bytes, with a character between them that is in no match."""

    def joined(whole: bytes) -> Iterator[str]:
        if texts := [m.group().decode("utf-8", "ignore") for m in STRETCH.finditer(whole)]:
            yield "\0".join(texts)

    held = b""
    for _, part in parts:
        held += part
        if len(held) >= MOST_UNPACKED and (end := LAST_CONTROL.match(held) or CUT.match(held.decode("latin-1"))):
            yield from joined(held[: end.end()])
            held = held[end.end() :]
    yield from joined(held)


def contents(raw: bytes) -> list[Iterator[str]] | Iterator[Iterator[str]] | None:
    """The readable texts that bytes unpack to, each in pieces that are read one by one; None if the
    bytes are not compressed."""
    if _packing(raw) is None:
        return None
    whole, members = Reading(), {}
    try:
        for member, part in unpacked(raw):
            whole.add(part)
            members.setdefault(member, Reading()).add(part)
    except zlib.error:
        return None
    if whole.readable():
        return [_pieces(unpacked(raw))]
    good = {m for m, r in members.items() if r.readable()}
    by_member = groupby(unpacked(raw), lambda x: x[0])
    return (_pieces(parts) if m in good else _stretches(parts) for m, parts in by_member)


def _spans_of_bytes(text: str, at: list[Span]) -> list[Span]:
    """Spans of the characters of a text from those of its UTF-8 bytes."""
    spans, k = [], 0
    for c in text:
        n = len(c.encode("utf-8"))
        spans.append((at[k][0], at[k + n - 1][1]))
        k += n
    return spans


def _replaced(
    layer: Layer, parts: Iterator[tuple[int, int, str, list[Span]]]
) -> tuple[str, list[Span] | Span] | None:
    """The whole layer with the given parts (start, end, text, spans) put in, as names and values may
    be encoded in part; None without parts."""
    text, spans, k, one = [], [], 0, isinstance(layer.spans, tuple)
    for start, end, part, of_part in parts:
        text += (layer.text[k:start], part)
        if not one:
            spans += (layer.original(i, i + 1) for i in range(k, start))
            spans += of_part
        k = end
    if not k:
        return None
    text.append(layer.text[k:])
    if one:
        return "".join(text), layer.spans
    spans += (layer.original(i, i + 1) for i in range(k, len(layer.text)))
    return "".join(text), spans


def percent_layers(layer: Layer) -> Iterator[tuple[str, list[Span] | Span]]:
    def parts() -> Iterator[tuple[int, int, str, list[Span]]]:
        for m in PERCENT_RUN.finditer(layer.text):
            raw = unquote_to_bytes(m.group())
            at = [layer.original(m.start() + 3 * i, m.start() + 3 * i + 3) for i in range(len(raw))]
            decoded = readable(raw)
            if decoded is None:
                yield m.start(), m.end(), raw.decode("latin-1"), at
            else:
                yield m.start(), m.end(), decoded, _spans_of_bytes(decoded, at)

    if "%" in layer.text and (found := _replaced(layer, parts())):
        yield found


def escape_layers(layer: Layer) -> Iterator[tuple[str, list[Span] | Span]]:
    def parts() -> Iterator[tuple[int, int, str, list[Span]]]:
        for m in ESCAPE.finditer(layer.text):
            code = int(m.group(6)) if m.group(6) else int(next(g for g in m.groups() if g), 16)
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                yield m.start(), m.end(), chr(code), [layer.original(m.start(), m.end())]

    if ("\\" in layer.text or "&#" in layer.text) and (found := _replaced(layer, parts())):
        yield found


def base64_layers(layer: Layer) -> Iterator[tuple[str, list[Span] | Span, bool]]:
    """Text, spans, and whether it is the second piece of a content."""
    for m in BASE64.finditer(layer.text):
        word = m.group().rstrip("=")
        if len(word) % 4 == 1 or word.isalpha() and (word.islower() or word.istitle()):
            continue
        try:
            raw = base64.b64decode(word.replace("-", "+").replace("_", "/") + "=" * (-len(word) % 4), validate=True)
        except binascii.Error:
            continue
        packed = contents(raw)
        if packed is not None:
            for pieces in packed:
                for k, text in enumerate(pieces):
                    yield text, layer.original(m.start(), m.end()), k == 1
            continue
        text = readable(raw)
        if text:
            last = m.start() + len(word)
            at = [
                layer.original(m.start() + 4 * i // 3, min(last, m.start() + (4 * i + 4) // 3 + 1))
                for i in range(len(raw))
            ]
            yield text, _spans_of_bytes(text, at), False


def glued_layers(layer: Layer) -> Iterator[tuple[str, list[Span] | Span, bool]]:
    """As base64_layers, of words that begin before their base64 does or are wrapped over lines."""
    for m in WRAPPED.finditer(layer.text):
        parts = [p.span() for p in BASE64_PART.finditer(layer.text, m.start(), m.end())]
        word = "".join(layer.text[a:b] for a, b in parts)
        if word.isalpha() and (word.islower() or word.istitle()):
            continue
        at = [i for a, b in parts for i in range(a, b)]
        after = [i + 1 for i, c in enumerate(word) if c in "/-_"]
        plain = word.replace("-", "+").replace("_", "/")
        for shift in range(4):
            n = len(word) - shift
            n -= n % 4 == 1
            raw = base64.b64decode(plain[shift : shift + n] + "=" * (-n % 4))
            # Where compressed content may begin: at the start, after a separator, at any gzip mark.
            starts = {0, *(3 * (i - shift) // 4 for i in after if i >= shift and (i - shift) % 4 == 0)}
            starts |= {g.start() for g in GZIP.finditer(raw)}
            if not shift and len(parts) == 1 and len(word) % 4 != 1:
                starts.discard(0)  # base64_layers has it
            for start in sorted(x for x in starts if _packing(raw[x : x + 3]) is not None):
                span = layer.original(m.start(), m.end())
                for pieces in contents(raw[start:]) or ():
                    for k, text in enumerate(pieces):
                        yield text, span, k == 1
            for found in STRETCH.finditer(raw):
                text = found.group().decode("utf-8", "ignore")
                if len(text.encode()) != len(found.group()):
                    text = found.group().decode("latin-1")
                    sizes = [1] * len(text)
                else:
                    sizes = [len(c.encode()) for c in text]
                spans, i = [], found.start()
                for size in sizes:
                    last = min(shift + n, shift + (4 * (i + size - 1) + 4) // 3 + 1) - 1
                    spans.append((layer.original(at[shift + 4 * i // 3], at[shift + 4 * i // 3] + 1)[0], layer.original(at[last], at[last] + 1)[1]))
                    i += size
                yield text, spans, False


def _short(text: str) -> str | bytes:
    """What stands for a text among those met: a digest instead of a long one."""
    return text if len(text) < 4096 else hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def scan_layers(text: str | None) -> tuple[list[Find], dict[Find, int], int, int]:
    """The base finds; every find with the depth of the first layer that shows it; how many layers
    were entered; how many contents are scanned in pieces."""
    first = Layer(text or "", None, 0)
    base = scan(first.text)
    found = {f: 0 for f in base}
    met, layers, cut = {(_short(first.text), None)}, 0, 0

    def inner(layer: Layer) -> Iterator[Layer]:
        nonlocal cut
        for make in (percent_layers, escape_layers, base64_layers, glued_layers):
            for text_, spans, *more in make(layer):
                cut += bool(more and more[0])
                if not text_ or text_ == layer.text:
                    continue
                key = (_short(text_), spans if isinstance(spans, tuple) else (spans[0][0], spans[-1][1]))
                if key not in met:
                    met.add(key)
                    yield Layer(text_, spans, layer.depth + 1)

    work = [iter([first])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        layers += 1
        if layer.depth:
            for start, kind, end in scan(layer.text):
                a, b = layer.original(start, end)
                found[a, kind, b] = min(layer.depth, found.get((a, kind, b), layer.depth))
        work.append(inner(layer))
    return base, found, layers, cut


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    found_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("layer", pa.int32())])
    )
    for batch in batches:
        bases, founds, layers, cuts = [], [], [], []
        for text in batch.column("text"):
            base, found, n, cut = scan_layers(text.as_py())
            bases.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in base])
            founds.append(
                [{"kind": KINDS[k], "start": a, "end": b, "layer": found[a, k, b]} for a, k, b in sorted(found)]
            )
            layers.append(n)
            cuts.append(cut)
        yield pa.record_batch(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(bases, base_type),
                pa.array(founds, found_type),
                pa.array(layers, pa.int32()),
                pa.array(cuts, pa.int32()),
            ],
            names=["doc_id", "base", "found", "n_layers", "n_cut"],
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, found, n_layers, n_cut) of every row: spans of the first layer, spans of all
    layers with the depth where each shows first, both by start, then kind, then end."""
    return docs.select("doc_id", "text").mapInArrow(_scan, RESULT_SCHEMA)
