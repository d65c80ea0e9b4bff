"""Secret scans with a recursive decoding worklist.

A text is searched for secrets, then every encoding found in it - URL escapes, Unicode escapes, base64
text, also wrapped over lines, base64 of zlib or gzip data - is unwrapped in place. The result is a further layer, which is
searched and unwrapped in turn until no new layer appears; a layer seen before is not taken up
again, which also ends cycles. Every character of a layer knows the span of the input it comes from,
so a secret found at any depth is reported where its encoded form stands.

Defined cases: null is the empty text; an empty table gives no rows; equal rows give equal rows; other
columns are carried by ``redact`` and ignored by ``scan``. Compressed data of any length is unwrapped whole,
all of its members. What one token holds beyond ``MAX_LAYER`` characters is searched and unwrapped window by
window, each as a layer of its own that stands for the token; ``cut_layers`` counts such tokens. Windows end
only where no secret and no token can go on, so nothing is lost; a run without such a place is one window.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import in_slices, mapped

# Kinds and patterns of the base.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_RUN = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8})+"
)
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BASE64_LINE = re.compile(r"\r?\n[\x20\t]*([A-Za-z0-9+/_-]+={0,2})")
BASE64_FIRST = re.compile(r"([A-Za-z0-9+/_-]{16,}={0,2})(?=\r?\n[\x20\t]*[A-Za-z0-9+/_-])")

#: Characters of one compressed token's content that are looked at together.
MAX_LAYER = 1 << 25
#: Places that no secret and no token extends over: characters of none, and one blank between two words.
BORDER = re.compile(r"""[^A-Za-z0-9+/_.=:"'%\\{}\x20\r\n-]|(?<=[A-Za-z0-9,.;])\x20(?=[A-Za-z])""")
_PIECE = 1 << 20

Span = tuple[int, int, str]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) that the patterns find in a text as it is."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def in_order(spans: set | list) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- decoders: token -> text, or None where the token is not of that encoding -----------------


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if not (c.isprintable() or c in "\n\r\t"))
    return text if text and odd * 20 <= len(text) else None


def _url(token: str) -> str | None:
    return bytes.fromhex(token.replace("%", "")).decode("utf-8", "replace")


def _unicode(token: str) -> str | None:
    units = []
    for four, two, braced, eight in re.findall(
        r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})", token
    ):
        code = int(four or two or braced or eight, 16)
        if code > 0xFFFF:
            units.append(chr(code).encode("utf-16-be") if code <= 0x10FFFF else b"\xff\xfd")
        else:
            units.append(code.to_bytes(2, "big"))
    return b"".join(units).decode("utf-16-be", "replace")


def _members(data: bytes) -> Iterator[bytes]:
    """Content of zlib or gzip data in pieces, member after member; what follows the last one as it is."""
    while _pressed(data):
        unpack, rest, got = zlib.decompressobj(zlib.MAX_WBITS | 32), data, False
        try:
            while not unpack.eof and (piece := unpack.decompress(rest, _PIECE)):
                got = True
                yield piece
                rest = unpack.unconsumed_tail
        except zlib.error:
            if not got:
                yield data
            return
        data = unpack.unused_data.lstrip(b"\0")
    if data:
        yield data


def _pressed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (len(data) > 1 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0)


def _windows(data: bytes) -> Iterator[str]:
    """Text of zlib or gzip data, cut at borders where it is longer than MAX_LAYER."""
    decode = codecs.getincrementaldecoder("utf-8")("replace")
    held, size, tried = [], 0, 0
    for piece in _members(data):
        held.append(decode.decode(piece))
        size += len(held[-1])
        if size <= MAX_LAYER or size < 2 * tried:
            continue
        text = "".join(held)
        at = _last_border(text)
        if at:
            yield text[:at]
        held, size, tried = [text[at:]], len(text) - at, 0 if at else size
    yield "".join(held) + decode.decode(b"", True)


def _last_border(text: str) -> int:
    """The last place after the start where no secret or token goes on; 0 if there is none."""
    back = 1 << 10
    while True:
        if found := [m.start() for m in BORDER.finditer(text, max(1, len(text) - back))]:
            return found[-1]
        if back >= len(text):
            return 0
        back *= 16


def _base64(token: str) -> str | Iterator[str] | None:
    body = token.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None
    if _pressed(data) and _opens(data):
        return _windows(data)
    return _readable(data)


def _opens(data: bytes) -> bool:
    try:
        unpack = zlib.decompressobj(zlib.MAX_WBITS | 32)
        return bool(unpack.decompress(data, 1)) or unpack.eof
    except zlib.error:
        return False


class _Token:
    """A stretch of a text, with the methods of a match that are needed of it."""

    def __init__(self, text: str, a: int, b: int):
        self.text, self.a, self.b = text, a, b

    def group(self) -> str:
        return self.text[self.a : self.b]

    def span(self) -> tuple[int, int]:
        return self.a, self.b

    def start(self) -> int:
        return self.a

    def end(self) -> int:
        return self.b


class _Wrapped:
    """Finds base64 that goes on over lines: lines as long as the first, and a last one not longer.

    What stands on the line behind may look like a last line; if all together decode to nothing, the
    lines without it are the token.
    """

    @staticmethod
    def finditer(text: str) -> Iterator[_Token]:
        at = 0
        while first := BASE64_FIRST.search(text, at):
            a, at = first.start(1), first.end(1)
            width, ends = at - a, [at]
            while not text[ends[-1] - 1] == "=" and (line := BASE64_LINE.match(text, ends[-1])):
                if len(line[1]) > width:
                    break
                ends.append(line.end(1))
                if len(line[1]) < width:
                    break
            for end in ends[: -3 : -1] if len(ends) > 2 else ends[:0:-1]:
                if _wrapped(text[a:end]) is not None:
                    yield _Token(text, a, end)
                    at = end
                    break


def _wrapped(token: str) -> str | Iterator[str] | None:
    return _base64("".join(token.split()))


_DECODERS = (
    (URL_RUN, _url),
    (UNICODE_RUN, _unicode),
    (BASE64_RUN, _base64),
    (_Wrapped, _wrapped),
)


class _Layer:
    """A text and, for each of its characters, the span of the input it stands for."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text, self.start, self.end = text, start, end

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def unwrapped(self, pattern: re.Pattern | type[_Wrapped], decode, aside: Callable[[_Layer], None]) -> tuple[_Layer | None, int]:
        """This layer with every token of one encoding replaced, None if there is none; and the number of long ones.

        ``aside`` gets the windows of a token that has several; in its place stand their first and last words.
        """
        pieces, starts, ends, at, cut = [], [], [], 0, 0

        def keep(a: int, b: int) -> None:
            pieces.append(self.text[a:b])
            if self.start is None:
                starts.append(np.arange(a, b))
                ends.append(np.arange(a + 1, b + 1))
            else:
                starts.append(self.start[a:b])
                ends.append(self.end[a:b])

        for m in pattern.finditer(self.text):
            text = decode(m.group())
            if text is None:
                continue
            a, b = self.origin(*m.span())
            if not isinstance(text, str):
                windows = text
                text, last = next(windows), None
                for window in windows:
                    aside(_Layer(text if last is None else last, *_all_of(a, b, len(text if last is None else last))))
                    last = window
                cut += last is not None or len(text) > MAX_LAYER
                if last is not None:
                    aside(_Layer(last, *_all_of(a, b, len(last))))
                    head = BORDER.search(text)
                    text = f"{text[: head.start()] if head else text}\0{last[_last_border(last) :]}"
                if not text:
                    continue
            keep(at, m.start())
            pieces.append(text)
            start, end = _all_of(a, b, len(text))
            starts.append(start)
            ends.append(end)
            at = m.end()
        if not pieces:
            return None, cut
        keep(at, len(self.text))
        if self.start is not None and self.start.strides == (0,):
            text = "".join(pieces)
            return _Layer(text, *_all_of(*self.origin(0, 1), len(text))), cut
        return _Layer("".join(pieces), np.concatenate(starts), np.concatenate(ends)), cut


def _all_of(a: int, b: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of ``n`` characters that all stand for one token; one number each in memory."""
    return np.broadcast_to(np.int64(a), n), np.broadcast_to(np.int64(b), n)


def find(text: str) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, all spans, the number of layers searched and of layers cut, for one text."""
    base = in_order(base_spans(text))
    spans, seen, cut_layers = set(base), {_mark(text)}, 0

    def search(first: _Layer, place: str) -> None:
        """All layers from one on; windows of long tokens are searched through before the next is unwrapped."""
        nonlocal cut_layers
        work = deque([first])
        while work:
            layer = work.popleft()
            for pattern, decode in _DECODERS:
                following, cut = layer.unwrapped(pattern, decode, window)
                cut_layers += cut
                if following is not None and taken(following, place):
                    work.append(following)

    def taken(layer: _Layer, place: str) -> bool:
        mark = _mark(place + layer.text)
        if mark in seen:
            return False
        seen.add(mark)
        for kind, a, b in base_spans(layer.text):
            spans.add((kind, *layer.origin(a, b)))
        return True

    def window(layer: _Layer) -> None:
        # The same window may stand for two tokens, so what comes of it is marked with its place.
        place = f"{layer.start[0]}:{layer.end[0]}:"
        if layer.text and taken(layer, place):
            search(layer, place)

    search(_Layer(text), "")
    return base, in_order(spans), len(seen), cut_layers


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def scan(docs: DataFrame) -> DataFrame:
    """Per document: the secrets found, as counts of the base and as written spans."""

    def row(doc_id, text):
        base, spans, layers, cut = find(text or "")
        counts = [sum(1 for s in base if s[0] == k) for k in KINDS]
        digest = hashlib.sha256(written(base).encode()).hexdigest()
        return [(doc_id, *counts, digest, written(spans), layers, cut)]

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return mapped(
        docs,
        ["doc_id", "text"],
        row,
        f"doc_id {doc_id}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        "spans string, n_layers bigint, cut_layers bigint",
    )


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each stretch of overlapping or touching secrets replaced by ``mark``."""
    if text is None:
        return None
    pieces, at = [], 0
    for a, b in merged((a, b) for _, a, b in find(text)[1]):
        pieces += [text[at:a], mark]
        at = b
    return "".join([*pieces, text[at:]]) if pieces else text


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced in ``text``; ``n_chars`` follows where it is there."""

    def batch(batches):
        for b in in_slices(batches):
            names = b.schema.names
            old = b.column(names.index("text")).to_pylist()
            new = [redacted(t) for t in old]
            arrays = list(b.columns)
            i = names.index("text")
            arrays[i] = pa.array(new, type=b.schema.field(i).type)
            if "n_chars" in names:
                j = names.index("n_chars")
                counts = arrays[j].to_pylist()
                counts = [c if x is y or x == y else len(y) for c, x, y in zip(counts, old, new)]
                arrays[j] = pa.array(counts, type=b.schema.field(j).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

    return docs.mapInArrow(batch, docs.schema)
