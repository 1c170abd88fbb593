"""Secret scans with a recursive decoding worklist.

A document is layer 0. Every layer is scanned for three kinds of secret, then unwrapped:

- percent escapes (also %uXXXX, and with + for a blank as forms have it), escapes of JSON and
  JavaScript (\\uXXXX, \\u{X}, \\xXX, octal), HTML entities (by number or name) and full-width letters
  are decoded in place, piece by piece: a piece ends where no match can go on, and each piece with
  escapes gives one new layer of each of these kinds;
- each long base64 run, also one that goes on over line breaks, is decoded at its four alignments,
  and any gzip, zlib, bzip2, xz or lzma data that start anywhere in it are undone, member after
  member and however often repeated; raw deflate and zlib of a small window, which no mark shows,
  if they make up the run from its start. What is text gives a layer of its own, and of other bytes each stretch
  of printable characters, in one byte each or in UTF-16.

New layers join the worklist until none is left. A layer is dropped if the same content was seen
at the same place before (cycles, archives that hold themselves). Every layer knows how its
characters lie in its parent, so spans found anywhere are reported on the original text (code
points, end exclusive). Layer 0's own matches are the base and always stay.

``max_decoded`` bounds what may be decompressed out of one document, against decompression bombs.
What is decoded in place or out of base64 never grows, so a text of any length is decoded whole;
only against endless nesting all layers together hold at most ``NESTED`` characters for each
character of the text and of what was decompressed (or ``max_decoded``, if more). A document that
would exceed a bound is fully scanned as far as it was decoded and has ``cut`` set, and ``redact``
replaces what it could not read.

Defined cases: a null text is empty (no spans); equal rows give equal rows; an empty table gives
no rows; other columns are ignored by ``find_secrets`` and kept by ``redact``.
"""

from __future__ import annotations

import binascii
import bz2
import html
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import release_memory, text_column, texts_of

KINDS = ("assign", "access", "hex")
MAX_DECODED = 1 << 26
NESTED = 64
PIECE = 1 << 16

FOUND = (
    "doc_id long, spans array<struct<kind:string,start:long,end:long,layer:int>>, cut boolean"
)

_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_KEYWORDS = ("passw", "secret", "token", "api")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}", re.ASCII)
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++"
    r"(?:[ \t]*+(?:\r\n?|\n|\\r\\n|\\n)[ \t>]*+[A-Za-z0-9+/_-]++)++",
    re.ASCII,
)
_LINE = re.compile(r"[ \t]*+(?:\r\n?|\n|\\r\\n|\\n)[ \t>]*+")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:%u[0-9A-Fa-f]{4})+", re.ASCII)
_FORM = re.compile(r"\+|(?:%[0-9A-Fa-f]{2})+", re.ASCII)
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
    r"|\\[0-3][0-7]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});?|&[A-Za-z][A-Za-z0-9]{1,31};",
    re.ASCII,
)
_FULL_WIDTH = re.compile("[\uff01-\uff5e]+")
# Where no secret, escape or run goes on, however much of the text around is decoded: at other
# characters than theirs, and between two plain words.
_BREAK = re.compile(
    r"""[^A-Za-z0-9+/_.=\-"':%\\&#;>{}\s\uff01-\uff5e]|(?<=\s)[A-Za-z.]{1,15}\x20(?=[A-Za-z.]{1,15}\s)""", re.ASCII
)
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7e]{16,}")
_WIDE = re.compile(rb"[\t\n\r\x20-\x7e](?:\x00[\t\n\r\x20-\x7e]){15,}")
_MEMBER = re.compile(
    rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|\x5d\x00\x00[\x00-\xff]{2}(?:\xff{8}|[\x00-\xff]{4}\x00{4})|BZh[1-9](?:1AY&SY|\x17\x72\x45\x38\x50\x90)|\xfd7zXZ\x00"
)
_FEED = 1 << 16  # bytes given to a decompressor at a time

Span = tuple[str, int, int]
ToParent = Callable[[int, int], tuple[int, int]]
Layer = tuple[str, tuple[int, int], tuple, Callable[[int, int], bool] | None, int]


def scan(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """The three kinds in one layer, leftmost and not overlapping within a kind. Access and hex
    matches are made of run characters, so they lie inside the long ``runs`` of the layer."""
    found: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= 12:
                found.append(("assign", match.start(), match.end()))
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        for a, b in runs:
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text, a, b)]
    return found


class _InPlace:
    """A layer made by replacing parts of its parent; maps spans back by its breakpoints."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.edges: list[int] = []  # where each part starts in the layer
        self.origin: list[tuple[int, int, bool]] = []  # its place in the parent; decoded?

    def add(self, text: str, start: int, end: int, decoded: bool) -> None:
        if text:
            self.edges.append(self.size)
            self.origin.append((start, end, decoded))
            self.parts.append(text)
            self.size += len(text)

    def to_parent(self, start: int, end: int) -> tuple[int, int]:
        first, last = bisect_right(self.edges, start) - 1, bisect_right(self.edges, end - 1) - 1
        a, _, decoded = self.origin[first]
        low = a if decoded else a + start - self.edges[first]
        a, b, decoded = self.origin[last]
        return low, b if decoded else a + end - self.edges[last]

    def touched(self, start: int, end: int) -> bool:
        """Whether a span holds a decoded character."""
        first, last = bisect_right(self.edges, start) - 1, bisect_right(self.edges, end - 1) - 1
        return any(self.origin[i][2] for i in range(first, last + 1))


def _units(run: str, head: int) -> Iterator[tuple[str, int]]:
    """(character, length of its source) of consecutive UTF-16 units with a head each."""
    step = head + 4
    units = [int(run[i + head : i + step], 16) for i in range(0, len(run), step)]
    while units:
        take = 2 if len(units) > 1 and 0xD800 <= units[0] < 0xDC00 <= units[1] < 0xE000 else 1
        raw = b"".join(u.to_bytes(2, "little") for u in units[:take])
        yield raw.decode("utf-16-le", "replace"), step * take
        del units[:take]


def _percent_characters(run: str) -> Iterator[tuple[str, int]]:
    """(character, length of its source) of consecutive %XX or %uXXXX."""
    if run[1] == "u":
        yield from _units(run, 2)
        return
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        for character in raw.decode():
            yield character, 3 * len(character.encode())
    except UnicodeDecodeError:
        for byte in raw:
            yield chr(byte), 3


def _form_characters(run: str) -> Iterator[tuple[str, int]]:
    if run == "+":
        yield " ", 1
    else:
        yield from _percent_characters(run)


def _escape_characters(run: str) -> Iterator[tuple[str, int]]:
    if run[0] == "&":
        yield html.unescape(run), len(run)
    elif run[1] == "u" and run[2] != "{":
        yield from _units(run, 2)
    else:
        code = int(run[2:].strip("{}"), 16) if run[1] in "uUx" else int(run[1:], 8)
        valid = code < 0xD800 or 0xE000 <= code < 0x110000
        yield chr(code) if valid else "\ufffd", len(run)


def _narrow_characters(run: str) -> Iterator[tuple[str, int]]:
    for character in run:
        yield chr(ord(character) - 0xFEE0), 1


# What a text must hold to be decoded so, and how.
_MARKS = (
    (lambda t: "%" in t, _PERCENT, _percent_characters),
    (lambda t: "+" in t and ("%" in t or "=" in t), _FORM, _form_characters),
    (lambda t: "\\" in t or "&" in t, _ESCAPE, _escape_characters),
    (lambda t: not t.isascii() and _FULL_WIDTH.search(t), _FULL_WIDTH, _narrow_characters),
)


def _decode_in_place(text: str, pattern: re.Pattern, characters) -> _InPlace | None:
    layer, at = None, 0
    for match in pattern.finditer(text):
        layer = layer or _InPlace()
        layer.add(text[at : match.start()], at, match.start(), False)
        at = match.start()
        for character, length in characters(match[0]):
            layer.add(character, at, at + length, True)
            at += length
    if layer:
        layer.add(text[at:], at, len(text), False)
    return layer


def _pieces(text: str) -> Iterator[tuple[int, int]]:
    """Pieces of about ``PIECE`` characters that end at a break."""
    low = 0
    while low < len(text):
        near = _BREAK.search(text, low + PIECE) if len(text) - low > PIECE else None
        high = near.end() if near else len(text)
        yield low, high
        low = high


def _member(
    raw: bytes, at: int, most: int, window: int | None = None
) -> tuple[bytes, int | None] | None:
    """The content, at most ``most`` bytes, of the compressed data at ``at``, and their end if it
    was met; None if there are none. ``window``: zlib's, for data that no mark shows."""
    if window:
        undo = zlib.decompressobj(window)
    elif raw[at] in b"\x1f\x78":
        undo = zlib.decompressobj(47)
    elif raw[at] == ord("B"):
        undo = bz2.BZ2Decompressor()
    else:
        undo = lzma.LZMADecompressor()
    parts, size, feed = [], 0, 256
    try:
        while at < len(raw) and size < most and not undo.eof:
            parts.append(undo.decompress(raw[at : at + feed], most - size))
            size += len(parts[-1])
            at, feed = min(at + feed, len(raw)), min(4 * feed, _FEED)
    except (zlib.error, OSError, lzma.LZMAError, EOFError):
        pass
    end = at - len(undo.unused_data) if undo.eof else None
    return (b"".join(parts), end) if size else None


def _unmarked(raw: bytes) -> Iterator[int]:
    """zlib windows that bytes without a mark may have been compressed by."""
    if raw[0] & 15 == 8 and raw[0] >> 4 < 8 and int.from_bytes(raw[:2], "big") % 31 == 0:
        yield 15
    if raw[0] & 6 in (2, 4):  # a block of either code; stored bytes show as they are
        yield -15


def _texts(raw: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, end, text): all of the bytes if they are text, else their printable stretches."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = None
    if text is not None and not _CONTROL.search(text):
        if text:
            yield 0, len(raw), text
        return
    for match in _PRINTABLE.finditer(raw):
        yield *match.span(), match[0].decode()
    for match in _WIDE.finditer(raw):
        yield *match.span(), match[0][::2].decode()


def _unbase64(run: str) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, bytes) of a run at its four alignments; both alphabets."""
    plain = run.replace("-", "+").replace("_", "/")
    for skip in range(4):
        size = len(plain) - skip
        size -= size % 4 == 1
        if size < 16:
            return
        part = plain[skip : skip + size]
        yield skip, skip + size, binascii.a2b_base64(part + "=" * (-size % 4))


def _root(maps: tuple | None, a: int, b: int) -> tuple[int, int]:
    """A span on the original text, through the maps from each layer to its parent."""
    while maps is not None:
        back, maps = maps
        a, b = back(a, b)
    return a, b


def _same(content: str | bytes) -> bytes:
    """Equal for equal content of one type."""
    if isinstance(content, bytes):
        kind, raw = b"b", content
    else:
        kind, raw = b"t", content.encode("utf-8", "surrogatepass")
    return kind + (raw if len(raw) <= 32 else blake2b(raw, digest_size=32).digest())


class _Work:
    """The worklist of one document."""

    def __init__(self, text: str, most: int):
        self.text, self.left, self.cut = text, most, False
        self.nested = max(most, NESTED * len(text))
        self.seen: set[tuple[int, int, bytes]] = set()
        self.found: dict[Span, int] = {}
        self.unread: set[tuple[int, int]] = set()

    def run(self) -> list[tuple[str, int, int, int]]:
        """Layers in depth first order, each made when its turn comes."""
        todo = [self._layer(self.text, (0, len(self.text)), None, None, 0)]
        while todo:
            inner = next(todo[-1], None)
            if inner is None:
                todo.pop()
            else:
                todo.append(self._layer(*inner))
        order = sorted(self.found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        return [(*span, self.found[span]) for span in order]

    def _layer(
        self, text: str, place: tuple[int, int], maps: tuple | None, touched, depth: int
    ) -> Iterator[Layer]:
        """Scans a layer and gives the layers in it. ``place`` is what it came out of, on the
        original text; ``maps`` leads there."""
        runs = [m.span() for m in _RUN.finditer(text)]
        for kind, a, b in scan(text, runs):
            if touched is None or touched(a, b):
                span = (kind, *_root(maps, a, b))
                self.found[span] = min(depth, self.found.get(span, depth))
        marks = [mark for mark in _MARKS if mark[0](text)]
        for low, high in _pieces(text) if marks else ():
            piece = text[low:high]
            source = place if len(piece) == len(text) else _root(maps, low, high)
            for mark, pattern, characters in marks:
                if mark(piece) and (layer := _decode_in_place(piece, pattern, characters)):

                    def back(a, b, layer=layer, low=low):
                        a, b = layer.to_parent(a, b)
                        return a + low, b + low

                    inner = "".join(layer.parts)
                    layer.parts.clear()
                    yield from self._new(inner, source, (back, maps), layer.touched, depth + 1)
        to_root = partial(_root, maps)
        for a, b in runs:
            yield from self._base64(text[a:b], a, to_root, depth)
        for match in _WRAPPED.finditer(text):
            yield from self._wrapped(text, match, to_root, depth)

    def _base64(self, run: str, at: int, to_root: ToParent, depth: int) -> Iterator[Layer]:
        yield from self._encoded(run, [0], [at], to_root, depth)

    def _wrapped(
        self, text: str, match: re.Match, to_root: ToParent, depth: int
    ) -> Iterator[Layer]:
        """A run over line breaks, of which what lies in one line is left to the line's own run."""
        low, high = match.span()
        edges, origins, lines, size = [], [], [], 0
        for line in (*_LINE.finditer(text, low, high), None):
            end = line.start() if line else high
            edges.append(size)
            origins.append(low)
            lines.append(text[low:end])
            size += end - low
            low = line.end() if line else high
        if size >= 16:
            yield from self._encoded("".join(lines), edges, origins, to_root, depth)

    def _encoded(
        self, run: str, edges: list[int], origins: list[int], to_root: ToParent, depth: int
    ) -> Iterator[Layer]:
        """The layers of a run whose lines start at ``edges``, and at ``origins`` in the layer."""
        for low, high, raw in _unbase64(run):

            def place(start: int, end: int) -> tuple[int, int] | None:
                a, b = low + start * 4 // 3, min(high, low - (-end * 4 // 3))
                first, last = bisect_right(edges, a) - 1, bisect_right(edges, b - 1) - 1
                if first == last and len(edges) > 1:
                    return None
                return to_root(origins[first] + a - edges[first], origins[last] + b - edges[last])

            yield from self._bytes(raw, place, depth + 1)

    def _bytes(self, raw: bytes, place: Callable, depth: int) -> Iterator[Layer]:
        """The texts of the bytes and of the compressed data anywhere in them."""
        todo = [(raw, place, depth)]
        while todo:
            raw, place, depth = todo.pop()
            for a, b, text in _texts(raw):
                if (root := place(a, b)) is not None:
                    maps = (lambda a, b, root=root: root, None)
                    yield from self._new(text, root, maps, None, depth)
            at = 0
            while (found := self._compressed(raw, at)) is not None:
                start, at, member = found
                if member is None:
                    continue
                inner, end = member
                at = at if end is None else end
                root = place(start, len(raw) if end is None else end)
                if root is None or (key := (*root, _same(inner))) in self.seen:
                    continue
                self.seen.add(key)
                if len(inner) > self.left:
                    inner = inner[: self.left]
                    self._refuse(root)
                self.left -= len(inner)
                self.nested += NESTED * len(inner)
                todo.append((inner, lambda a, b, root=root: root, depth + 1))

    def _compressed(
        self, raw: bytes, at: int
    ) -> tuple[int, int, tuple[bytes, int | None] | None] | None:
        """(start, where to look on, content and end) of the next compressed data, if any."""
        if at == 0 and len(raw) > 1 and not _MEMBER.match(raw):
            for window in _unmarked(raw):
                member = _member(raw, 0, self.left + 1, window)
                # Any bytes may look like a beginning; data without a mark must come to an end.
                if member is not None and member[1] is not None:
                    return 0, 1, member
        if (match := _MEMBER.search(raw, at)) is None:
            return None
        return match.start(), match.start() + 1, _member(raw, match.start(), self.left + 1)

    def _refuse(self, place: tuple[int, int]) -> None:
        self.cut = True
        self.unread.add(place)

    def _new(
        self, text: str, place: tuple[int, int], maps: tuple, touched, depth: int
    ) -> Iterator[Layer]:
        if (key := (*place, _same(text))) in self.seen:
            return
        if len(text) > self.nested:
            self._refuse(place)
            return
        self.nested -= len(text)
        self.seen.add(key)
        yield text, place, maps, touched, depth


def secrets_in(text: str, most: int = MAX_DECODED) -> tuple[list[tuple[str, int, int, int]], bool]:
    """([(kind, start, end, layer)] by start, then kind; whether the decoding bound was met)."""
    work = _Work(text, most)
    return work.run(), work.cut


# --- the Spark operators --------------------------------------------------------------------


def find_secrets(docs: DataFrame, max_decoded: int = MAX_DECODED) -> DataFrame:
    """(doc_id, spans, cut): one row per document."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("layer", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [secrets_in(text, max_decoded) for text in texts_of(batch)]
            spans = [
                [dict(zip(("kind", "start", "end", "layer"), s)) for s in found]
                for found, _ in results
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(kind)),
                 pa.array([cut for _, cut in results], pa.bool_())],
                ["doc_id", "spans", "cut"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return rows.mapInArrow(run, FOUND)


def redacted(text: str, max_decoded: int = MAX_DECODED) -> str:
    """The text with every secret replaced, and what a bound kept from being read; overlapping
    spans become one mark."""
    work = _Work(text, max_decoded)
    spans = [(start, end, kind) for kind, start, end, _ in work.run()]
    if work.unread:
        spans = sorted([*spans, *((*place, "unread") for place in work.unread)], key=lambda s: s[0])
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, max_decoded: int = MAX_DECODED) -> DataFrame:
    """The documents, all columns, with secrets replaced in ``text``; null texts stay null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        found = [
            None if t is None else redacted(t, max_decoded) for t in (v.as_py() for v in texts)
        ]
        release_memory()
        return pa.array(found, pa.string())

    text = F.col("text")
    kind = docs.schema["text"].dataType
    return docs.withColumn("text", clean(text.cast("string")).cast(kind)).select(*docs.columns)


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _listed(spans: Column) -> Column:
    one = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the base spans' sha256 and all spans as text."""
    base = F.filter("spans", lambda s: s["layer"] == 0)
    return found.select(
        "doc_id", *[_count(base, kind) for kind in KINDS], F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"), "cut",
    )
