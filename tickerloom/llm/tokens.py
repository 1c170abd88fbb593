"""Exact tokenization with bounded tables of distinct pieces.

Both public byte-pair tokenizers used here split a text into pre-tokens before any merge. A new
pre-token always starts at a single white-space character between two visible ones, and at a full
stop or comma after an ASCII letter. So ids(text) is the concatenation of the ids of such pieces,
and a distinct piece has to pass through the library once per filling of the table.

``ChunkEncoder.stream`` cuts, hashes and looks up the pieces of many texts at a time as arrays;
``encode``, ``counted`` and ``measured`` work on one text and cut at single spaces only.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

from tickerloom.llm.hashing import SPACES, span_hashes

#: Distinct chunks a Python worker remembers before it starts afresh (about 200 bytes each).
CACHE_CHUNKS = 500_000

#: Distinct pieces the array table holds before it starts afresh (about 30 bytes each).
TABLE_PIECES = 2_000_000
#: Characters that are encoded at a time as arrays.
STREAM_CHARS = 1 << 22

#: Bytes that are hashed at a time: hashing takes some 40 bytes a byte.
HASH_BYTES = 1 << 19

#: White space other than the six ASCII characters; texts with any take the slower way.
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True

_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This process's encoder for a tokenizer file; Spark reuses Python workers, and so it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _bounded(left: str, right: str) -> bool:
    """Whether the space between two pieces is a single one between visible characters."""
    return bool(left and right) and not (left[-1].isspace() or right[0].isspace())


def chunks_of(text: str) -> list[str]:
    """Split at single spaces; a piece next to longer white space stays with its neighbour.

    Every chunk but the first stands after one space, which belongs to it.
    """
    pieces = text.split(" ")
    runs = [[pieces[0]]]
    for left, right in zip(pieces, pieces[1:]):
        if _bounded(left, right):
            runs.append([right])
        else:
            runs[-1].append(right)
    return [" ".join(run) for run in runs]


def piece_starts(raw: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where pieces start in the joined bytes of texts without other white space."""
    space = SPACES[raw]
    cut = np.zeros(len(raw), bool)
    cut[1:-1] = space[1:-1] & ~space[:-2] & ~space[2:]
    cut[1:] |= _STOP[raw[1:]] & _LETTER[raw[:-1]]
    for edge in (doc_starts, doc_starts - 1):  # neighbours in another text do not count
        inside = edge[(edge >= 0) & (edge < len(raw))]
        cut[inside[space[inside]]] = False
    cut[doc_starts[doc_starts < len(raw)]] = True
    return np.flatnonzero(cut)


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` of adjacent pieces, some bytes at a time."""
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(raw), HASH_BYTES)))
    parts = [
        span_hashes(raw[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)]) if i < j
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


class _Table:
    """Ids by piece hash: sorted hashes, with a place in one pool of ids each."""

    def __init__(self, dtype: np.dtype):
        self.hashes = np.empty(0, np.uint64)
        self.places = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.pool = np.empty(0, dtype)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def unknown(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] != hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Take in new pieces; they can be looked up after ``settle``."""
        self.waiting.append((hashes, ids, lengths))

    def settle(self) -> None:
        hashes, ids, lengths = (np.concatenate(part) for part in zip(*self.waiting))
        self.waiting.clear()
        places = len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate([self.pool, ids])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.places = np.concatenate([self.places, places])[order]
        self.lengths = np.concatenate([self.lengths, lengths])[order]

    def gather(self, hashes: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, where each piece begins in them)."""
        at = np.searchsorted(self.hashes, hashes)
        lengths, places = self.lengths[at][inverse], self.places[at][inverse]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(places - begins, lengths)], begins


class ChunkEncoder:
    """ids(text) as little-endian bytes, ``dtype`` wide."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values(), default=0) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.limit = cache_chunks
        self.cache: dict[str, bytes] = {}
        self.after_space = np.zeros(size, bool)
        self.ends_word = np.zeros(size, bool)
        for token, number in vocabulary.items():
            self.after_space[number] = token.startswith("Ġ")
            self.ends_word[number] = token.endswith("</w>")
        self.table = _Table(self.dtype)
        probe = self.tokenizer.encode(" ab cd", add_special_tokens=False).ids
        self.marks = next(
            (name for name, mark in (("start", self.after_space), ("end", self.ends_word))
             if mark[probe].sum() == 2), None,
        )

    # --- many texts as arrays ---

    def stream(self, texts: Iterable[str], end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text with ``end_id`` after them, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= STREAM_CHARS:
                yield from self._group(held, end_id)
                held, size = [], 0
        yield from self._group(held, end_id)

    def _group(self, texts: list[str], end_id: int) -> Iterator[np.ndarray]:
        plain = [not _OTHER_SPACE.search(t) for t in texts]
        quick = iter(self._plain([t for t, p in zip(texts, plain) if p], end_id))
        for text, is_plain in zip(texts, plain):
            if is_plain:
                yield next(quick)
            else:
                ids = np.frombuffer(self.encode(text), self.dtype)
                yield np.append(ids, self.dtype.type(end_id))

    def _plain(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        parts = [t.encode() for t in texts]
        joined = b"".join(parts)
        raw = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        doc_starts = np.cumsum(sizes) - sizes
        starts = piece_starts(raw, doc_starts[sizes > 0])
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        hashes, first, inverse = np.unique(
            _hashed(raw, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.table.hashes) + len(hashes) > TABLE_PIECES:
            self.table = _Table(self.dtype)
        new = np.flatnonzero(self.table.unknown(hashes))
        if len(new):
            self._learn_pieces(joined, raw, hashes[new], starts[first[new]], ends[first[new]])
        ids, begins = self.table.gather(hashes, inverse)
        begins = np.append(begins, len(ids))
        cuts = begins[np.searchsorted(starts, doc_starts + sizes)]
        ids = np.insert(ids, cuts, self.dtype.type(end_id))
        cuts = (cuts + np.arange(1, len(cuts) + 1)).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn_pieces(
        self, joined: bytes, raw: np.ndarray, hashes: np.ndarray, starts: np.ndarray,
        ends: np.ndarray,
    ) -> None:
        """Encode distinct pieces; single words whose ids can be told apart share a call."""
        spaces = np.concatenate([[0], np.cumsum(SPACES[raw], dtype=np.int32)])
        word = (raw[starts] == 0x20) & (spaces[ends] - spaces[starts] == 1) & (ends - starts > 1)
        spans = list(zip(starts.tolist(), ends.tolist()))
        for low in range(0, len(spans), 4096):
            part = slice(low, low + 4096)
            pieces = [joined[a:b].decode() for a, b in spans[part]]
            solid = word[part]
            if self.marks == "end":
                solid = np.array([p[1:].isalpha() for p in pieces]) & solid
            some = np.flatnonzero(solid)
            if not self._learn_words([pieces[i] for i in some], hashes[part][some]):
                some = some[:0]
            rest = np.setdiff1d(np.arange(len(pieces)), some)
            encoded = self.tokenizer.encode_batch_fast(
                [pieces[i] for i in rest], add_special_tokens=False
            )
            found = [e.ids for e in encoded]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), self.dtype, int(lengths.sum()))
            self.table.add(hashes[part][rest], flat, lengths)
        self.table.settle()

    def _learn_words(self, words: list[str], hashes: np.ndarray) -> bool:
        """Words that each stand after a space, if the ids show where words start or end."""
        if not words or not self.marks:
            return False
        encoded = self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)
        ids = np.array(encoded[0].ids, self.dtype)
        if self.marks == "start":
            starts = np.flatnonzero(self.after_space[ids])
            if len(starts) != len(words) or starts[0] != 0:
                return False
            lengths = np.diff(starts, append=len(ids))
        else:
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(words) or stops[-1] != len(ids):
                return False
            lengths = np.diff(stops, prepend=0)
        self.table.add(hashes, ids, lengths)
        return True

    # --- one text ---

    def encode(self, text: str) -> bytes:
        return b"".join(self._split(text)[2]) if text else b""

    def counted(self, text: str) -> tuple[list[str], list[int]]:
        """The chunks of a text, each but the first with its space, and their token counts."""
        if not text:
            return [], []
        head, rest, ids = self._split(text)
        width = self.dtype.itemsize
        return [head, *(f" {c}" for c in rest)], [len(i) // width for i in ids]

    def measured(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the chunks of a text."""
        if not text:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        head, rest, ids = self._split(text)
        sizes = np.fromiter(map(len, rest), np.uint64, len(rest)) + np.uint64(1)
        tokens = np.fromiter(map(len, ids), np.uint64, len(ids)) // np.uint64(self.dtype.itemsize)
        return np.concatenate([[np.uint64(len(head))], sizes]), tokens

    def _split(self, text: str) -> tuple[str, list[str], list[bytes]]:
        """(first chunk, the others without their space, ids of each)."""
        if len(self.cache) > self.limit:
            self.cache.clear()
        head, *rest = text.split(" ")
        found = list(map(self.cache.get, rest))
        plain = _bounded(head, head)
        if not plain or None in found:
            missing = {c for c, ids in zip(rest, found) if ids is None}
            if not plain or not all(_bounded(c, c) for c in missing):
                head, *rest = chunks_of(text)
                missing = {c for c in rest if c not in self.cache}
            self._learn(missing)
            found = [self.cache[c] for c in rest]
        return head, rest, [*self._each([head]), *found]

    def _each(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in encoded]

    def _learn(self, missing: set[str]) -> None:
        solid = [c for c in missing if " " not in c and _bounded(c, c)]
        if len(solid) > 8 and self._learn_joined(solid):
            missing = missing.difference(solid)
        others = list(missing)
        self.cache.update(zip(others, self._each([f" {c}" for c in others])))

    def _learn_joined(self, solid: list[str]) -> bool:
        """One library call for many chunks, if ids show where a chunk starts; else False."""
        joined = " " + " ".join(solid)
        found = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        ids = np.array(found, self.dtype)
        starts = np.flatnonzero(self.after_space[ids])
        if len(starts) != len(solid) or starts[0] != 0:
            return False
        raw, width = ids.tobytes(), self.dtype.itemsize
        edges = [*(starts * width).tolist(), len(raw)]
        self.cache.update(zip(solid, (raw[a:b] for a, b in zip(edges, edges[1:]))))
        return True
