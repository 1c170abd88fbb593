"""Vectorised 64-bit hashes of words and of word windows, the same in every process.

A word's hash is a sum of random byte codes times powers of an odd base (modulo 2**64), taken as
a difference of prefix sums, then mixed. A window's hash mixes the hashes of its words in order.
The codes come from a fixed seed; two different words or windows are equal with a probability of
about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(
    0, 1 << 64, 256, dtype=np.uint64, endpoint=False
)
_BASE = 0x9E3779B97F4A7C15 | 3  # 3 modulo 4, so swapped neighbours differ
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
#: Bytes hashed at a time; longer texts are cut at words.
PIECE = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for n = PIECE."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        powers = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            while len(powers) < n:
                step = np.uint64(pow(base, len(powers), 1 << 64))
                powers = np.concatenate([powers, powers * step])
        _POWERS[base] = powers
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per stretch of bytes."""
    return stretch_hashes(prefix_sums(raw), starts, ends)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Of the bytes' codes times their powers; ``stretch_hashes`` takes differences of them."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_CODES[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per stretch of bytes, which may overlap, from the prefix sums."""
    with np.errstate(over="ignore"):
        found = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]
        found += (ends - starts).astype(np.uint64)
    return mixed(found)


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    inside = ~SPACES[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return span_hashes(raw, edges[::2], edges[1::2])


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while len(raw) - at > PIECE:
        spaces = np.flatnonzero(SPACES[raw[at : at + PIECE]])
        if len(spaces):
            cut = at + int(spaces[-1]) + 1
        else:  # one word longer than a piece
            further = np.flatnonzero(SPACES[raw[at + PIECE :]])
            cut = at + PIECE + int(further[0]) + 1 if len(further) else len(raw)
        yield raw[at:cut]
        at = cut
    if at < len(raw):
        yield raw[at:]


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word (run of bytes other than space and 0x09..0x0D), in order."""
    raw = np.frombuffer(text, np.uint8)
    parts = [_piece_hashes(piece) for piece in _pieces(raw)]
    return np.concatenate(parts) if parts else _NONE


_NONE = np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` consecutive words; none if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return _NONE
    total = np.zeros(n, np.uint64)
    step = np.uint64(0xD1342543DE82EF95)
    with np.errstate(over="ignore"):
        for k in range(size):
            total *= step
            total += words[k : k + n]
    return mixed(total)


# --- many integers as few bytes ---------------------------------------------------------------


def pack_integers(values: np.ndarray, codec) -> bytes:
    """Unsigned 64-bit integers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return codec.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpack_integers(data: bytes, n: int, codec) -> np.ndarray:
    planes = np.frombuffer(codec.decompress(data, 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)
