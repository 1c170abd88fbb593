"""An open-addressed NumPy table that interns stretches of one buffer, by xxhash64 and bytes.

All stretches are hashed, placed and compared as arrays: linear probing goes in rounds, in which
every stretch that has no slot yet tries the next one.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

# The primes of xxhash64.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)

#: Longer stretches pass through the library or are compared one by one.
SHORT = 31


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _lanes(buffer: bytes) -> np.ndarray:
    """The little-endian 64-bit integer that starts at each byte, zeros after the end."""
    padded = buffer + bytes(SHORT + 8)
    return np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))


def _hash_equal_lengths(lanes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """xxhash64 (seed 0) of stretches that all have one length of at most ``SHORT``."""
    found = np.full(len(starts), _P5 + np.uint64(length), np.uint64)
    at = 0
    while length - at >= 8:
        found ^= _turned(lanes[starts + at] * _P2, 31) * _P1
        found = _turned(found, 27) * _P1 + _P4
        at += 8
    if length - at >= 4:
        found ^= (lanes[starts + at] & np.uint64(0xFFFFFFFF)) * _P1
        found = _turned(found, 23) * _P2 + _P3
        at += 4
    while at < length:
        found ^= (lanes[starts + at] & np.uint64(0xFF)) * _P5
        found = _turned(found, 11) * _P1
        at += 1
    found = (found ^ (found >> np.uint64(33))) * _P2
    found = (found ^ (found >> np.uint64(29))) * _P3
    return found ^ (found >> np.uint64(32))


def _by_length(lengths: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The places of stretches of each length from 0 to ``SHORT``, and those of longer ones."""
    capped = np.minimum(lengths, SHORT + 1).astype(np.uint8)
    order = np.argsort(capped, kind="stable")
    cuts = np.searchsorted(capped[order], np.arange(SHORT + 2))
    return np.split(order, cuts[1:])[:-1], order[cuts[-1] :]


def hash_stretches(
    buffer: bytes, lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """xxhash64 of each stretch of ``buffer``."""
    found = np.empty(len(starts), np.uint64)
    short, long = _by_length(lengths)
    with np.errstate(over="ignore"):
        for length, some in enumerate(short):
            if len(some):
                found[some] = _hash_equal_lengths(lanes, starts[some], length)
    ends = (starts[long] + lengths[long]).tolist()
    found[long] = [xxhash.xxh64_intdigest(buffer[a:b]) for a, b in zip(starts[long].tolist(), ends)]
    return found


def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 steps: of a byte, of two bytes, and of two bytes with two more after them."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> np.uint32(1)) ^ np.where(one & 1, np.uint32(0xEDB88320), np.uint32(0))
    after = [one]
    for _ in range(3):
        after.append((after[-1] >> np.uint32(8)) ^ one[after[-1] & 0xFF])
    low, high = np.arange(1 << 16) & 0xFF, np.arange(1 << 16) >> 8
    return one, after[1][low] ^ after[0][high], after[3][low] ^ after[2][high]


_CRC_BYTE, _CRC_PAIR, _CRC_EARLY_PAIR = _crc_tables()


def _crc_equal_lengths(lanes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """crc32 of stretches that all have one length of at most ``SHORT``."""
    found = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    at = 0
    while at < length:
        rest = length - at
        lane = lanes[starts + at] if at % 8 == 0 else lane >> np.uint64(32 if at % 4 == 0 else 16)
        if rest >= 4:
            found ^= lane.astype(np.uint32)
            found = _CRC_EARLY_PAIR[found & 0xFFFF] ^ _CRC_PAIR[found >> np.uint32(16)]
            at += 4
        elif rest >= 2:
            found ^= lane.astype(np.uint16)
            found = (found >> np.uint32(16)) ^ _CRC_PAIR[found & 0xFFFF]
            at += 2
        else:
            found ^= lane.astype(np.uint8)
            found = (found >> np.uint32(8)) ^ _CRC_BYTE[found & 0xFF]
            at += 1
    return ~found


def crc_stretches(
    buffer: bytes, lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Unsigned crc32 of each stretch of ``buffer``."""
    found = np.empty(len(starts), np.int64)
    short, long = _by_length(lengths)
    for length, some in enumerate(short):
        if len(some):
            found[some] = _crc_equal_lengths(lanes, starts[some], length)
    ends = (starts[long] + lengths[long]).tolist()
    found[long] = [zlib.crc32(buffer[a:b]) for a, b in zip(starts[long].tolist(), ends)]
    return found


class NgramTable:
    """Distinct stretches of one buffer: a slot each, with its bucket and count."""

    def __init__(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray, buckets: int):
        self.buffer, self.lanes = buffer, _lanes(buffer)
        self.starts, self.lengths = starts, ends - starts
        self.keys = hash_stretches(buffer, self.lanes, starts, self.lengths)
        self.holder = np.full(1 << max(4, (2 * len(starts)).bit_length()), -1, np.int64)
        #: The slot of each stretch.
        self.slots = self._placed()
        self.used = np.flatnonzero(self.holder >= 0)
        self.counts = np.bincount(self.slots, minlength=len(self.holder))
        firsts = self.holder[self.used]
        codes = crc_stretches(buffer, self.lanes, starts[firsts], self.lengths[firsts])
        self.bucket = np.zeros(len(self.holder), np.int64)
        self.bucket[self.used] = codes % buckets

    def _placed(self) -> np.ndarray:
        mask = len(self.holder) - 1
        slots = (self.keys & np.uint64(mask)).astype(np.int64)
        waiting = np.arange(len(slots))
        while len(waiting):
            at = slots[waiting]
            free = self.holder[at] < 0
            self.holder[at[free]] = waiting[free]  # of several, one stays
            holder = self.holder[at]
            same = self.keys[holder] == self.keys[waiting]
            same[same] = self._equal(holder[same], waiting[same])
            waiting = waiting[~same]
            slots[waiting] = (slots[waiting] + 1) & mask
        return slots

    def _equal(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the bytes of two stretches are equal."""
        equal = self.lengths[left] == self.lengths[right]
        equal &= (self.lengths[left] <= SHORT) | (left == right)
        a, b, length = self.starts[left], self.starts[right], self.lengths[left]
        for at in range(0, SHORT, 8):
            rest = np.clip(length - at, 0, 8).astype(np.uint64)
            mask = np.where(rest > 0, ~np.uint64(0) >> (np.uint64(64) - rest * np.uint64(8)),
                            np.uint64(0))
            some = np.flatnonzero(equal & (rest > 0) & (a != b))
            differ = (self.lanes[a[some] + at] ^ self.lanes[b[some] + at]) & mask[some]
            equal[some[differ != 0]] = False
        long = np.flatnonzero((length > SHORT) & (left != right))
        for i in long.tolist():
            n, m = int(length[i]), int(self.lengths[right[i]])
            equal[i] = self.buffer[a[i] : a[i] + n] == self.buffer[b[i] : b[i] + m]
        return equal

    def bucket_counts(self, buckets: int) -> np.ndarray:
        """Stretches per bucket, repeats counted."""
        found = np.zeros(buckets, np.int64)
        np.add.at(found, self.bucket[self.used], self.counts[self.used])
        return found

    def gathered(self, gains: np.ndarray) -> np.ndarray:
        """Each stretch's gain, by its slot's bucket."""
        return gains[self.bucket][self.slots]
