"""Counting quotient filters of packed n-grams, lossless.

An n-gram of word ids is packed into bits and permuted by a Feistel network, which can be undone, so its high
bits (block and quotient) are spread evenly and quotient and remainder together still are the n-gram. A filter lists
the n-grams of one block in order: a bit for each quotient that occurs, a bit at the end of each quotient's run, the full remainders, and a
counter of one byte, with longer counts behind. Sorted filters of many shards are merged by merging their runs.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_HEAD = struct.Struct("<QBB")
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_LONG_COUNT = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    z = values ^ np.uint64(salt)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@dataclass(frozen=True)
class Packing:
    """n-grams of ``words`` ids of ``id_bits`` bits, as two halves of equal width; an odd number of bits is made even."""

    words: int
    id_bits: int

    @property
    def even_bits(self) -> int:
        return self.id_bits + self.id_bits % 2

    @property
    def half(self) -> int:
        return self.words * self.even_bits // 2

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        b = np.uint64(self.even_bits)
        ids = [x.astype(np.uint64) for x in ids]
        if self.words == 2:
            return ids[0], ids[1]
        if self.words == 4:
            return (ids[0] << b) | ids[1], (ids[2] << b) | ids[3]
        cut = np.uint64(self.even_bits // 2)
        return (ids[0] << cut) | (ids[1] >> cut), ((ids[1] & _mask(int(cut))) << b) | ids[2]

    def unpack(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        b, low = np.uint64(self.even_bits), _mask(self.even_bits)
        if self.words == 2:
            return [left, right]
        if self.words == 4:
            return [left >> b, left & low, right >> b, right & low]
        cut = np.uint64(self.even_bits // 2)
        return [left >> cut, ((left & _mask(int(cut))) << cut) | (right >> b), right & low]

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = _mask(self.half)
        for i, salt in enumerate(_ROUNDS):
            if i % 2:
                right = right ^ (_mix(left, salt) & mask)
            else:
                left = left ^ (_mix(right, salt) & mask)
        # The last word goes to the left, whose high bits choose block and quotient.
        return left ^ (_mix(right, 1) & mask), right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = _mask(self.half)
        left = left ^ (_mix(right, 1) & mask)
        for i, salt in reversed(list(enumerate(_ROUNDS))):
            if i % 2:
                right = right ^ (_mix(left, salt) & mask)
            else:
                left = left ^ (_mix(right, salt) & mask)
        return left, right


def counted(half: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (left, right) in order with their counts. The sort is stable, so sorted runs are merged, not sorted anew."""
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    if half <= 32:
        key = (left << np.uint64(half)) | right
        if counts is None:
            key = np.sort(key, kind="stable")
        else:
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        left, right = key[first] >> np.uint64(half), key[first] & _mask(half)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        counts = None if counts is None else counts[order]
        first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        left, right = left[first], right[first]
    if counts is None:
        return left, right, np.diff(np.append(first, len(key) if half <= 32 else len(order)))
    return left, right, np.add.reduceat(counts, first)


def _low_bytes(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(len(values), 8)[:, :width].tobytes()


def _from_low_bytes(data: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.view("<u8").reshape(n)


def encode(packing: Packing, block_bits: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> list[tuple[int, bytes]]:
    """A filter for each block that has entries; the entries are distinct and in order."""
    rest_bits = packing.half - block_bits
    blocks = (left >> np.uint64(rest_bits)).astype(np.int64) if block_bits else np.zeros(len(left), np.int64)
    edges = np.flatnonzero(np.append(True, np.diff(blocks) != 0)) if len(left) else []
    right_bytes = -(-packing.half // 8)
    out = []
    for start, end in zip(edges, np.append(edges[1:], len(left))):
        n = int(end - start)
        rest = left[start:end] & _mask(rest_bits)
        quotient_bits = min(rest_bits, max(0, (n - 1).bit_length()))
        low_bits = rest_bits - quotient_bits
        quotient = (rest >> np.uint64(low_bits)).astype(np.int64) if low_bits < 64 else np.zeros(n, np.int64)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[quotient] = True
        run_end = np.append(np.diff(quotient) != 0, True)
        many = counts[start:end]
        parts = [
            _HEAD.pack(n, quotient_bits, block_bits),
            np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(),
            _low_bytes(rest & _mask(low_bits), -(-low_bits // 8)),
            _low_bytes(right[start:end], right_bytes),
            np.minimum(many, _LONG_COUNT).astype(np.uint8).tobytes(),
            many[many >= _LONG_COUNT].astype("<i8").tobytes(),
        ]
        out.append((int(blocks[start]), b"".join(parts)))
    return out


def decode(packing: Packing, block: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a filter, as they went in."""
    view = memoryview(data)
    n, quotient_bits, block_bits = _HEAD.unpack_from(view)
    at = _HEAD.size

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size : at]

    rest_bits = packing.half - block_bits
    low_bits = rest_bits - quotient_bits
    occupied = np.unpackbits(np.frombuffer(take(-(-(1 << quotient_bits) // 8)), np.uint8), count=1 << quotient_bits)
    run_end = np.unpackbits(np.frombuffer(take(-(-n // 8)), np.uint8), count=n).astype(bool)
    lengths = np.diff(np.append(0, np.flatnonzero(run_end) + 1))
    quotient = np.repeat(np.flatnonzero(occupied), lengths).astype(np.uint64)
    low_width, right_bytes = -(-low_bits // 8), -(-packing.half // 8)
    low = _from_low_bytes(take(n * low_width), n, low_width)
    right = _from_low_bytes(take(n * right_bytes), n, right_bytes)
    counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
    counts[counts == _LONG_COUNT] = np.frombuffer(view[at:], "<i8")
    left = low if low_bits == 64 else (quotient << np.uint64(low_bits)) | low
    if block_bits:
        left = left | np.uint64(block << rest_bits)
    return left, right, counts


def merge(packing: Packing, filters: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of all filters of a block, equal ones added up."""
    parts = [decode(packing, block, data) for block, data in filters]
    return counted(packing.half, *(np.concatenate(column) for column in zip(*parts)))
