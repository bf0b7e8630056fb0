"""Words of many texts at once, in numpy: bounds, 64-bit hashes and window hashes.

A batch is a pyarrow string array. Words are maximal runs of bytes of one class, so UTF-8 need
not be decoded. Hashes are polynomials modulo 2**64 over a random byte table, so the hash of any
byte range comes from prefix sums. For words these are laid out in blocks of bytes, so that a long
text takes little more than its bytes and some numbers for each word. Two different words, lines or
windows get the same hash with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SLICE_BYTES = 1 << 20
BLOCK = 1 << 16
MASK = (1 << 64) - 1


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """True for bytes of words: all but the given inclusive ranges."""
    keep = np.ones(256, bool)
    for low, high in excluded:
        keep[low : high + 1] = False
    return keep


#: ``[^\\x20\\x09-\\x0D]+``
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z are lower-cased
ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@lru_cache(maxsize=4)
def byte_table(fold: bool) -> np.ndarray:
    """A random value for each byte; with ``fold``, A-Z get those of a-z."""
    values = mix((np.arange(256, dtype=U) + U(1)) * U(0xD1B54A32D192ED03)) | U(1)
    if fold:
        values[65:91] = values[97:123]
    return values


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i from 0 to n."""
    up, down = np.full(n + 1, BASE, U), np.full(n + 1, pow(BASE, -1, 1 << 64), U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _inverse(at: np.ndarray) -> np.ndarray:
    """BASE**-i for each i of ``at``, from tables of a block's length and of blocks."""
    _, down = powers(BLOCK)
    top = int(at.max(initial=0)) // BLOCK + 1
    by_block = np.full(top, down[BLOCK], U)
    by_block[0] = 1
    return down[at % BLOCK] * np.multiply.accumulate(by_block)[at // BLOCK]


class Prefix:
    """Hashes of any ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, U)
        up, _ = powers(BLOCK)
        scale, total = 1, U(0)
        for low in range(0, len(values), BLOCK):
            part = values[low : low + BLOCK] * (up[: min(BLOCK, len(values) - low)] * U(scale))
            np.cumsum(part, out=self.sums[low + 1 : low + 1 + len(part)])
            self.sums[low + 1 : low + 1 + len(part)] += total
            total = self.sums[low + len(part)]
            scale = scale * int(up[BLOCK]) & MASK

        blocks = -(-(len(values) + 1) // BLOCK)
        self.down = np.multiply.outer(_inverse(np.arange(blocks) * BLOCK), powers(BLOCK)[1][:BLOCK]).ravel()[: len(values) + 1]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U))

    def all(self, width: int) -> np.ndarray:
        """Of the ranges of ``width`` values from each place on."""
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width] + U(width))


def range_hashes(data: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same as ``Prefix(table[data]).of(starts, ends)`` for rising starts and rising ends; the
    values of a block of bytes are laid out at a time."""
    up, _ = powers(BLOCK)
    low, high = np.zeros(len(starts), U), np.zeros(len(starts), U)
    scale, total = 1, U(0)
    for at in range(0, len(data), BLOCK):
        part = table[data[at : at + BLOCK]]
        part *= up[: len(part)] * U(scale)
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(part, out=sums[1:])
        sums += total
        for places, into in ((starts, low), (ends, high)):
            a, b = np.searchsorted(places, (at, at + len(part)), "right")
            a = a if at else 0
            into[a:b] = sums[places[a:b] - at]
        total = sums[-1]
        scale = scale * int(up[BLOCK]) & MASK
    return mix((high - low) * _inverse(starts) + (ends - starts).astype(U))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text comes alone, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        _, offsets = raw(batch.column(at))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


class Words:
    """Words of a string array: ``start`` and ``end`` (byte bounds), ``doc`` (row), ``hash``;
    ``first`` has the number of the first word of each row, and the number of words at its end."""

    def __init__(self, texts: pa.Array, keep: np.ndarray, fold: bool):
        self.bytes, self.offsets = raw(texts)
        n = len(self.bytes)
        inside = np.zeros(n + 1, bool)
        inside[:n] = keep[self.bytes]
        bound = np.zeros(n + 1, bool)
        bound[self.offsets] = True
        before = np.zeros(n + 1, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | bound))
        self.end = np.flatnonzero(before & (~inside | bound))
        self.inside = inside[:n]
        self.hash = self.hashes(self.start, self.end, fold)
        self.first = np.searchsorted(self.start, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
        """Hashes of byte ranges; both bounds rise."""
        return range_hashes(self.bytes, byte_table(fold), starts, ends)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words at which a window of ``size`` words of one row starts, and its hash."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        total = np.zeros(len(at), U)
        for j in range(size):
            total += self.hash[at + j] * U(pow(0xA0761D6478BD642F, j + 1, 1 << 64) | 1)
            total ^= total >> U(29)
        return at, mix(total)

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row have a flag."""
        at = np.flatnonzero(flags)
        return np.diff(np.searchsorted(at, self.offsets))

    def word_sums(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a value of each word, by row."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True for the values that occur twice or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = ordered[1:] == ordered[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    out = np.zeros(len(keys), bool)
    out[order] = same
    return out
