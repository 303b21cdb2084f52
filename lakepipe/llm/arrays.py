"""Arrow strings as flat numpy arrays: words, their hashes, windows of words, and sets of them.

Everything works on whole batches at once. Words are maximal runs of bytes other than
[\\x20\\x09-\\x0D]; these bytes never occur inside a longer UTF-8 character. The hash of a word adds
up a fixed random number for each byte at its offset, modulo 2^64; no two words agree by their form,
as they can with polynomials. The hash of a stretch of words is a polynomial of the word hashes with
an odd base, so it is a difference of two prefix sums (the Rabin-Karp identity); a bijective mix
follows either.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
HASH_BYTES = 1 << 19
#: Offsets in a word that have numbers of their own; further ones mix the numbers of these.
OFFSETS = 32
WORD_BASE = 0xD1342543DE82EF95 & ~7 | 5
_MODULUS = 1 << 64

# The white space between words, and the ASCII letters that lower-casing changes.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_BYTES = bytes(_LOWER)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the murmur3 finalizer)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i below n, modulo 2^64; the longest ones asked for are kept."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = -(-n // 65_536) * 65_536
        both = []
        for b in (base, pow(base, -1, _MODULUS)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = (both[0], both[1])
    up, down = _POWERS[base]
    return up[:n], down[:n]


def prefix_sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of values[a:b] is (sums[b] - sums[a]) * inverse[a]."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library

    def _trim(_: int) -> int:
        return 0


def give_back() -> None:
    """Return memory that is free to the system; idle Python workers would keep it otherwise."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive pieces of a string column with about `most` bytes each, or one longer text; nulls as empty."""
    column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, column.slice(at, to - at)
        at = to
    give_back()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls."""
    column = column.cast(pa.large_binary())
    _, offset_buffer, data_buffer = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start:start+length] of every row, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - ends + length, length) + np.arange(total)]


@dataclass
class Words:
    """The words of some texts: `text` is the text each is in, `first[t]` the first word of text t."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = flat(column)
    if lower:
        data = _LOWER[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    space = _SPACE[data]
    bounds = offsets[(offsets > 0) & (offsets < n)]
    opens, closes = np.empty(n, bool), np.empty(n, bool)
    opens[0] = closes[-1] = True
    opens[1:], closes[:-1] = space[:-1], space[1:]
    opens[bounds] = closes[bounds - 1] = True
    start = np.flatnonzero(opens & ~space)
    end = np.flatnonzero(closes & ~space) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, text, first, _word_hashes(data, start, end))


def _numbers() -> np.ndarray:
    """A number for every offset below OFFSETS and every byte, the same everywhere."""
    return mix(mix(np.arange(OFFSETS * 256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + np.uint64(0x2545F4914F6CDD1D))


_NUMBERS = _numbers()


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of data[start:end] for words in order, over pieces of about HASH_BYTES of data."""
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + HASH_BYTES, side="right")))
        length = end[at:to] - start[at:to]
        first = np.cumsum(length) - length
        offset = np.arange(int(length.sum())) - np.repeat(first, length)
        octet = data[np.repeat(start[at:to], length) + offset]
        numbers = _NUMBERS[(offset % OFFSETS << 8) | octet]
        far = np.flatnonzero(offset >= OFFSETS)
        if len(far):
            numbers[far] = mix(numbers[far] + (offset[far] // OFFSETS).astype(np.uint64) * np.uint64(WORD_BASE))
        out[at:to] = mix(np.add.reduceat(numbers, first) + length.astype(np.uint64))
        at = to
    return out


def windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every stretch of `length` consecutive words of one text."""
    last = len(words.text) - length + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.text[:last] == words.text[length - 1 :])
    sums, down = prefix_sums(words.hash, WORD_BASE)
    return at, mix((sums[at + length] - sums[at]) * down[at] + np.uint64(length))


def shingle_sets(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the distinct shingles of text t are hashes[bounds[t]:bounds[t+1]], ascending.

    A text with fewer words than `length` has its whole word sequence as its one shingle; a text
    without words has none.
    """
    at, hashes = windows(words, length)
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < length))
    text = words.text[at]
    if len(short):
        sums, down = prefix_sums(words.hash, WORD_BASE)
        a, b = words.first[short], words.first[short + 1]
        whole = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[fresh], hashes[fresh]
    return np.searchsorted(text, np.arange(words.texts + 1)), hashes


def packed(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Row t holds values[bounds[t]:bounds[t+1]] as an array<bigint>."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
