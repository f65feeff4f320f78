"""Vectorised word and shingle hashing over whole Arrow string columns.

A batch of texts is taken as one byte buffer. Word bounds, word hashes and
window hashes are computed with numpy for all texts at once; no Python loop
runs over words.

Word hashes are 64 bits: eight bytes at a time through a bijective finaliser,
so words of up to eight bytes never share one, and BLAKE2b for long words.
Nothing is linear in the bytes or words, so no pattern of them (repetition,
Thue-Morse and the like) makes two words or two windows equal; what is left is
chance, n**2 / 2**65 for n different words. Longer stretches (lines, regions)
have 128-bit BLAKE2b digests. Only GRAM hashes are polynomials: they say where to look, and no result depends on their being different.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

#: [\x20\x09-\x0D], the separators of the word contracts.
SPACE = np.zeros(256, np.bool_)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)

_RNG = np.random.Generator(np.random.PCG64(20240611))
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
PAIR = np.uint64(0xD6E8FEB86659FD93)
#: The first so many bytes of a word that eight are read of.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG_WORD = 64

_powers: dict[int, np.ndarray] = {}
_KEPT_POWERS = 1 << 19


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, for gram hashes. Short runs of them are kept; long ones, for a very long text, are made anew."""
    key = int(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        have = np.empty(max(n, _KEPT_POWERS), np.uint64)
        have[0] = 1
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        if n <= _KEPT_POWERS:
            _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if column.type != pa.large_binary():
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()).cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, off, data = column.buffers()
    if off is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int):
    """Row ranges whose bytes stay within most, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words of some texts: start and end (bytes) and first (index of each text's first word, with a last entry)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, space: np.ndarray = SPACE):
        n = len(data)
        self.data = table[data] if table is not SAME else data
        inside = np.zeros(n + 2, np.bool_)
        np.logical_not(space[data], out=inside[1:-1])
        edge = inside[1:] & ~inside[:-1]  # a word begins at byte i
        edge_end = inside[:-1] & ~inside[1:]  # and ended before byte i
        cuts = offsets[1:-1]
        if n and len(cuts):  # words never cross texts
            cuts = cuts[(cuts > 0) & (cuts < n)]
            joined = cuts[inside[cuts] & inside[cuts + 1]]
            edge[joined] = True
            edge_end[joined] = True
        self.start = np.flatnonzero(edge)
        self.end = np.flatnonzero(edge_end)
        self.first = np.searchsorted(self.start, offsets)
        self.first[-1] = len(self.start)

    def hashes(self, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
        """A hash of each word; other seeds give independent ones."""
        size = self.end - self.start
        if not len(size):
            return np.zeros(0, np.uint64)
        padded = np.zeros(len(self.data) + 8, np.uint8)
        padded[:-8] = self.data
        eight = np.ndarray((len(self.data) + 1,), "<u8", buffer=padded, strides=(1,))
        h = mix((size.astype(np.uint64) * np.uint64(seed | 1)) ^ (eight[self.start] & _MASK[np.minimum(size, 8)]))
        left = np.flatnonzero(size > 8)
        for at in range(8, _LONG_WORD, 8):
            if not len(left):
                return h
            more = eight[self.start[left] + at] & _MASK[np.minimum(size[left] - at, 8)]
            h[left] = mix(h[left] * BASE ^ more)
            left = left[size[left] > at + 8]
        key = seed.to_bytes(8, "little")
        for i in left.tolist():
            h[i] = int.from_bytes(blake2b(self.data[self.start[i] : self.end[i]].tobytes(), digest_size=8, key=key).digest(), "little")
        return h


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of width words, at its first word; len(words) - width + 1 of them. Runs of 2, 4, 8.. words are put together from two halves."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, used, size = None, 0, 1
    while True:
        if width & size:
            own = words[used : used + n]
            out = own if out is None else mix(out * PAIR + own)
            used += size
        if 2 * size > width:
            return out
        words = mix(words[:-size] * PAIR + words[size:])
        size *= 2


def digests(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of a 128-bit BLAKE2b digest of each stretch of values."""
    body, k = memoryview(np.ascontiguousarray(values)).cast("B"), values.itemsize
    both = np.frombuffer(b"".join([blake2b(body[a:z], digest_size=16).digest() for a, z in zip((start * k).tolist(), (end * k).tolist(), strict=True)]), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def inside_rows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, at) of all windows of width words that stay inside a row."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    return row, at


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of width values (van Herk and Gil-Werman): three passes at any width."""
    n = len(values)
    if n < width:
        return values[:0]
    pad = -n % width
    v = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]) if pad else values
    blocks = v.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])
