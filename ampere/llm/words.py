"""Vectorised word hashes over Arrow text columns.

Words are maximal runs of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return. All separators are ASCII, so working on
UTF-8 bytes splits exactly as the pattern ``[^\\x20\\x09-\\x0D]+`` splits text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True
SLICE_BYTES = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_POW: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    have = _POW.get(int(base))
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        x[0] = 1
        have = _POW[int(base)] = np.multiply.accumulate(x)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (splitmix64's last steps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without copying the text; null
    texts have no bytes."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=kind, count=len(column) + 1 + column.offset)[column.offset :]
    offsets = offsets.astype(np.int64)
    if column.buffers()[2] is None:
        return np.empty(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``most`` bytes each (one row at
    least), which bounds the working memory of what is done to a range."""
    n = len(column)
    if not n:
        return
    _, offsets = text_buffers(column)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, min(to, n)
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words; no word crosses a text's end."""
    if not len(data):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    word = ~_IS_SEP[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, by differences
    of prefix sums modulo 2**64, and then mixed. The bytes are taken in
    pieces, so a very long text needs no more memory than a short one."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE_BYTES, side="right")))
        base = int(starts[at])
        chunk = data[base : int(ends[to - 1])]
        sums = np.zeros(len(chunk) + 1, dtype=np.uint64)
        np.cumsum((chunk.astype(np.uint64) + np.uint64(1)) * powers(_P, len(chunk)), out=sums[1:])
        s = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[s]) * powers(_P_INV, len(chunk) + 1)[s]
        at = to
    return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)``: the word hashes of all texts of a column, and
    where each text's begin."""
    data, offsets = text_buffers(column)
    starts, ends = word_spans(data, offsets)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


_Q = np.uint64(0xD6E8FEB86659FD93)
_Q_INV = np.uint64(pow(int(_Q), -1, 1 << 64))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive entries (also across
    texts; the caller drops those)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    step = 1 << 18
    for at in range(0, n, step):
        part = hashes[at : at + step + width - 1]
        m = len(part) - width + 1
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers(_Q, len(part)), out=sums[1:])
        out[at : at + m] = (sums[width:] - sums[:-width]) * powers(_Q_INV, m)
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries."""
    have, y = 1, x
    while have * 2 <= width:
        y = np.minimum(y[:-have], y[have:]) if len(y) > have else y[:0]
        have *= 2
    rest = width - have
    if rest:
        y = np.minimum(y[:-rest], y[rest:]) if len(y) > rest else y[:0]
    return y
