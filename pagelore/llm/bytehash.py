"""Vectorised words and word shingles over the bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so UTF-8 needs no
decoding. Hashes are 64-bit polynomials of random byte values modulo 2**64,
taken by prefix sums, then mixed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=U) * U(2) + U(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_P = 0x9E3779B97F4A7C15
_IP = pow(_P, -1, 1 << 64)
_SEP = np.zeros(256, bool)
_SEP[[32, *range(9, 14)]] = True
_M = _rng.integers(0, 1 << 63, 64, dtype=U) * U(2) + U(1)
#: Bytes hashed at once; a longer word makes its piece longer.
PIECE = 1 << 19
_pows: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _pows.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 64), base, U)
        steps[0] = 1
        have = _pows[base] = np.cumprod(steps, dtype=U)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    col = pc.fill_null(col, "") if col.null_count else col
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text, one row at least, so that memory doesn't follow the batch size."""
    _, at = utf8(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def words(data: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, bounds): words of all rows; row r has those in bounds[r]:bounds[r + 1]."""
    lo, hi = int(at[0]), int(at[-1])
    own = data[lo:hi]
    inside = ~_SEP[own]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U), np.zeros(len(at), np.int64)
    first = np.empty(len(own) + 1, bool)
    first[0], first[-1] = True, True
    first[1:-1] = ~inside[:-1]
    rows = at - lo
    first[rows] = True
    starts = np.flatnonzero(inside & first[:-1])
    last = first[1:].copy()
    last[:-1] |= ~inside[1:]
    ends = np.flatnonzero(inside & last) + 1
    hashes = np.empty(len(starts), U)
    table, i = (_LOWER if lower else _BYTE), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(b - a + 1, U)
        np.cumsum(table[own[a:b]] * _powers(_P, b - a), out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        hashes[i:j] = mix((sums[e] - sums[s]) * _powers(_IP, b - a + 1)[s] + (e - s).astype(U))
        i = j
    return starts + lo, ends + lo, hashes, np.searchsorted(starts, rows)


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles of each row; all words as one where there are fewer; empty without words."""
    n = len(hashes) - k + 1
    rolled = np.zeros(max(n, 0), U)
    for j in range(k):
        if n > 0:
            rolled += hashes[j : j + n] * _M[j]
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            own = np.sort(rolled[a : b - k + 1])
            yield own if len(own) == 1 else own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            yield mix((hashes[a:b] * _M[k + 1 : k + 1 + b - a]).sum(keepdims=True, dtype=U) + U(b - a))
        else:
            yield np.zeros(0, U)


def row_shingles(col: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    data, at = utf8(col)
    _, _, hashes, bounds = words(data, at)
    return shingles(hashes, bounds, k)


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    both = (mix(own + U(1)).sum(dtype=U), mix(own ^ U(0x5BD1E9955BD1E995)).sum(dtype=U))
    return tuple(int(x.view(np.int64)) for x in both)
