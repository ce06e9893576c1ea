"""Vectorised work on the UTF-8 bytes of Arrow string columns.

A ``Chunk`` is a run of rows whose texts lie one after another in one byte array, at most
``CHUNK_BYTES`` long unless a single text is longer.  Words and lines are found for all
rows of a chunk at once; hashes of any stretch come from one prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
CHUNK_ROWS = 4096
U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = 0x0A


@dataclass
class Chunk:
    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def string_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets from 0 (nulls are empty) and validity of a string or binary array."""
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n, kind = len(arr), np.int64 if wide else np.int32
    valid = np.ones(n, bool) if not arr.null_count else np.asarray(arr.is_valid())
    _, off, data = arr.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), valid
    offsets = np.frombuffer(off, kind)[arr.offset : arr.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if not valid.all() and (np.diff(offsets)[~valid] > 0).any():
        return string_parts(arr.fill_null(b"" if pa.types.is_binary(arr.type) else ""))[:2] + (valid,)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0], valid


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets, valid = string_parts(batch.column(batch.schema.get_field_index(text)))
        at, n = 0, batch.num_rows
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), at + CHUNK_ROWS, n)
            yield Chunk(batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], valid[at:end])
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (a finaliser of shifts and odd multipliers)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0x9FB21C651E98DF25)
    return x ^ (x >> U(32))


@lru_cache(4)
def _symbols(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(_BASES[seed % 2]) + U(seed + 1))


_POWERS: dict[int, tuple[np.ndarray, ...]] = {}
#: A Mersenne prime; the second half of a hash is a polynomial modulo it.
PRIME = (1 << 31) - 1
_PRIME_BASES = (1_270_391_803, 1_891_655_929)


def _fold(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME up to one PRIME: below 2**32 for any 62 bits."""
    return (x & U(PRIME)) + (x >> U(31))


def _modulo(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def _powers(n: int, seed: int) -> tuple[np.ndarray, ...]:
    """Powers of the base and of its inverse modulo 2**64, then both modulo PRIME."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        base = _BASES[seed % 2]
        size = max(n + n // 8, 1 << 17)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U))
        for b in (_PRIME_BASES[seed % 2], pow(_PRIME_BASES[seed % 2], -1, PRIME)):
            p = np.ones(size, U)
            done = 1
            while done < size:  # each turn doubles what is known
                more = min(done, size - done)
                p[done : done + more] = _modulo(p[:more] * U(pow(b, done, PRIME)))
                done += more
            out.append(p)
        have = _POWERS[seed] = tuple(out)
    return tuple(p[:n] for p in have)


class Prefix:
    """Hashes of any stretches [a, b) of a sequence, from prefix sums.

    Two polynomials of unlike structure go into each hash: one modulo 2**64, which is fast
    but takes some sequences (of Thue-Morse shape) for equal whatever its base, and one
    modulo a prime, which does not."""

    def __init__(self, values: np.ndarray, seed: int = 0, byte_values: bool = True):
        v = _symbols(seed)[values] if byte_values else values
        p, self.inverse, q, self.inverse_prime = _powers(len(v) + 1, seed)
        self.sums = np.zeros(len(v) + 1, U)
        np.cumsum(v * p[:-1], out=self.sums[1:])
        small = (_symbols(seed) >> U(33))[values] if byte_values else mix(values) >> U(33)
        # below 2**32 each, so that sums of 2**31 of them fit
        self.prime_sums = np.zeros(len(v) + 1, U)
        np.cumsum(_fold(small * q[:-1]), out=self.prime_sums[1:])

    def _joined(self, wide: np.ndarray, prime: np.ndarray) -> np.ndarray:
        return mix(wide ^ (prime * U(0x9E3779B97F4A7C15)))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        prime = _modulo(_modulo(self.prime_sums[b] - self.prime_sums[a]) * self.inverse_prime[a])
        return self._joined((self.sums[b] - self.sums[a]) * self.inverse[a], prime)

    def sliding(self, k: int) -> np.ndarray:
        """Hash of each stretch of k."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U)
        prime = _modulo(_modulo(self.prime_sums[k:] - self.prime_sums[:n]) * self.inverse_prime[:n])
        return self._joined((self.sums[k:] - self.sums[:n]) * self.inverse[:n], prime)


@dataclass
class Words:
    """start, end: bytes; first: index of each row's first word (one longer than rows)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(c: Chunk) -> Words:
    """Maximal runs of bytes that are not white space, within rows."""
    n = len(c.data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~SPACE[c.data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    rows = c.offsets[:-1]
    at = rows[rows < n]
    begin[at] = inside[at]
    start = np.flatnonzero(begin[:n])
    stop = inside[:n] & (~inside[1:] | begin[1:])
    cut = c.offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)] - 1
    stop[cut] = inside[cut]
    end = np.flatnonzero(stop) + 1
    return Words(start, end, np.searchsorted(start, c.offsets))


def sliding_extreme(v: np.ndarray, w: int, low: bool) -> np.ndarray:
    """Least (or greatest) value of each full window of w, by block prefixes and suffixes."""
    n = len(v) - w + 1
    if n <= 0:
        return v[:0]
    f = np.minimum if low else np.maximum
    pad = -len(v) % w
    a = np.concatenate([v, np.full(pad, v[-1], v.dtype)]) if pad else v
    a = a.reshape(-1, w)
    pre = f.accumulate(a, axis=1).ravel()
    suf = f.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(suf[:n], pre[w - 1 : w - 1 + n])


def anchors(grams: np.ndarray, ends: np.ndarray, w: int, k: int) -> np.ndarray:
    """Positions that hold the least k-gram of some window of w inside its row.

    grams: hash of the k-gram at each position; ends: end of the row of each position.
    Equal windows choose equal places, so that every repeated window has an anchor in each
    of its occurrences.
    """
    n, span = len(ends), w - k + 1
    if n < w:
        return np.zeros(0, np.int64)
    key = (grams >> U(32)).astype(np.uint32) | np.uint32(1)  # 0 stands for no window
    least = sliding_extreme(key, span, True)[: n - w + 1]
    least[np.arange(n - w + 1) + w > ends[: n - w + 1]] = 0
    padded = np.zeros(len(least) + 2 * (span - 1), np.uint32)
    padded[span - 1 : span - 1 + len(least)] = least
    top = sliding_extreme(padded, span, False)
    m = min(len(top), len(key))
    return np.flatnonzero((top[:m] == key[:m]) & (top[:m] > 0))


def row_of(c_offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(c_offsets) - 1), np.diff(c_offsets))


def union_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [lo, hi); touching ones join."""
    if not len(lo):
        return lo, hi
    o = np.argsort(lo, kind="stable")
    lo, hi = lo[o], np.maximum.accumulate(hi[o])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)
    return lo[new], hi[last]
