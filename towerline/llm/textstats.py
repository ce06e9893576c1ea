"""Structure statistics of every text of a chunk, vectorised over its bytes."""

from __future__ import annotations

import numpy as np

from .bytetext import NEWLINE, SPACE, U, Chunk, Prefix, Words, mix, row_of, words

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
PUNCT = np.zeros(256, bool)
PUNCT[list(b"!?.,;:")] = True


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats_in_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each item, how many items of its row are equal to it."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    key = mix(hashes + row.astype(U) * U(0x9E3779B97F4A7C15))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[back]


def duplicate_lines(c: Chunk) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their text."""
    n = len(c.data)
    breaks = np.flatnonzero(c.data == NEWLINE)
    start = np.union1d(breaks + 1, c.offsets[:-1])
    start = start[start < n]
    if not len(start):
        return np.zeros(c.rows, np.int64)
    row = np.searchsorted(c.offsets, start, side="right") - 1
    end = np.append(start[1:], n)
    closed = np.zeros(len(start), bool)
    closed[:-1] = c.data[end[:-1] - 1] == NEWLINE
    closed[-1] = c.data[n - 1] == NEWLINE
    end = end - closed
    solid = np.zeros(n + 1, np.int64)
    np.cumsum(~SPACE[c.data], out=solid[1:])
    real = solid[end] > solid[start]
    start, end, row = start[real], end[real], row[real]
    key = mix(Prefix(c.data).of(start, end) + row.astype(U) * U(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    return np.bincount(row, minlength=c.rows) - np.bincount(row[first], minlength=c.rows)


def repeated_words(c: Chunk, w: Words, width: int = 8) -> np.ndarray:
    """Words inside windows of ``width`` words that occur twice or more in their text."""
    hashes = Prefix(Prefix(c.data).of(w.start, w.end), 0, False).sliding(width)
    row = row_of(w.first)[: len(hashes)]
    ok = np.arange(len(hashes)) + width <= w.first[1:][row]
    at = np.flatnonzero(ok)
    again = at[repeats_in_row(hashes[at], row[at]) > 1]
    cover = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + width, -1)
    return per_row(np.cumsum(cover[:-1]) > 0, w.first)


def base_counts(c: Chunk, w: Words | None = None) -> dict[str, np.ndarray]:
    w = w or words(c)
    return {
        "n_words": w.counts(),
        "word_chars": per_row(~SPACE[c.data] & ((c.data & 0xC0) != 0x80), c.offsets),
        "n_symbols": per_row(SYMBOL[c.data], c.offsets),
        "n_dup_lines": duplicate_lines(c),
        "n_repeat_words": repeated_words(c, w),
    }
