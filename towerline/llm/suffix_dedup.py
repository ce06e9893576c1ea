"""Exact byte-level deduplication with longest-previous-factor arrays.

Within a shard (see :mod:`repeats`) the suffixes of the reference texts are sorted by rank
doubling, from the first few symbols packed into a number.  For each position, the nearest
smaller positions before and after it in suffix order give the longest factor that also
starts earlier; its two neighbours, the longest that also starts anywhere else.
``keep='first'`` removes what an earlier copy covers; ``keep='none'`` also removes that
first copy.

Cases: null text is empty; rows that repeat an id are separate texts; texts shorter than
``window`` stay; extra columns are ignored; what is left may split a code point, so it is
returned as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytetext import chunks
from .common import row_keyed
from .repeats import LIMIT, Shard, Spec, repeated_spans, spans_of


class Suffixes:
    """Suffixes of an integer sequence in order of their first ``depth`` symbols, ties by
    position."""

    def __init__(self, symbols: np.ndarray, depth: int):
        n, key = len(symbols), symbols.astype(np.int64) + 1
        bits = int(key.max(initial=1)).bit_length()
        self.levels, length = [], 1
        while length < depth and 2 * length * bits <= 62:  # so many symbols fit into a number
            self.levels.append(key)
            nxt = np.zeros(n, np.int64)
            nxt[: max(n - length, 0)] = key[length:]
            key = key << length * bits | nxt
            length *= 2
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        self.levels.append(rank)
        while length < depth:
            nxt = np.full(n, -1, np.int64)
            nxt[: n - length] = rank[length:] if length < n else nxt[: n - length]
            rank = np.unique(rank * (n + 1) + nxt + 1, return_inverse=True)[1].astype(np.int64)
            self.levels.append(rank)
            length *= 2
        self.order = np.argsort(rank, kind="stable")

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at i and j (-1: none)."""
        n = len(self.order)
        ok = (i >= 0) & (j >= 0)
        i, j = np.where(ok, i, n).copy(), np.where(ok, j, n).copy()
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            inside = (i < n) & (j < n)
            same = np.zeros(len(i), bool)
            same[inside] = self.levels[k][i[inside]] == self.levels[k][j[inside]]
            step = same * (1 << k)
            out += step
            i, j = i + step, j + step
        return out

    def nearest(self, smaller: bool, before: bool) -> np.ndarray:
        """For each place in suffix order, the position of the nearest suffix before or
        after it that starts at a smaller (greater) position; -1: none."""
        p = self.order if before else self.order[::-1]
        v = p if smaller else -p
        at = np.arange(len(p)) - 1
        todo = np.flatnonzero(at >= 0)
        todo = todo[v[at[todo]] > v[todo]]
        while len(todo):
            at[todo] = at[at[todo]]
            todo = todo[at[todo] >= 0]
            todo = todo[v[at[todo]] > v[todo]]
        out = np.where(at >= 0, p[np.maximum(at, 0)], -1)
        return out if before else out[::-1]

    def factor(self, earlier: bool) -> np.ndarray:
        """For each position, the longest factor that also starts earlier (or later)."""
        found = [self.common(self.order, self.nearest(earlier, before)) for before in (True, False)]
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.maximum(*found)
        return out

    def repeated(self) -> np.ndarray:
        """For each position, the longest factor that also starts anywhere else: one shared
        with a neighbour in suffix order."""
        shared = self.common(self.order[:-1], self.order[1:])
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.maximum(np.append(0, shared), np.append(shared, 0))
        return out


def _by_factors(s: Shard, spec: Spec, queries, references):
    """Places of the query stretches whose longest factors reach the window."""
    rows, lo, hi = (np.concatenate(x) for x in zip(queries, references, strict=True))
    n_query = len(queries[0])
    o = np.lexsort((lo, s.rth[rows], s.rid[rows]))
    seen: dict[tuple, int] = {}
    copies: dict[bytes, list[int]] = {}
    pieces, where, size = [], {}, 0
    for k in o:
        place = (int(rows[k]), int(lo[k]), int(hi[k]))
        if place not in seen:
            piece = s.sym[lo[k] : hi[k]]
            held = copies.setdefault(piece.tobytes(), [])
            if len(held) < 2:  # the second copy stands for all later ones
                held.append(size)
                pieces += [piece.astype(np.int64), np.array([256 + len(pieces)])]
                size += len(piece) + 1
            seen[place] = held[-1]
        where[int(k)] = seen[place]
    suffixes = Suffixes(np.concatenate(pieces), spec.window)
    goes = (suffixes.repeated() if spec.mode == "all" else suffixes.factor(True)) >= spec.window
    out = []
    for k in range(n_query):
        at = np.flatnonzero(goes[where[k] : where[k] + hi[k] - lo[k]])
        if len(at):
            cut = np.flatnonzero(np.diff(at) > 1)
            head, tail = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
            out.append(np.stack([np.full(len(head), rows[k]), lo[k] + head, lo[k] + tail + spec.window], 1))
    found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return found[:, 0], found[:, 1], found[:, 2]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        spans = c.batch.column("spans")
        n, gone, runs, left, digest = [], [], [], [], []
        for i in range(c.rows):
            text = c.text(i)
            lo, hi = spans_of(spans[i], len(text))
            kept = b"".join(text[a:b] for a, b in zip([0, *hi], [*lo, len(text)], strict=True))
            n.append(len(text))
            gone.append(len(text) - len(kept))
            runs.append(len(lo))
            left.append(kept)
            digest.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [c.batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(left, pa.binary()), pa.array(digest)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def remove_repeated_bytes(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 200, keep: str = "first", limit: int = LIMIT) -> DataFrame:
    """-> doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256.

    keep: 'first' leaves the earliest copy (by id, then place), 'none' leaves no copy.
    """
    docs = row_keyed(documents, id_col, text_col)
    spec = Spec("byte", window, max(window * 8 // 25, 1), {"first": "first", "none": "all"}[keep], limit)
    spans = repeated_spans(docs, spec, _by_factors)
    return docs.join(spans, ["rid", "rth"], "left").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
