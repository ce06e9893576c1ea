"""Substring deduplication with suffix automata over shards of reference text.

``remove_repeated_passages`` drops every word covered by a run of ``window`` words that
also starts in a document with a smaller id.  The reference text of a shard is what the
anchors of :mod:`repeats` send there; its suffix automaton is built in ascending order of
document ids, and each document's stretches are streamed over it for matching statistics
(the longest suffix of what was read that occurs in an earlier document).  Maximal spans
with statistics of ``window`` or more go.

The shard is dealt to the task that holds the documents which can match it, instead of
being broadcast to all tasks: all shards together grow with the corpus and have no bound.

Cases: null text counts as empty (nothing removed); documents with a null id are left as
they are and are no reference; rows that repeat an id are judged one by one (one id never
matches itself); fewer words than the window: unchanged; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import chunks, words
from .common import NULL_ID, row_keyed
from .repeats import LIMIT, Shard, Spec, repeated_spans, spans_of


class SuffixAutomaton:
    """All substrings of the sequences added so far; symbols are any hashables."""

    __slots__ = ("next", "link", "length")

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _clone(self, p: int, q: int, symbol) -> int:
        nxt, link, length = self.next, self.link, self.length
        r = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = r
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = r
            p = link[p]
        return r

    def add(self, sequence) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            q = nxt[last].get(symbol)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, symbol)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and symbol not in nxt[p]:
                nxt[p][symbol] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][symbol]
                link[cur] = q if length[p] + 1 == length[q] else self._clone(p, q, symbol)
            last = cur

    def statistics(self, sequence) -> list[int]:
        """For each position, the length of the longest match that ends there."""
        nxt, link, length = self.next, self.link, self.length
        state = n = 0
        out = []
        for symbol in sequence:
            to = nxt[state].get(symbol)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(symbol)
            if to is not None:
                state, n = to, n + 1
            out.append(n)
        return out


def _by_automaton(s: Shard, spec: Spec, queries, references):
    """Stretches that windows of smaller documents cover, in order of document ids."""
    ids: dict[bytes, int] = {}
    symbols = [ids.setdefault(w, len(ids)) for t in s.text for w in t.split()]
    events = sorted(
        [(s.rid[r], 0, r, a, b) for r, a, b in zip(*queries, strict=True)]
        + [(s.rid[r], 1, r, a, b) for r, a, b in zip(*references, strict=True)]
    )
    automaton, w = SuffixAutomaton(), spec.window
    seen: set[tuple] = set()
    known: dict[tuple, list[int]] = {}
    out: list[tuple[int, int, int]] = []
    for _, is_reference, r, a, b in events:
        stretch = tuple(symbols[a:b])
        if is_reference:
            if stretch not in seen:
                seen.add(stretch)
                automaton.add(stretch)
                known.clear()
            continue
        stats = known.get(stretch)
        if stats is None:
            stats = known[stretch] = automaton.statistics(stretch)
        out += [(r, a + i + 1 - w, a + i + 1) for i, n in enumerate(stats) if n >= w]
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in chunks(batches):
        w = words(c)
        spans = c.batch.column("spans")
        n, gone, texts, digest = [], [], [], []
        for i in range(c.rows):
            a, b = int(w.first[i]), int(w.first[i + 1])
            lo, hi = spans_of(spans[i], b - a)
            keep = np.ones(b - a, bool)
            for x, y in zip(lo, hi, strict=True):
                keep[x:y] = False
            k = np.flatnonzero(keep)
            row = c.text(i).split()
            text = b" ".join(row if len(k) == b - a else [row[j] for j in k])
            n.append(b - a)
            gone.append(b - a - len(k))
            texts.append(text)
            digest.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [c.batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digest)],
            names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )


def remove_repeated_passages(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 50, limit: int = LIMIT) -> DataFrame:
    """-> doc_id, n_words, n_removed, kept (the words that stay, joined by a space), kept_sha256."""
    docs = row_keyed(documents, id_col, text_col)
    spec = Spec("word", window, max(window // 2, 1), "smaller", limit)
    spans = repeated_spans(docs.filter(F.col("rid") != NULL_ID), spec, _by_automaton)
    return docs.join(spans, ["rid", "rth"], "left").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
