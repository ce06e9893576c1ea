"""Byte n-grams: counting, and models of conditional probabilities in sorted hash arrays.

An n-gram is the last n bytes packed into 64 bits, the newest lowest; before the start of
a text stand zero bytes.  A model holds, for each order, the log probabilities of the
n-grams that it knows and the log weight with which each context hands over to the order
below.  Both prediction by partial matching (with exclusion) and modified Kneser-Ney have
this form, so one lookup serves both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .bytetext import CHUNK_BYTES, U, Chunk, chunks, mix
from .common import lean_worker

HELD = 1 << 20


def keys(c: Chunk, order: int) -> np.ndarray:
    """The n-gram that ends at each byte of a chunk."""
    n, rows, k = len(c.data), c.rows, order - 1
    at = np.arange(n) + k * (np.repeat(np.arange(rows), np.diff(c.offsets)) + 1)
    padded = np.zeros(n + k * rows, U)
    padded[at] = c.data
    out = padded.copy()
    for i in range(1, order):
        out[i:] |= padded[:-i] << U(8 * i)
    return out[at]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    u, back = np.unique(k, return_inverse=True)
    return u, np.bincount(back, weights=n).astype(np.int64)


def counter(order: int, group: str = "lang"):
    """mapInArrow function: (group, text) -> (group, gram, n), added up within a task as
    far as memory allows."""

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for g, parts in held.items():
            k, n = merged(parts)
            for i in range(0, len(k), 1 << 16):
                m = len(k[i : i + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array([g] * m, pa.string()), pa.array(k[i : i + m].view(np.int64)), pa.array(n[i : i + m])], names=[group, "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lean_worker():
            yield from counted(batches)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for c in chunks(batches, most=CHUNK_BYTES // 2):
            k = keys(c, order)
            names = c.batch.column(group).to_numpy(zero_copy_only=False)
            of = np.repeat(np.unique(names, return_inverse=True)[1], np.diff(c.offsets))
            for j, g in enumerate(np.unique(names)):
                u, n = np.unique(k[of == j], return_counts=True)
                held.setdefault(g, []).append((u, n))
                size += len(u)
            if size > HELD:
                held = {g: [merged(p)] for g, p in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD // 2:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    return run


class SortedHash:
    """Keys by hash in ascending order, with the first place of each leading bit pattern."""

    def __init__(self, k: np.ndarray):
        self.bits = max(int(np.ceil(np.log2(max(len(k), 1)))) + 1, 1)
        h = mix(k.astype(U, copy=False))
        order = np.argsort(h, kind="stable")
        self.order: np.ndarray | None = order.astype(np.int32)
        self.hashes = np.append(h[order], ~U(0))
        del h, order
        sizes = np.bincount((self.hashes[:-1] >> U(64 - self.bits)).view(np.int64), minlength=1 << self.bits)
        self.most = int(sizes.max()) if len(k) else 0
        self.begin = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=self.begin[1:])

    def arranged(self, values: np.ndarray) -> np.ndarray:
        """Values of the keys in ascending order of hashes.  To be called once: the order is
        then let go, so that it is not broadcast."""
        out, self.order = values[self.order], None
        return out

    def find(self, k: np.ndarray) -> np.ndarray:
        """Place of each key in ascending order of hashes, -1 if it is not there."""
        h = mix(k)
        at = self.begin[h >> U(64 - self.bits)].astype(np.int64)
        last = len(self.hashes) - 1
        out = np.where(self.hashes[np.minimum(at, last)] == h, at, -1)
        todo = np.flatnonzero(out < 0)
        for _ in range(1, self.most):
            at[todo] += 1
            todo = todo[at[todo] < last]
            hit = self.hashes[at[todo]] == h[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            todo = todo[self.hashes[at[todo]] < h[todo]]
            if not len(todo):
                break
        return out


def mask(order: int) -> np.uint64:
    return U((1 << (8 * order)) - 1)


@dataclass
class Order:
    grams: np.ndarray  # sorted
    logp: np.ndarray
    contexts: np.ndarray  # sorted
    hand_over: np.ndarray


def _place(sorted_keys: np.ndarray, k: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(k), -1)
    i = np.minimum(np.searchsorted(sorted_keys, k), len(sorted_keys) - 1)
    return np.where(sorted_keys[i] == k, i, -1)


class Model:
    """orders[o - 1]: grams of o bytes.  floor: log probability below all orders."""

    def __init__(self, orders: list[Order], floor: float):
        self.orders, self.floor = orders, floor

    def logp(self, k: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each n-gram given the bytes before it."""
        out = np.zeros(len(k))
        todo = np.arange(len(k))
        for o in range(len(self.orders), 0, -1):
            t = self.orders[o - 1]
            g = k[todo] & mask(o)
            at = _place(t.grams, g)
            hit = at >= 0
            out[todo[hit]] += t.logp[at[hit]]
            todo, g = todo[~hit], g[~hit]
            if not len(todo):
                return out
            ctx = _place(t.contexts, g >> U(8))
            out[todo] += np.where(ctx >= 0, t.hand_over[np.maximum(ctx, 0)] if len(t.contexts) else 0.0, 0.0)
        out[todo] += self.floor
        return out


def _below(grams: np.ndarray, counts: np.ndarray, order: int, types: bool) -> tuple[np.ndarray, np.ndarray]:
    """Grams one byte shorter at the old end; counts are added up, or types are counted."""
    u, back = np.unique(grams & mask(order - 1), return_inverse=True)
    return u, np.bincount(back, weights=None if types else counts).astype(np.int64)


def _contexts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, back = np.unique(grams >> U(8), return_inverse=True)
    return u, back


def partial_matching(grams: np.ndarray, counts: np.ndarray, order: int) -> Model:
    """Frozen statistics of prediction by partial matching: a context of total T with d
    distinct bytes gives n / (T + d) to a byte seen n times and d / (T + d) to escape;
    below, the bytes that it has seen are excluded."""
    tables: list[Order] = []
    levels = [(grams, counts)]
    for o in range(order, 1, -1):
        levels.append(_below(*levels[-1], o, types=False))
    below = None
    for o, (g, n) in enumerate(reversed(levels), 1):
        ctx, of = _contexts(g)
        total = np.bincount(of, weights=n)
        kinds = np.bincount(of)
        p = n / (total + kinds)[of]
        if below is None:
            excluded = kinds / 256.0
        else:
            excluded = np.bincount(of, weights=np.exp(below.logp[_place(below.grams, g & mask(o - 1))]))
        with np.errstate(divide="ignore"):
            hand = np.log(kinds / (total + kinds)) - np.log(np.maximum(1 - excluded, 1e-12))
        below = Order(g, np.log(p), ctx, hand)
        tables.append(below)
    return Model(tables, -np.log(256.0))


def kinds_of(n: np.ndarray) -> np.ndarray:
    """How many n-grams were seen once, twice, three and four times."""
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5].astype(float)


def kneser_ney(grams: np.ndarray, counts: np.ndarray, order: int, *, low: Model | None = None, kinds: list[np.ndarray] | None = None) -> Model:
    """Interpolated modified Kneser-Ney with three discounts for each order.

    With ``low`` (the orders below) and ``kinds`` (of all n-grams, for each order), the
    n-grams may be a part of all, as long as those that end in the same context of
    ``len(low.orders)`` bytes are together."""
    tables = list(low.orders) if low else []
    levels = [(grams, counts)]
    for o in range(order, len(tables) + 1, -1):
        levels.append(_below(*levels[-1], o, types=True))
    below = tables[-1] if tables else None
    for o, (g, n) in enumerate(reversed(levels), len(tables) + 1):
        n1, n2, n3, n4 = np.maximum(kinds_of(n) if kinds is None else kinds[o - 1], 0.5)
        y = n1 / (n1 + 2 * n2)
        d = np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 0.95, 1.9, 2.85])
        taken = d[np.minimum(n, 3)]
        ctx, of = _contexts(g)
        total = np.bincount(of, weights=n)
        hand = np.bincount(of, weights=taken) / total
        lower = np.full(len(g), 1 / 256.0) if below is None else np.exp(below.logp[_place(below.grams, g & mask(o - 1))])
        p = (n - taken) / total[of] + hand[of] * lower
        below = Order(g, np.log(p), ctx, np.log(hand))
        tables.append(below)
    return Model(tables, -np.log(256.0))


def by_group(table: pa.Table, group: str = "lang") -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(group, grams in ascending order, counts) of a counted table, groups in order."""
    names = np.asarray(table.column(group).combine_chunks().dictionary_encode().dictionary)
    code = table.column(group).combine_chunks().dictionary_encode().indices.to_numpy()
    grams, n = table.column("gram").to_numpy().view(U), table.column("n").to_numpy()
    for i in np.argsort(names.astype(str)):
        at = np.flatnonzero(code == i)
        at = at[np.argsort(grams[at])]
        yield str(names[i]), grams[at], n[at]


class Scorer:
    """Log probabilities under several models at once: the known n-grams of all models sit
    in one sorted hash array with a column for each model; others are worked out."""

    def __init__(self, models: list[Model], order: int):
        self.models, self.order = models, order
        known = np.unique(np.concatenate([m.orders[order - 1].grams for m in models])) if models else np.zeros(0, U)
        self.table = SortedHash(known)
        self.values = self.table.arranged(np.stack([m.logp(known) for m in models], 1).astype(np.float32)) if models else np.zeros((0, 0), np.float32)

    def __call__(self, k: np.ndarray) -> np.ndarray:
        """(len(k), models)."""
        at = self.table.find(k)
        miss = np.flatnonzero(at < 0)
        out = self.values[at]
        for j, m in enumerate(self.models):
            out[miss, j] = m.logp(k[miss])
        return out


class OwnScorer:
    """Log probabilities of each n-gram under one chosen model: the n-grams of all models
    sit in one sorted hash array, each marked with its model; of the models themselves only
    what an n-gram needs that is not there is kept."""

    def __init__(self, models: list[Model], order: int):
        self.order = order
        tops = [m.orders[order - 1] for m in models]
        known = np.concatenate([self._marked(t.grams, np.full(len(t.grams), j)) for j, t in enumerate(tops)]) if models else np.zeros(0, U)
        self.table = SortedHash(known)
        del known
        self.values = self.table.arranged(np.concatenate([t.logp.astype(np.float32) for t in tops]) if models else np.zeros(1, np.float32))
        self.models = [Model([*m.orders[: order - 1], Order(t.grams[:0].copy(), t.logp[:0].copy(), t.contexts, t.hand_over)], m.floor) for m, t in zip(models, tops, strict=True)]

    def _marked(self, k: np.ndarray, model: np.ndarray) -> np.ndarray:
        return k + (model.astype(U) << U(8 * self.order))

    def __call__(self, k: np.ndarray, model: np.ndarray) -> np.ndarray:
        at = self.table.find(self._marked(k, model))
        out = self.values[at]
        miss = np.flatnonzero(at < 0)
        for j in np.unique(model[miss]):
            i = miss[model[miss] == j]
            out[i] = self.models[j].logp(k[i])
        return out
