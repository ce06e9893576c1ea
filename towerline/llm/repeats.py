"""Repeated stretches across a corpus, found without comparing documents pairwise.

Shared by the byte and the word deduplication.  A *window* is ``window`` consecutive
symbols (bytes or words) of one document.

1. Every window chooses an *anchor*: the least k-gram inside it.  Equal windows choose the
   same one, so two windows can only be equal if their anchors are.
2. Occurrences are dealt by anchor.  Those with the same surroundings (the stretch that
   all windows of the anchor can reach) form a class; nothing more is needed to know that
   the members of a class repeat each other.
3. Where an anchor has several classes, one text of each class is fetched and an exact
   index (suffix automaton or suffix array, given by the caller) decides which windows
   repeat.  Such texts are dealt by anchor too, so an index covers a bounded shard.
4. An anchor with more classes than ``limit`` would make that shard unbounded.  Its
   windows are grouped by 128 bits of hash instead, all of them, spread over the cluster.

Anchors that hold more than a small part of all places in a hashed sample of documents are
salted, the more the larger they are; this steers the spread only: members that a salt
separates are compared in step 3.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import CHUNK_BYTES, U, Chunk, Prefix, anchors, chunks, mix, row_of, string_parts, union_spans, words
from .common import durable, hash_unit

ROWS_OUT = 1 << 16
FLUSH_BYTES = 1 << 20
#: An anchor is salted if it holds more than this part of the places of the sample (so at
#: most so many anchors are broadcast), and ``SAMPLED`` times at least.
SHARE = 1 / 50_000
SAMPLED = 100

ANCHOR = "h long, c long, rid long, rth long, pos int"
FOUND = "kind int, h long, rid long, rth long, lo int, hi int, n int"
CONTEXT = "h long, rid long, rth long, lo int, n int, ctx binary"
SPAN = "rid long, rth long, lo int, hi int"


#: Most classes of an anchor that one shard takes.
LIMIT = 20_000


@dataclass(frozen=True)
class Spec:
    """mode: 'all' (a window that occurs anywhere else goes), 'first' (one that occurs
    earlier goes), 'smaller' (one that occurs in a document with a smaller id goes)."""

    unit: str
    window: int
    gram: int
    mode: str
    limit: int = LIMIT

    @property
    def reach(self) -> int:
        return self.window - self.gram


def _batch(schema: list[tuple[str, pa.DataType]], cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(cols, schema, strict=True)], names=[n for n, _ in schema])


_L, _I = pa.int64(), pa.int32()
_ANCHOR = [("h", _L), ("c", _L), ("rid", _L), ("rth", _L), ("pos", _I)]
_FOUND = [("kind", _I), ("h", _L), ("rid", _L), ("rth", _L), ("lo", _I), ("hi", _I), ("n", _I)]
_CONTEXT = [("h", _L), ("rid", _L), ("rth", _L), ("lo", _I), ("n", _I), ("ctx", pa.binary())]
_SPAN = [("rid", _L), ("rth", _L), ("lo", _I), ("hi", _I)]


def _symbols(c: Chunk, unit: str, seed: int = 0) -> tuple[np.ndarray, bool, np.ndarray]:
    """Bytes, or a hash of each word: one of its own for each seed."""
    if unit == "byte":
        return c.data, True, c.offsets
    w = words(c)
    return Prefix(c.data, seed).of(w.start, w.end), False, w.first


def _find_anchors(spec: Spec) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            sym, is_bytes, off = _symbols(c, spec.unit)
            if len(sym) < spec.window:
                continue
            row = row_of(off)
            first, last = off[:-1], off[1:]
            grams = Prefix(sym, 0, is_bytes).sliding(spec.gram)
            at = anchors(grams, last[row], spec.window, spec.gram)
            if not len(at):
                continue
            r = row[at]
            lo, hi = np.maximum(at - spec.reach, first[r]), np.minimum(at + spec.window, last[r])
            around = Prefix(sym if is_bytes else _symbols(c, spec.unit, 1)[0], 1, is_bytes).of(lo, hi)
            around = mix(around + (at - lo).astype(U))
            rid, rth = (c.batch.column(k).to_numpy(zero_copy_only=False)[r] for k in ("rid", "rth"))
            cols = [grams[at].view(np.int64), around.view(np.int64), rid, rth, (at - first[r]).astype(np.int32)]
            for i in range(0, len(at), ROWS_OUT):
                yield _batch(_ANCHOR, [x[i : i + ROWS_OUT] for x in cols])

    return run


_KEYS = ("h", "salt", "c", "rid", "rth", "pos")


def _classify(spec: Spec) -> Callable:
    """Rows come sorted by (h, salt, c, rid, rth, pos).  Kind 0: a span that goes.  Kind 1:
    the text around it is needed to decide; n: members of its class here.

    A class that does not fit into memory is decided as it streams by: only its first
    members are held, with the number that they stand for (m)."""

    def emit(x: dict[str, np.ndarray], kind: int, keep: np.ndarray, members: np.ndarray) -> Iterator[pa.RecordBatch]:
        i = np.flatnonzero(keep)
        if len(i):
            pos = x["pos"][i]
            yield _batch(_FOUND, [np.full(len(i), kind, np.int32), x["h"][i], x["rid"][i], x["rth"][i], np.maximum(pos - spec.reach, 0), pos + spec.window, np.minimum(members[i], 2).astype(np.int32)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        rows, before = 0, None  # before: the (h, salt) of which a class is decided already

        def decide(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, before
            x = {k: np.concatenate([y[k] for y in held]) for k in held[0]}
            n = len(x["h"])
            new_h = np.ones(n, bool)
            new_h[1:] = (x["h"][1:] != x["h"][:-1]) | (x["salt"][1:] != x["salt"][:-1])
            new_c = new_h.copy()
            new_c[1:] |= x["c"][1:] != x["c"][:-1]
            of_h, of_c = np.cumsum(new_h) - 1, np.cumsum(new_c) - 1
            classes = np.bincount(of_h[new_c])
            classes[0] += before == (x["h"][0], x["salt"][0])
            members = np.bincount(of_c, weights=x["m"]).astype(np.int64)[of_c]
            heads = np.flatnonzero(new_c)
            first = heads[of_c]
            at, is_first = np.arange(n), np.arange(n) == first
            if spec.mode == "smaller":
                gone = x["rid"] > x["rid"][first]
                ask = ~gone
            elif spec.mode == "first":  # rows equal in id and text are one place
                gone = (x["rid"] != x["rid"][first]) | (x["rth"] != x["rth"][first]) | (x["pos"] != x["pos"][first])
                ask = ~gone
            else:
                gone, ask = members > 1, is_first
            wait = np.zeros(n, bool) if final else ask & (at >= heads[-1])
            yield from emit(x, 0, gone & ~wait, members)
            yield from emit(x, 1, ask & ~wait & ((classes[of_h] > 1) | (x["salt"] >= 0)), members)
            before = (x["h"][-1], x["salt"][-1]) if classes[-1] > 1 else None
            rest = {k: v[wait] for k, v in x.items()}
            rows = len(rest["h"])
            if rows:
                rest["m"][0] = members[-1] - (rows - 1)
            held = [rest] if rows else []

        for b in batches:
            if not b.num_rows:
                continue
            held.append({k: b.column(k).to_numpy(zero_copy_only=False) for k in _KEYS} | {"m": np.ones(b.num_rows, np.int64)})
            rows += b.num_rows
            if rows >= ROWS_OUT * 4:
                yield from decide(False)
        if held:
            yield from decide(True)

    return run


def _fetch(spec: Spec) -> Callable:
    """Texts around the asked places of each document, with their clipped starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            if spec.unit == "byte":
                begin, end, first = None, None, c.offsets
            else:
                w = words(c)
                begin, end, first = w.start, w.end, w.first
            out: list[list] = [[] for _ in _CONTEXT]
            asked = c.batch.column("asked")
            for i in range(c.rows):
                a = asked[i].values
                if a is None:
                    continue
                h, lo, hi, n = (a.field(k).to_numpy(zero_copy_only=False) for k in ("h", "lo", "hi", "n"))
                size = int(first[i + 1] - first[i])
                hi = np.minimum(hi, size)
                p, q = lo + first[i], hi + first[i]
                if begin is not None:
                    p, q = begin[p], end[q - 1]
                rid, rth = c.batch.column("rid")[i].as_py(), c.batch.column("rth")[i].as_py()
                for k in range(len(h)):
                    for col, v in zip(out, (h[k], rid, rth, lo[k], n[k], c.data[p[k] : q[k]].tobytes()), strict=True):
                        col.append(v)
                if len(out[0]) >= 4096:
                    yield _batch(_CONTEXT, out)
                    out = [[] for _ in _CONTEXT]
            if out[0]:
                yield _batch(_CONTEXT, out)

    return run


@dataclass
class Shard:
    """Contexts of some anchors.  sym, off: their symbols; text: bytes of each; at, keys:
    the places in sym where a window starts, and hashes of it, one for each seed."""

    rid: np.ndarray
    rth: np.ndarray
    lo: np.ndarray
    n: np.ndarray
    text: list[bytes]
    sym: np.ndarray
    off: np.ndarray
    at: np.ndarray
    keys: list[np.ndarray]

    @staticmethod
    def of(spec: Spec, rid, rth, lo, n, data: np.ndarray, off: np.ndarray, seeds: tuple[int, ...] = (1,)) -> Shard:
        """Built a few contexts at a time, so that what hashing takes stays small."""
        syms, sizes, at, keys, base, i = [data[:0]], [np.zeros(1, np.int64)], [], [[] for _ in seeds], 0, 0
        while i < len(off) - 1:
            j = min(max(int(np.searchsorted(off, off[i] + CHUNK_BYTES, side="right")) - 1, i + 1), len(off) - 1)
            part = Chunk(None, data[off[i] : off[j]], off[i : j + 1] - off[i], np.ones(j - i, bool))
            sym, is_bytes, first = _symbols(part, spec.unit)
            ends = first[1:][row_of(first)][: max(len(sym) - spec.window + 1, 0)]
            ok = np.flatnonzero(np.arange(len(ends)) + spec.window <= ends)
            for k, seed in zip(keys, seeds, strict=True):
                k.append(Prefix(sym, seed, is_bytes).sliding(spec.window)[ok])
            at.append(ok + base)
            syms.append(sym)
            sizes.append(first[1:] + base)
            base, i = base + len(sym), j
        none = [np.zeros(0, np.int64)]
        return Shard(
            rid, rth, lo, n, [data[off[i] : off[i + 1]].tobytes() for i in range(len(off) - 1)] if spec.unit == "word" else [],
            np.concatenate(syms[1:] or syms), np.concatenate(sizes), np.concatenate(at or none), [np.concatenate(k or [np.zeros(0, U)]) for k in keys],
        )

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, side="right") - 1


def _candidates(s: Shard, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """Windows (positions in sym) whose hash says that they may go, and those whose hash
    they share.  No window that goes is missing; the exact index decides."""
    rid = s.rid[s.row(s.at)]
    o = np.lexsort((s.at, rid, s.keys[0]))
    at, rid, key = s.at[o], rid[o], s.keys[0][o]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    g = np.cumsum(new) - 1
    size, head = np.bincount(g), np.flatnonzero(new)
    if spec.mode == "all":
        may = ref = size[g] > 1
    elif spec.mode == "first":
        may = np.arange(len(at)) > head[g]
        ref = new & (size[g] > 1)
    else:
        may = rid > rid[head[g]]
        ref = new & (size[g] > 1)
    return np.sort(at[may]), np.sort(at[ref])


def _runs(at: np.ndarray, s: Shard, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches covered by windows at `at`, by context: (context, lo, hi) in symbols."""
    if not len(at):
        return at, at, at
    row = s.row(at)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:] - 1, len(at) - 1)
    return row[head], at[head], at[tail] + spec.window


def _joined(rid, rth, lo, n, data: np.ndarray, off: np.ndarray) -> tuple:
    """Overlapping contexts of a document become one, so that no place is there twice."""
    hi = lo + np.diff(off)
    o = np.lexsort((lo, rth, rid))
    rid, rth, lo, hi, n, begin = rid[o], rth[o], lo[o], hi[o].astype(np.int64), n[o], off[:-1][o]
    new = np.ones(len(o), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (rth[1:] != rth[:-1])
    group = np.cumsum(new)
    far = np.maximum.accumulate(hi + group * (1 << 40)) - group * (1 << 40)  # the furthest end so far in the document
    skip = np.zeros(len(o), np.int64)
    skip[1:] = np.where(new[1:], 0, np.clip(far[:-1] - lo[1:], 0, hi[1:] - lo[1:]))
    new[1:] |= lo[1:] >= far[:-1]
    pieces = [data[b + k : b + e] for b, k, e in zip(begin, skip, hi - lo, strict=True)]
    sizes = hi - lo - skip
    head = np.flatnonzero(new)
    return rid[head], rth[head], lo[head], n[head], np.concatenate(pieces), np.append(0, np.cumsum(np.add.reduceat(sizes, head)))


def _decide(spec: Spec, exact: Callable) -> Callable:
    """exact(shard, spec, queries, references) -> (context, lo, hi) of what goes."""

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, rid, rth, lo, n = (np.concatenate([x[k] for x in held]) for k in range(5))
        data = np.concatenate([x[5] for x in held])
        off = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[6]) for x in held]))])
        if spec.unit == "byte":
            rid, rth, lo, n, data, off = _joined(rid, rth, lo, n, data, off)
        s = Shard.of(spec, rid, rth, lo, n, data, off)
        may, ref = _candidates(s, spec)
        if not len(may):
            return
        row, a, b = exact(s, spec, _runs(may, s, spec), _runs(ref, s, spec))
        if len(row):
            shift = s.lo[row] - s.off[row]
            yield _batch(_SPAN, [s.rid[row], s.rth[row], (a + shift).astype(np.int32), (b + shift).astype(np.int32)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for b in batches:
            h, rid, rth, lo, n = (b.column(k).to_numpy(zero_copy_only=False) for k in ("h", "rid", "rth", "lo", "n"))
            data, off, _ = string_parts(b.column("ctx"))
            at = 0
            for end in [*(np.flatnonzero(h[1:] != h[:-1]) + 1), len(h)] if len(h) else []:
                if held and size >= FLUSH_BYTES and h[at] != last:
                    yield from flush(held)
                    held, size = [], 0
                held.append((h[at:end], rid[at:end], rth[at:end], lo[at:end], n[at:end], data[off[at] : off[end]], off[at : end + 1] - off[at]))
                size += int(off[end] - off[at])
                last, at = h[end - 1], end
        if held:
            yield from flush(held)

    return run


def _windows(spec: Spec) -> Callable:
    """For anchors beyond the limit: every window of every context, by 128 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, "ctx"):
            rid, rth, lo, n = (c.batch.column(k).to_numpy(zero_copy_only=False) for k in ("rid", "rth", "lo", "n"))
            s = Shard.of(spec, rid, rth, lo, n, c.data, c.offsets, seeds=(1, 0))
            for i in range(0, len(s.at), ROWS_OUT):
                a, (w, v) = s.at[i : i + ROWS_OUT], (k[i : i + ROWS_OUT].view(np.int64) for k in s.keys)
                r = s.row(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (w, v, rid[r], rth[r], (a - s.off[r] + lo[r]).astype(np.int32), n[r])],
                    names=["w", "v", "rid", "rth", "at", "n"],
                )

    return run


def _by_window(contexts: DataFrame, spec: Spec) -> DataFrame:
    w = contexts.mapInArrow(_windows(spec), "w long, v long, rid long, rth long, at int, n int")
    place = F.struct("rid", "rth", "at")
    w = w.groupBy("w", "v", "rid", "rth", "at").agg(F.max("n").alias("n"))
    per = w.groupBy("w", "v").agg(F.count("*").alias("times"), F.min(place).alias("head"))
    joined = w.join(per.filter("times > 1"), ["w", "v"])
    if spec.mode == "all":
        gone = joined.filter("n = 1")
    elif spec.mode == "first":
        gone = joined.filter(place > F.col("head"))
    else:
        gone = joined.filter(F.col("rid") > F.col("head.rid"))
    return gone.select("rid", "rth", F.col("at").alias("lo"), (F.col("at") + spec.window).cast("int").alias("hi"))


def _hot(base: DataFrame, find: Callable) -> DataFrame:
    """hot_h, salts: the anchors that would outgrow a task, and how many ways to deal each."""
    sampled = durable(
        base.filter(hash_unit(F.col("rid"), F.col("rth"), seed=7) < 0.01).mapInArrow(find, ANCHOR).groupBy(F.col("h").alias("hot_h")).count()
    )
    total = sampled.agg(F.sum("count")).first()[0] or 0
    one = max(total / parts(base.sparkSession) / 8, 1.0)
    salts = F.least(F.ceil(F.col("count") / F.lit(one)) + 1, F.lit(4096)).cast("int")
    return sampled.filter(F.col("count") >= max(SAMPLED, total * SHARE)).select("hot_h", salts.alias("salts"))


def repeated_spans(docs: DataFrame, spec: Spec, exact: Callable) -> DataFrame:
    """docs: (rid long, rth long, text string, ...) -> (rid, rth, spans array<struct<lo,hi>>),
    one row for each document with something to remove; spans may overlap."""
    spark = docs.sparkSession
    base = docs.select("rid", "rth", "text")
    find = _find_anchors(spec)
    found = (
        base.mapInArrow(find, ANCHOR)
        .join(F.broadcast(_hot(base, find)), F.col("h") == F.col("hot_h"), "left")
        .withColumn("salt", F.when(F.col("hot_h").isNull(), F.lit(-1)).otherwise(F.pmod(F.hash("rid", "rth", "pos"), F.col("salts"))))
        .drop("hot_h", "salts")
        .repartition(parts(spark), "h", "salt")
        .sortWithinPartitions("h", "salt", "c", "rid", "rth", "pos")
        .mapInArrow(_classify(spec), FOUND)
    )
    found = durable(found)
    asked = found.filter("kind = 1")
    over = durable(asked.groupBy("h").count().filter(F.col("count") > spec.limit).select("h", F.lit(True).alias("over")))
    some_over = over.limit(1).count() > 0

    def contexts(rows: DataFrame) -> DataFrame:
        requests = rows.groupBy("rid", "rth").agg(F.collect_list(F.struct("h", "lo", "hi", "n")).alias("asked"))
        return base.join(requests, ["rid", "rth"]).mapInArrow(_fetch(spec), CONTEXT)

    decided = (
        contexts(asked.join(over, "h", "left_anti") if some_over else asked)
        .repartition(parts(spark), "h")
        .sortWithinPartitions("h", "rid", "rth", "lo")
        .mapInArrow(_decide(spec, exact), SPAN)
    )
    spans = found.filter("kind = 0").select("rid", "rth", "lo", "hi").unionByName(decided)
    if some_over:
        spans = spans.unionByName(_by_window(contexts(asked.join(over, "h", "left_semi")), spec))
    return spans.groupBy("rid", "rth").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def parts(spark) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)


def spans_of(value: pa.Scalar, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of one row's spans, cut at the end of the text."""
    a = value.values if value.is_valid else None
    if a is None or not len(a):
        none = np.zeros(0, np.int64)
        return none, none
    lo, hi = (a.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "hi"))
    return union_spans(lo, np.minimum(hi, size))
