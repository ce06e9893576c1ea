"""Hard negatives by shared candidate lists of anchor clusters (MAXIMUS-style).

Anchors are put in clusters around directions from a bounded sample; a cluster knows the
widest angle between a member and its direction.  Candidates are dealt to blocks by a hash.
In a block, a cluster sorts the candidates once by what no member's inner product can
exceed for each unit of its length: the candidate's length times the cosine of its angle
to the direction, less the cluster's width.  Each member walks that list from the top, a
slab at a time, and ends as soon as the bound of the next slab is below the worst score
that it holds: the rest cannot rank, so the walk is exact.

Members start with a floor: the score that the same search reaches in the bounded sample.
It is reached in the whole as well, so lists end early in every block.

The search runs twice: for an anchor's positives (rows of its label), then for the
negatives in the score window that each positive opens.  Both keep k rows of each block.
Clusters are split into pieces of bounded size, blocks have a bounded size, and anchors are
a stated query set, so no task holds a group that grows with the data.

Cases: rows with a null label, id or vector, or with a part that is null or not finite (also
after scaling) take no part, nor do those of another length than the commonest (the shorter
among equals).  An anchor's id is never its own partner, so that rows that repeat it are not
either; other rows with equal ids are rows of their own, with equal lines in the result.
Anchors equal in id, vector and label give one list.  Fewer partners than asked for: all of
them.  Ties: smaller id.  Inner products beyond 64 bits are cut off at the ends of a long.
Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SAMPLE = 4096  # rows that directions and floors come from
CLUSTERS = 64
PIECE = 512  # members of a cluster that walk together
BLOCK = 4096  # candidates of a block
SLAB = 512
LONG = 2**63 - 1


def quantised(vec: Column, scale: float = 256.0) -> Column:
    return F.transform(vec.cast("array<double>"), lambda x: _floor(x * F.lit(scale)))


def _floor(x: Column) -> Column:
    """floor() that stays a double, as whole doubles beyond 2**53 are their own floor."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def prepare(embeddings: DataFrame, is_anchor: Column, label: Column, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """-> id, vec (whole doubles), label, anchor: the rows that take part."""
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col), scale).alias("vec"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce((F.size("vec") > 0) & ~odd, F.lit(False)))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return rows.join(F.broadcast(length), F.size("vec") == F.col("n"), "left_semi")


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole doubles, as longs."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)), np.int64)
    most = np.sqrt((x * x).sum(1).max()) * np.sqrt((y * y).sum(1).max())
    if most < 2.0**52:  # every partial sum is a whole double
        return (x @ y.T).astype(np.int64)
    if most < 2.0**61:
        return x.astype(np.int64) @ y.astype(np.int64).T
    whole = [[int(v) for v in r] for r in y]
    out = [[max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(p, q, strict=True)))) for q in whole] for p in ([int(v) for v in r] for r in x)]
    return np.array(out, np.int64)


def directions(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means over rows of a sample."""
    u = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    c = u[np.random.default_rng(3).permutation(len(u))[:n]]
    for _ in range(rounds):
        near = (u @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        size = np.linalg.norm(total, axis=1)
        c = np.where((size > 1e-9)[:, None], total / np.maximum(size, 1e-9)[:, None], c)
    return c


def angle_cosines(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1)
    return np.clip(np.where(size > 0, (x @ c) / np.maximum(size, 1e-300), 1.0), -1, 1)


class Listed:
    """Candidates of a block in the order of a cluster's bound, greatest first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, labels: np.ndarray, centre: np.ndarray, width: float):
        angle = np.arccos(angle_cosines(x, centre))
        size = np.linalg.norm(x, axis=1)
        # a little above the true bound, so that rounding never ends a walk early
        bound = size * np.cos(np.maximum(angle - width - 1e-7, 0)) + size * 1e-9
        o = np.lexsort((ids, -bound))
        self.ids, self.x, self.labels = ids[o], x[o], labels[o]
        self.bound = bound[o]

    def walk(self, members: np.ndarray, size: np.ndarray, floors: list[np.ndarray], wanted, k: int) -> tuple[list[list[tuple[np.ndarray, np.ndarray]]], np.ndarray]:
        """For each member and each of its searches, the k best (scores, ids), and how many
        candidates each member met.  floors: for each member and search, the least score of
        interest so far; wanted(member, scores, ids, labels): a mask for each search."""
        held = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in f] for f in floors]
        floors = [f.copy() for f in floors]
        met = np.zeros(len(members), np.int64)
        alive = np.arange(len(members))
        for at in range(0, len(self.ids), SLAB):
            top = self.bound[at]
            reach = np.array([f.min() if len(f) else np.inf for f in (floors[i] for i in alive)])
            # negative bounds shrink with a member's length, so the length itself is used
            alive = alive[top * size[alive] + 1e-6 >= reach]
            if not len(alive):
                break
            part = slice(at, at + SLAB)
            scores = products(members[alive], self.x[part])
            met[alive] += scores.shape[1]
            for row, i in zip(scores, alive, strict=True):
                for s, mask in enumerate(wanted(i, row, self.ids[part], self.labels[part])):
                    new = np.flatnonzero(mask & (row >= floors[i][s]))
                    if not len(new):
                        continue
                    sc, idn = np.concatenate([held[i][s][0], row[new]]), np.concatenate([held[i][s][1], self.ids[part][new]])
                    o = np.lexsort((idn, -sc))[:k]
                    held[i][s] = (sc[o], idn[o])
                    if len(o) == k:
                        floors[i][s] = max(floors[i][s], sc[o[-1]])
        return held, met


@dataclass
class Clusters:
    centres: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    labels: np.ndarray

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.maximum(np.linalg.norm(x, axis=1), 1e-300)
        cosine = (x / size[:, None]) @ self.centres.T
        at = cosine.argmax(1)
        zero = ~x.any(1)
        return at, np.where(zero, 0.0, np.arccos(np.clip(cosine[np.arange(len(x)), at], -1, 1)))

    def floor(self, anchor_id: int, label: int, scores: np.ndarray, lo: np.ndarray, hi: np.ndarray, same: bool, k: int) -> np.ndarray:
        """The k-th best score in the sample for each window [lo, hi], or lo."""
        ok = (self.ids != anchor_id) & ((self.labels == label) == same)
        out = lo.copy()
        for s in range(len(lo)):
            got = scores[ok & (scores >= lo[s]) & (scores <= hi[s])]
            if lo[s] > hi[s]:
                out[s] = LONG  # nothing fits
            elif len(got) >= k:
                out[s] = max(out[s], np.partition(got, len(got) - k)[len(got) - k])
        return out


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def fit(rows: DataFrame, *, clusters: int = CLUSTERS, sample: int = SAMPLE) -> Clusters | None:
    """rows: as of ``prepare``.  At most ``sample`` rows, in order of a hash of the id, are
    read; directions come from the anchors among as many."""

    def some(df: DataFrame) -> pa.Table:
        return df.select("id", "vec", "label").orderBy(F.xxhash64("id"), "id", "vec", "label").limit(sample).toArrow()

    anchors, got = some(rows.filter("anchor")), some(rows)
    if not anchors.num_rows:
        return None
    x = matrix(anchors.column("vec").combine_chunks())
    return Clusters(directions(x, clusters), got.column("id").to_numpy(), matrix(got.column("vec").combine_chunks()), got.column("label").to_numpy())


_MEMBER = "id long, key long, vec array<double>, label long, c int, width double, size double, lo array<long>, hi array<long>, floors array<long>"


def _assign(shared, same: bool, k: int):
    """Cluster, width and floors of anchors with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                p = b.slice(at, 1024)
                model, x = shared.value, matrix(p.column("vec"))
                c, width = model.nearest(x)
                los, his = p.column("lo").to_pylist(), p.column("hi").to_pylist()
                ids, labels = p.column("id").to_numpy(), p.column("label").to_numpy()
                scores = products(x, model.x)
                floors = [model.floor(ids[i], labels[i], scores[i], np.array(los[i], np.int64), np.array(his[i], np.int64), same, k).tolist() for i in range(len(x))]
                yield pa.RecordBatch.from_arrays(
                    [p.column("id"), p.column("key"), p.column("vec"), p.column("label"), pa.array(c.astype(np.int32)), pa.array(width), pa.array(np.linalg.norm(x, axis=1)), p.column("lo"), p.column("hi"), pa.array(floors, pa.list_(pa.int64()))],
                    names=["id", "key", "vec", "label", "c", "width", "size", "lo", "hi", "floors"],
                )

    return run


def _meet(shared, same: bool, k: int):
    """Rows come sorted by (b, side, c, piece): a block's candidates, then its members."""

    def found(block: tuple, members: pa.RecordBatch) -> pa.RecordBatch:
        ids, x, labels = block
        centre = shared.value.centres[members.column("c")[0].as_py()]
        lst = Listed(ids, x, labels, centre, max(members.column("width").to_pylist()))
        mx, mid, mlabel = matrix(members.column("vec")), members.column("id").to_numpy(), members.column("label").to_numpy()
        lo = [np.array(v, np.int64) for v in members.column("lo").to_pylist()]
        hi = [np.array(v, np.int64) for v in members.column("hi").to_pylist()]

        def wanted(i: int, scores: np.ndarray, cids: np.ndarray, clabels: np.ndarray):
            ok = (cids != mid[i]) & ((clabels == mlabel[i]) == same)
            return [ok & (scores >= a) & (scores <= b) for a, b in zip(lo[i], hi[i], strict=True)]

        held, met = lst.walk(mx, members.column("size").to_numpy(), [np.array(f, np.int64) for f in members.column("floors").to_pylist()], wanted, k)
        take, search, partner, score = [], [], [], []
        for i, h in enumerate(held):
            for s, (sc, idn) in enumerate(h):
                take += [i] * len(sc)
                search += [s] * len(sc)
                partner += idn.tolist()
                score += sc.tolist()
        at = pa.array(take, pa.int64())
        return pa.RecordBatch.from_arrays(
            [members.column("id").take(at), members.column("key").take(at), pa.array(search, pa.int32()), pa.array(partner, pa.int64()), pa.array(score, pa.int64()), pa.array(met).take(at)],
            names=["id", "key", "search", "partner", "score", "met"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready, waiting, last = None, [], None, [], None
        for batch in batches:
            b, side = batch.column("b").to_numpy().astype(np.int64), batch.column("side").to_numpy()
            c, piece = batch.column("c").to_numpy(zero_copy_only=False), batch.column("piece").to_numpy(zero_copy_only=False)
            if not len(b):
                continue
            new = np.flatnonzero((np.diff(b) != 0) | (np.diff(side) != 0) | (np.diff(c) != 0) | (np.diff(piece) != 0)) + 1
            cuts = [0, *new, len(b)]
            for lo, hi in zip(cuts, cuts[1:]):
                here, part = (b[lo], side[lo], c[lo], piece[lo]), batch.slice(lo, hi - lo)
                if waiting and here != last:
                    yield found(ready, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
                    waiting = []
                last = here
                if b[lo] != block:
                    block, held, ready = b[lo], [], None
                if side[lo] == 0:
                    held.append((part.column("id").to_numpy(), matrix(part.column("vec")), part.column("label").to_numpy()))
                    continue
                if not held:
                    continue
                if ready is None:
                    ready = tuple(np.concatenate([h[i] for h in held]) for i in range(3))
                waiting.append(part)
        if waiting:
            yield found(ready, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return run


def _search(rows: DataFrame, members: DataFrame, shared, blocks: int, same: bool, k: int) -> DataFrame:
    """members: (id, key, vec, label, lo, hi) -> id, key, search, partner, score, met, rank:
    the k best of the whole in each window; met: candidates that the walk in a block met."""
    placed = durable(members.mapInArrow(_assign(shared, same, k), _MEMBER))
    sizes = placed.groupBy("c").agg(F.ceil(F.count("*") / F.lit(float(PIECE))).cast("int").alias("pieces"))  # one row for each cluster
    cut = placed.join(F.broadcast(sizes), "c").withColumn("piece", F.pmod(F.col("key"), F.col("pieces")).cast("int"))
    ours = [F.lit(None).cast(t).alias(n) for n, t in (("key", "long"), ("width", "double"), ("size", "double"), ("lo", "array<long>"), ("hi", "array<long>"), ("floors", "array<long>"))]
    left = rows.select(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("b"), F.lit(0).alias("side"), F.lit(-1).alias("c"), F.lit(-1).alias("piece"), "id", "vec", "label", *ours)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")
    right = cut.select(every, F.lit(1).alias("side"), "c", "piece", "id", "vec", "label", "key", "width", "size", "lo", "hi", "floors")
    dealt = left.unionByName(right).repartition(blocks, "b").sortWithinPartitions("b", "side", "c", "piece")
    found = dealt.mapInArrow(_meet(shared, same, k), "id long, key long, search int, partner long, score long, met long")
    order = Window.partitionBy("id", "key", "search").orderBy(F.desc("score"), "partner")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    embeddings: DataFrame, is_anchor: Column, label: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, clusters: int = CLUSTERS, block: int = BLOCK,
) -> DataFrame:
    """-> anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor and each of its best ``positives`` rows of the same label, the best ``negatives``
    rows of another label whose score is between ``low`` and ``high`` per cent of the
    positive's.  Scores are inner products of the vectors times ``scale``, rounded down."""
    spark = embeddings.sparkSession
    rows = durable(prepare(embeddings, is_anchor, label, id_col, vec_col, scale))
    model = fit(rows, clusters=clusters)
    if model is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    shared = spark.sparkContext.broadcast(model)
    blocks = max(-(-rows.count() // block), 1)
    anchors = rows.filter("anchor").select("id", "vec", "label").distinct().withColumn("key", F.xxhash64("vec", "label"))
    whole = [F.array(F.lit(v)).alias(n) for n, v in (("lo", -LONG - 1), ("hi", LONG))]
    best = _search(rows, anchors.select("*", *whole), shared, blocks, True, positives)
    # exact: a positive's score times a percentage has two decimals
    part = F.col("score").cast("decimal(20,0)")
    window = F.struct("rank", F.ceil(part * low / 100).cast("long").alias("lo"), F.floor(part * high / 100).cast("long").alias("hi"), "partner", "score")
    asked = durable(best.groupBy("id", "key").agg(F.array_sort(F.collect_list(window)).alias("w")))  # at most ``positives`` windows
    members = anchors.join(asked, ["id", "key"]).select("id", "key", "vec", "label", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    far = _search(rows, members, shared, blocks, False, negatives)
    return far.join(asked.withColumnRenamed("w", "windows"), ["id", "key"]).select(
        F.col("id").alias("anchor_id"), F.col("windows.partner")[F.col("search")].alias("positive_id"), "rank", F.col("partner").alias("negative_id"),
        F.col("windows.score")[F.col("search")].alias("positive_score"), F.col("score").alias("negative_score"),
    )
