"""Nearest neighbours with a permutation index.

Pivots are chosen from a bounded sample, each as far as possible from those before it.  A
vector is represented by its nearest pivots in order; the index posts it in the inverted
files of those pivots with its position.  A query adds up, over the files of its own
nearest pivots, how far each vector's positions are from its own (the footrule distance,
with the length of the prefix for a missing pivot), keeps the vectors that rank within its
limit, and reranks them by exact distance.

A query's limit is the footrule distance within which the nearest ``share`` of the sample
lies, so it follows the density around that query.  The share is calibrated: the smallest
one with which sampled queries find ``goal`` of their true neighbours.  Neighbours are
farther apart in a sample than in the whole, so it errs on the wide side; every vector
within the limit is kept, however many.

Vectors are dealt to blocks by a hash of id and vector; each block is posted once and all
queries stream past it.  No block grows with the data, and no vector is copied.

Cases: vectors that are null, empty, zero, or with null or non-finite parts take no part,
nor do those of another length than the commonest (the shorter among equals) or without an
id; repeated ids are separate candidates except for their own query; query rows equal in
id and vector give one list, those of one id with other vectors one list each; fewer than
``k`` candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SAMPLE = 8192
POOL = 2048
PIVOTS = 256
PREFIX = 128
BLOCK = 4096
GOAL = 0.97
SHARES = (0.01, 0.02, 0.03, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the farthest from those before it."""
    out, d = [0], squared(x, x[:1])[:, 0]
    while len(out) < min(n, len(x)) and d.max() > 0:
        out.append(int(d.argmax()))
        d = np.minimum(d, squared(x, x[out[-1] :][:1])[:, 0])
    return x[out]


class Files:
    """Inverted files of a block of vectors.  A pivot is near a good part of them (prefix /
    pivots on average), so its file is dense: the position that it has among each vector's
    pivots, ``prefix`` where it is none."""

    def __init__(self, perms: np.ndarray, pivots: int):
        self.n, self.prefix = perms.shape
        self.position = np.full((pivots, self.n), self.prefix, np.int16)
        self.position[perms.T, np.arange(self.n)] = np.arange(self.prefix, dtype=np.int16)[:, None]

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Footrule distance of every posted vector from a query's permutation.  Only the
        files of the query's pivots are read: the others add up to what these leave."""
        m = self.prefix
        pos = self.position[query]
        near = (np.abs(pos - np.arange(m, dtype=np.int16)[:, None]) + pos).sum(0, dtype=np.int32)
        return near + np.int32(m * (m + 1) // 2 - m * m)


@dataclass
class PermutationIndex:
    pivots: np.ndarray
    prefix: int
    sample: np.ndarray  # permutations of the sample
    share: float = 1.0

    def permutations(self, x: np.ndarray) -> np.ndarray:
        """The nearest pivots of each vector, nearest first, ties by pivot."""
        return np.argsort(squared(x, self.pivots), 1, kind="stable")[:, : self.prefix].astype(np.int32)

    def limits(self, perms: np.ndarray) -> np.ndarray:
        """The footrule distance of each permutation that holds its share of the sample."""
        files = Files(self.sample, len(self.pivots))
        at = min(int(np.ceil(self.share * files.n)), files.n - 1)
        return np.array([np.partition(files.footrule(p), at)[at] for p in perms], np.int32)

    def calibrate(self, x: np.ndarray, queries: int, k: int, goal: float) -> None:
        """x: the vectors of the sample."""
        n = len(x)
        files = Files(self.sample, len(self.pivots))
        picked = range(0, n, max(n // queries, 1))
        found = np.zeros(len(SHARES))
        for q in picked:
            d = squared(x[q : q + 1], x)[0]
            d[q] = np.inf
            near = np.argsort(d, kind="stable")[: min(k, n - 1)]
            f = files.footrule(self.sample[q])
            f[q] = 0
            limit = np.sort(f)[[min(int(np.ceil(s * n)), n - 1) for s in SHARES]]
            found += (f[near][:, None] <= limit[None]).mean(0) if len(near) else 1
        self.share = SHARES[int(np.argmax(found / max(len(picked), 1) >= goal))]


def usable(vec: Column) -> Column:
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~odd & F.exists(vec, lambda x: x != 0)


def prepare(embeddings: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """-> id, vec, q (whether it is a query): the vectors that take part."""
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(usable(F.col("vec")), F.lit(False)))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return rows.join(F.broadcast(length), F.size("vec") == F.col("n"), "left_semi")


def fit(vectors: DataFrame, *, k: int = 10, sample: int = SAMPLE, pivots: int = PIVOTS, prefix: int = PREFIX, goal: float = GOAL) -> PermutationIndex | None:
    """vectors: (id, vec).  Pivots and calibration come from at most ``sample`` of them."""
    got = vectors.select("id", "vec").orderBy(F.xxhash64("id"), "id", "vec").limit(sample).toArrow()
    if not got.num_rows:
        return None
    x = np.unique(_matrix(got.column("vec").combine_chunks()), axis=0)
    x = x[np.random.default_rng(1).permutation(len(x))]
    index = PermutationIndex(far_apart(x[:POOL], pivots), 0, np.zeros((0, 0)))
    index.prefix = min(prefix, len(index.pivots))
    index.sample = index.permutations(x)
    index.calibrate(x, 256, k, goal)
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column whose values all have one length."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _with_limits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                perms = shared.value.permutations(_matrix(b.column("vec")))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("vec"), pa.array(shared.value.limits(perms)), pa.array([p.tobytes() for p in perms], pa.binary())], names=["id", "vec", "lim", "perm"]
                )

    return run


def _meet(shared, k: int, id_type: pa.DataType):
    """Rows come sorted by (b, side): a block's vectors, then the queries."""

    def rank(ids: np.ndarray, x: np.ndarray, files: Files, b: pa.RecordBatch) -> Iterator[tuple]:
        least = min(len(ids), 4 * k) - 1
        for qid, q, limit, perm in zip(b.column("id").to_numpy(zero_copy_only=False), _matrix(b.column("vec")), b.column("lim").to_numpy(), b.column("perm").to_pylist(), strict=True):
            f = files.footrule(np.frombuffer(perm, np.int32))
            near = np.flatnonzero(f <= max(limit, np.partition(f, least)[least]))
            near = near[ids[near] != qid]
            d = np.sqrt(((x[near] - q) ** 2).sum(1))
            o = np.argsort(d, kind="stable")[:k]  # ids ascend, so ties go to the smaller
            yield [qid] * len(o), [q.tobytes()] * len(o), ids[near[o]], d[o], [len(near)] * len(o)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, files, ids, x = None, [], None, None, None
        for batch in batches:
            blocks, side = batch.column("b").to_numpy(), batch.column("side").to_numpy()
            key = blocks.astype(np.int64) * 2 + side
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1), len(key)] if len(key) else [0]
            for lo, hi in zip(cuts, cuts[1:]):
                piece = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, held, files = blocks[lo], [], None
                if side[lo] == 0:
                    held.append((piece.column("id").to_numpy(zero_copy_only=False), _matrix(piece.column("vec"))))
                    continue
                if not held:
                    continue
                if files is None:
                    ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                    o = np.argsort(ids, kind="stable")
                    ids, x = ids[o], x[o]
                    files = Files(shared.value.permutations(x), len(shared.value.pivots))
                out = list(zip(*rank(ids, x, files, piece), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v for part in c for v in part], t) for c, t in zip(out, (id_type, pa.binary(), id_type, pa.float64(), pa.int64()), strict=True)],
                    names=["query_id", "q", "vec_id", "score", "n_candidates"],
                )

    return run


def search(embeddings: DataFrame, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, index: PermutationIndex | None = None) -> DataFrame:
    """-> query_id, rank, vec_id, score, n_candidates: the k nearest found, by Euclidean
    distance in double precision, ties to the smaller id; n_candidates: vectors of the same
    block that were reranked.  is_query: condition on the embeddings' columns."""
    spark = embeddings.sparkSession
    vectors = durable(prepare(embeddings, is_query, id_col, vec_col))
    kind = dict(vectors.dtypes)["id"]
    index = index or fit(vectors, k=k)
    if index is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double, n_candidates long")
    blocks = max(-(-vectors.count() // BLOCK), 1)
    shared = spark.sparkContext.broadcast(index)
    queries = vectors.filter("q").select("id", "vec").distinct().mapInArrow(_with_limits(shared), f"id {kind}, vec array<double>, lim int, perm binary")
    left = vectors.select(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("b"), F.lit(0).alias("side"), "id", "vec", F.lit(0).alias("lim"), F.lit(None).cast("binary").alias("perm"))
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.lit(1).alias("side"), "id", "vec", "lim", "perm")
    dealt = left.unionByName(right).repartition(blocks, "b").sortWithinPartitions("b", "side")
    id_type = spark.createDataFrame([], f"id {kind}").toArrow().schema.field("id").type
    found = dealt.mapInArrow(_meet(shared, k, id_type), f"query_id {kind}, q binary, vec_id {kind}, score double, n_candidates long")
    order = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "n_candidates")
