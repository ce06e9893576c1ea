"""Near-duplicate join on word n-grams: a MinHash LSH forest, then exact verification.

1. Every text becomes its set of hashed word 5-grams.  Texts with the same set are one
   *node* with a number of copies; copies never meet each other again.
2. A node's MinHash signature is a path of ``DEPTH`` levels in each tree of a forest.  The
   paths of a tree are sorted, which makes them a prefix trie; nodes below the same trie
   node at the shortest depth in use hang on the smallest of them (no pairs are listed):
   trees agree on it, so a large group has few different links.
3. The components of these links hold all candidate pairs.  A pair is a candidate if it
   shares a prefix in some tree that is as long as its recall allows: matching starts at
   full depth and gives up a level at a time, until a pair of these set sizes at the
   threshold (or the next similarity above it that such sizes can have) is found with the
   target probability.  Candidates are verified exactly, from the sets; what leaves is a
   count of links and one edge for each node.
4. Components go by pairs of blocks of nodes, or, where that moves fewer sets (long chains),
   by the trie nodes inside them; a pair in several of these counts in its first tree only.

Cases: texts of one to four words are a set of one n-gram (all their words); null, empty
and blank texts have no n-grams, no links, and a class of their own; a null id is carried
along; rows that repeat an id are judged by their texts; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import U, Prefix, chunks, mix, row_of, string_parts, words
from .common import durable, row_keyed
from .components import connected
from .repeats import parts

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
RECALL = 0.99999
BLOCK = 1024
#: Components of more blocks may be dealt by trie nodes instead.
FEW_BLOCKS = 4
COLUMNS = 4096


def forest_depth(similarity, trees: int, deepest: int, recall: float) -> np.ndarray:
    """The longest prefix with which a pair of a similarity is found with the target
    probability, given up level by level (1 at least)."""
    s = np.asarray(similarity, float)
    depth = np.full(s.shape, deepest)
    while (short := (depth > 1) & (1 - (1 - s**depth) ** trees < recall)).any():
        depth = depth - short
    return depth


def least_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """The least similarity of at least the threshold that sets of a and b members can have
    (above 1: none)."""
    common = np.ceil(threshold * (a + b) / (1 + threshold) - 1e-9)
    return np.where(common <= np.minimum(a, b), common / np.maximum(a + b - common, 1), 2.0)


def shingle_sets(c, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each text's distinct word n-grams, in order of rows."""
    w = words(c)
    prefix = Prefix(Prefix(c.data).of(w.start, w.end), 0, False)
    first, last = w.first[:-1], w.first[1:]
    grams = prefix.sliding(width)
    row = row_of(w.first)[: len(grams)]
    at = np.flatnonzero(np.arange(len(grams)) + width <= last[row])
    short = np.flatnonzero((last > first) & (last - first < width))
    row = np.concatenate([row[at], short])
    h = np.concatenate([grams[at], prefix.of(first[short], last[short])])
    o = np.lexsort((h, row))
    row, h = row[o], h[o]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _signatures(width: int, trees: int, depth: int):
    rng = np.random.default_rng(8)
    a = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) | U(1)
    b = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """paths: of each tree in turn, two bytes for each level."""
        for c in chunks(batches):
            row, h = shingle_sets(c, width)
            n = np.bincount(row, minlength=c.rows)
            has = np.flatnonzero(n)
            at = np.cumsum(n[has]) - n[has]
            node: list = [None] * c.rows
            paths: list = [None] * c.rows
            if len(has):
                one, two = np.add.reduceat(mix(h), at), np.add.reduceat(mix(h ^ U(0x9E3779B97F4A7C15)), at)
                names = np.stack([one, two], 1)
                path = np.empty((len(has), trees * depth), ">u2")
                for d in range(trees * depth):
                    low = np.minimum.reduceat(((h * a[d] + b[d]) >> U(32)).astype(np.uint32), at)
                    path[:, d] = mix(low.astype(U)) >> U(48)
                for j, i in enumerate(has):
                    node[i], paths[i] = names[j].tobytes(), path[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(c.batch.column(k) for k in ("doc_id", "rid", "rth")), pa.array(node, pa.binary()), pa.array(n.astype(np.int32)), pa.array(paths, pa.binary())],
                names=["doc_id", "rid", "rth", "node", "n", "paths"],
            )

    return run


def _trie(base: int):
    """Rows (tree, path, node) come sorted by tree, prefix of ``base`` levels and node ->
    edges (u, v) of the nodes to the first one below the same trie node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for b in batches:
            if not b.num_rows:
                continue
            tree, node = b.column("tree").to_numpy(), b.column("node")
            data, _, _ = string_parts(b.column("path"))
            prefix = data.reshape(b.num_rows, -1)[:, : 2 * base]
            new = np.ones(b.num_rows, bool)
            new[1:] = (tree[1:] != tree[:-1]) | (prefix[1:] != prefix[:-1]).any(1)
            new[0] = (tree[0], prefix[0].tobytes()) != last
            head = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1))
            u = np.flatnonzero(~new)
            heads = [first if h < 0 else node[int(h)].as_py() for h in head[u]]
            yield pa.RecordBatch.from_arrays([node.take(pa.array(u)), pa.array(heads, pa.binary())], names=["u", "v"])
            last = (tree[-1], prefix[-1].tobytes())
            if head[-1] >= 0:
                first = node[int(head[-1])].as_py()

    return run


_SET = ("node", "comp", "tree", "copies", "blocks", "paths")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            row, h = shingle_sets(c, width)
            cut = np.searchsorted(row, np.arange(c.rows + 1))
            yield pa.RecordBatch.from_arrays(
                [*(c.batch.column(k) for k in _SET), pa.array([h[cut[i] : cut[i + 1]].tobytes() for i in range(c.rows)], pa.binary())],
                names=[*_SET, "grams"],
            )

    return run


@dataclass
class Side:
    """A block of nodes: name, copies, paths (nodes, trees, levels) and set of each."""

    node: list[bytes]
    copies: np.ndarray
    paths: np.ndarray
    sets: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.node)

    def part(self, lo: int, hi: int) -> Side:
        return Side(self.node[lo:hi], self.copies[lo:hi], self.paths[lo:hi], self.sets[lo:hi])


def candidates(a: Side, b: Side, tree: int, threshold: float, recall: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that share a long enough prefix in some tree; with ``tree`` >= 0, only
    those of which it is the first such tree."""
    na, nb = (np.array([len(s) for s in x.sets]) for x in (a, b))
    trees, deepest = a.paths.shape[1:]
    least = least_similarity(na[:, None], nb[None], threshold)
    needed = np.where(least > 1, deepest + 1, forest_depth(np.minimum(least, 1), trees, deepest, recall))
    first = np.full(needed.shape, trees)
    key_a, key_b = np.zeros(a.paths.shape[:2], U), np.zeros(b.paths.shape[:2], U)
    for d in range(1, deepest + 1):
        key_a, key_b = (mix(k * U(3) + x.paths[:, :, d - 1].astype(U)) for k, x in ((key_a, a), (key_b, b)))
        if (here := needed == d).any():
            for t in range(trees - 1, -1, -1):
                first[here & (key_a[:, t][:, None] == key_b[:, t][None])] = t
    return np.nonzero(first < trees if tree < 0 else first == tree)


def verified(a: Side, b: Side, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the candidate pairs, those whose similarity reaches the threshold."""
    if len(i) * 4 > len(a) * len(b):
        at = np.zeros((len(a), len(b)), bool)
        at[i, j] = True
        x, y = links(a.sets, b.sets, threshold)
        return x[at[x, y]], y[at[x, y]]
    keep = np.zeros(len(i), bool)
    for k, (x, y) in enumerate(zip(i, j, strict=True)):
        x, y = a.sets[x], b.sets[y]
        both = len(x) + len(y) - len(np.union1d(x, y))
        either = len(x) + len(y) - both
        keep[k] = reaches(both, either, threshold)
    return i[keep], j[keep]


def reaches(both, either, threshold: float):
    """both / either >= threshold, in whole numbers: the threshold is the decimal fraction
    that it is written as."""
    t = Fraction(str(threshold))
    return both * t.denominator >= either * t.numerator


def links(sets_a: list[np.ndarray], sets_b: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) whose Jaccard similarity reaches the threshold, from the sizes of
    their exact intersections."""
    na, nb = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    both = np.concatenate([*sets_a, *sets_b])
    u, col = np.unique(both, return_inverse=True)
    row = np.repeat(np.arange(len(na) + len(nb)), np.concatenate([na, nb]))
    inside_a, inside_b = np.zeros(len(u), bool), np.zeros(len(u), bool)
    m = int(na.sum())
    inside_a[col[:m]] = True
    inside_b[col[m:]] = True
    shared = np.cumsum(inside_a & inside_b) - 1
    keep = (inside_a & inside_b)[col]
    row, col = row[keep], shared[col[keep]]
    o = np.argsort(col, kind="stable")
    row, col = row[o], col[o]
    common = np.zeros((len(na), len(nb)), np.int64)
    for lo in range(0, int(shared[-1]) + 1 if len(u) else 0, COLUMNS):
        i, j = np.searchsorted(col, (lo, lo + COLUMNS))
        dense = np.zeros((len(na) + len(nb), min(COLUMNS, int(shared[-1]) + 1 - lo)), np.float32)
        dense[row[i:j], col[i:j] - lo] = 1
        common += (dense[: len(na)] @ dense[len(na) :].T).astype(np.int64)
    either = na[:, None] + nb[None] - common
    return np.nonzero(reaches(common, either, threshold))


class Forest:
    """Union of small integers, smallest root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


_OUT = [("node", pa.binary()), ("root", pa.binary()), ("links", pa.int64())]


def _verify(threshold: float, recall: float, depth: int):
    """Rows come sorted by (comp, tree, i, j, side).  side 0 and 1: the two blocks of a
    pair of blocks; a block against itself has side 0 only."""

    def side(rows: list[tuple]) -> Side:
        paths = np.stack([np.frombuffer(r[4], ">u2").reshape(-1, depth) for r in rows])
        return Side([r[2] for r in rows], np.array([r[3] for r in rows]), paths, [r[5] for r in rows])

    def group(rows: list[tuple]) -> Iterator[tuple]:
        a, b = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
        if len(rows) < 2 or not a:
            return
        a, same = side(a), not b
        b = a if same else side(b)
        for x in range(0, len(a), BLOCK):
            for y in range(x if same else 0, len(b), BLOCK):
                yield from pair(a.part(x, x + BLOCK), b.part(y, y + BLOCK), same and x == y, rows[0][0][1])

    def pair(left: Side, right: Side, same: bool, tree: int) -> Iterator[tuple]:
        i, j = candidates(left, right, tree, threshold, recall)
        if same:
            i, j = i[i < j], j[i < j]
        i, j = verified(left, right, i, j, threshold)
        if not len(i):
            return
        out_l, out_r = np.bincount(i, weights=right.copies[j], minlength=len(left)), np.bincount(j, weights=left.copies[i], minlength=len(right))
        names, shift = (left.node, 0) if same else (left.node + right.node, len(left))
        total = out_l + out_r if same else np.concatenate([out_l, out_r])
        forest = Forest(len(names))
        for u, v in zip(i.tolist(), j.tolist(), strict=True):
            forest.join(u, v + shift)
        for k in np.flatnonzero(total):
            yield names[k], names[forest.root(int(k))], int(total[k])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _OUT, strict=True)], names=[k for k, _ in _OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        key = None
        for b in batches:
            data, off, _ = string_parts(b.column("grams"))
            cols = {k: b.column(k).to_pylist() for k in ("comp", "tree", "i", "j", "side", "node", "copies", "paths")}
            for r in range(b.num_rows):
                k = (cols["comp"][r], cols["tree"][r], cols["i"][r], cols["j"][r])
                if k != key:
                    out += group(held)
                    held, key = [], k
                    if len(out) >= 8192:
                        yield batch(out)
                        out = []
                held.append((k, cols["side"][r], cols["node"][r], cols["copies"][r], cols["paths"][r], data[off[r] : off[r + 1]].copy().view(U)))
        out += group(held)
        if out:
            yield batch(out)

    return run


def _paths(nodes: DataFrame, trees: int, *more: str) -> DataFrame:
    """A row (tree, path, node) for each tree of each node."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    return nodes.select("node", "paths", *more, tree).select("tree", F.substring("paths", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("path"), "node", *more)


def _by_trie_nodes(wanted: DataFrame, trees: int, base: int) -> DataFrame:
    """wanted, with components of more than ``FEW_BLOCKS`` blocks dealt by the trie nodes at
    the base depth inside them, where that moves fewer sets than all pairs of blocks."""
    wide = wanted.filter(F.col("blocks") > FEW_BLOCKS)
    at = _paths(wide, trees, "comp").select("comp", "tree", F.xxhash64(F.substring("path", 1, 2 * base)).alias("bucket"), "node")
    met = at.groupBy("comp", "tree", "bucket").agg(F.count("*").alias("m")).filter("m > 1").withColumn("b", F.ceil(F.col("m") / BLOCK).cast("int"))
    cost = met.groupBy("comp").agg(F.sum(F.col("m") * F.col("b")).alias("moved"))
    cheap = wide.select("comp", "size", "blocks").distinct().join(cost, "comp").filter(F.col("moved") < F.col("size") * F.col("blocks")).select("comp")
    dealt = (
        at.join(met, ["comp", "tree", "bucket"]).join(cheap, "comp", "left_semi")
        .join(wide.select("node", "copies", "size", "paths", "rid", "rth"), "node")
        .select("node", "comp", "tree", "bucket", "copies", "size", F.col("b").alias("blocks"), "paths", "rid", "rth")
    )
    return wanted.join(cheap, "comp", "left_anti").select(*dealt.columns).unionByName(dealt)


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """-> doc_id, rid, rth, root, class_id (smallest id of the class), n_links (other
    documents whose similarity reaches the threshold).  rid, rth name the row (see
    row_keyed); root names the class, which class_id does not where ids repeat, and is null
    for a text without n-grams."""
    spark = documents.sparkSession
    docs = row_keyed(documents, id_col, text_col)
    base = int(forest_depth(threshold, trees, DEPTH, recall))
    signed = durable(docs.mapInArrow(_signatures(width, trees, DEPTH), "doc_id long, rid long, rth long, node binary, n int, paths binary"))
    nodes = durable(
        signed.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min(F.struct("rid", "rth")).alias("place"), F.min("paths").alias("paths"))
    )
    comps = connected(
        _paths(nodes, trees).repartition(parts(spark), "tree", F.substring("path", 1, 2 * base))
        .sortWithinPartitions("tree", F.substring("path", 1, 2 * base), "node").mapInArrow(_trie(base), "u binary, v binary").distinct()
    )
    size = comps.groupBy("root").agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    wanted = durable(
        comps.join(size, "root").join(nodes, "node")
        .select("node", F.col("root").alias("comp"), F.lit(-1).alias("tree"), F.lit(0).alias("bucket"), "copies", "size", "blocks", "paths", "place.rid", "place.rth")
    )
    if not wanted.filter(F.col("blocks") > FEW_BLOCKS).limit(1).isEmpty():
        wanted = _by_trie_nodes(wanted, trees, base)
    sets = (
        docs.select("rid", "rth", "text").join(wanted.withColumn("comp", F.struct("comp", "bucket")), ["rid", "rth"])
        .select("text", *_SET[:1], F.concat("comp.comp", F.hex("comp.bucket").cast("binary")).alias("comp"), *_SET[2:])
        .mapInArrow(_sets(width), "node binary, comp binary, tree int, copies long, blocks int, paths binary, grams binary")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (
        sets.withColumn("b", block).withColumn("o", other)
        .select("comp", "tree", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "node", "copies", "paths", "grams")
        .repartition(parts(spark), "comp", "tree", "i", "j")
        .sortWithinPartitions("comp", "tree", "i", "j", "side", "node")
    )
    found = durable(pairs.mapInArrow(_verify(threshold, recall, DEPTH), "node binary, root binary, links long"))
    roots = connected(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = nodes.select("node", "copies").join(counts, "node", "left").join(roots, "node", "left")
    info = info.select("node", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    rows = signed.select("doc_id", "rid", "rth", "node").join(info, "node", "left")
    least = rows.filter("node is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "root", "left").select(
        "doc_id", "rid", "rth", "root",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one_each(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, but of each class of near duplicates only the
    one with the smallest id (then hash of its text).  Rows without an id or without a word
    stay."""
    found = near_duplicates(documents, id_col=id_col, text_col=text_col).filter("doc_id is not null and root is not null")
    best = found.groupBy("root").agg(F.min(F.struct("rid", "rth")).alias("k")).select(F.col("k.rid").alias("a"), F.col("k.rth").alias("b"))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(row, F.col(id_col).cast("long").alias("a"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).select("row", "a", F.xxhash64("t").alias("b"), F.col("t").rlike(r"[^\x20\x09-\x0D]").alias("solid"))
    classed = F.col("a").isNotNull() & F.col("solid")
    one = keyed.filter(classed).join(best, ["a", "b"], "left_semi").dropDuplicates(["a", "b"])
    return one.select("row.*").unionByName(keyed.filter(~classed).select("row.*"))
