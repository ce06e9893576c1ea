"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns: each turn is 22 bytes, a digest of role and text and the
length of the text.  Paths are dealt to shards by ranges of (path, conversation), and all
prefixes of the splitters form the skeleton, a small trie that every task knows.  A node
outside the skeleton lies between two splitters, so one shard holds all of it.

A shard reads its paths in order and keeps only the nodes of the path at hand open: a node
is finished when the next path leaves it.  Nodes of the skeleton are finished in no shard;
each shard hands over its part of them (members, smallest member, children, leaves, savings,
ends), the parts are added up over the shards, and the skeleton is summed from its leaves to
its root.  As splitters contain conversations as well as paths, copies of one conversation
are dealt to many shards; their end node is then part of the skeleton.

Bounds: splitters take at most ``SPLIT_BYTES`` in all (longer ones are cut, which moves the
border but not the result), so the skeleton has at most ``SPLIT_BYTES / 22`` nodes.  A task
holds the open path and the finished children of the nodes on it.  A conversation is one row
of 22 bytes a turn, without its texts.  The digest of the members that end at one node is
sequential by its nature: their numbers stream through one task, in pieces.

Cases: rows without a conversation id are ignored; a null role or text is empty; a null turn
number comes first; turns of equal number are ordered by digest (repeated rows are repeated
turns); an empty table has no node, not even a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, hash_unit

STEP = 22
DIGEST = 16
SHARD_TURNS = 8192
MOST_SHARDS = 4096
SPLIT_BYTES = 8 << 20
SAMPLED = 16  # paths sampled for each shard
PIECE = 1 << 16


def turn_bytes(role: Column, text: Column) -> Column:
    """A turn in 44 hexadecimal digits: 128 bits of SHA-256 of role and text, and the text's bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    return F.concat(F.upper(digest), F.lpad(F.hex(F.octet_length(text).cast("long")), 2 * (STEP - DIGEST), "0"))


def paths(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """-> conv_id, path: the turns of each conversation, 22 bytes each."""
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), turn_bytes(F.col(role_col), F.col(text_col)).alias("t"))
    rows = rows.filter("conv_id is not null")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("has"), "turn", "t")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select("conv_id", F.unhex(F.array_join(F.col("turns.t"), "")).alias("path"))


def spliced(own: DataFrame, base: Column, head: Column) -> DataFrame:
    """own: as of ``paths``.  Each conversation's first ``head`` turns are replaced by those
    of conversation ``base`` (fewer if it has fewer, none if there is none)."""
    most = 1 << 30
    asked = own.select("conv_id", base.cast("long").alias("base"), head.cast("int").alias("head"), F.substring("path", head.cast("int") * STEP + 1, F.lit(most)).alias("rest"))
    # a conversation is the base of itself: only other ones are looked up
    heads = own.select(F.col("conv_id").alias("base"), F.col("path").alias("of"))
    wanted = asked.select("base").distinct()
    heads = heads.join(wanted, "base", "left_semi").select("base", F.substring("of", F.lit(1), F.lit(64 * STEP)).alias("of"))
    path = F.concat(F.coalesce(F.substring("of", F.lit(1), F.col("head") * STEP), F.lit(b"")), "rest")
    return asked.join(heads, "base", "left").select("conv_id", path.alias("path"))


@dataclass
class Skeleton:
    """splits: ascending (path, conversation); a shard holds what lies between two of them.
    children: for each node, its children in the skeleton by turn; node 0 is the root."""

    splits: list[tuple[bytes, int]]
    children: list[dict[bytes, int]]
    parent: list[int]
    depth: list[int]
    bytes_: list[int]

    @staticmethod
    def of(splits: list[tuple[bytes, int]]) -> Skeleton:
        s = Skeleton(splits, [{}], [-1], [0], [0])
        for path, _ in splits:
            at = 0
            for i in range(0, len(path), STEP):
                turn = path[i : i + STEP]
                if turn not in s.children[at]:
                    s.children[at][turn] = len(s.children)
                    s.children.append({})
                    s.parent.append(at)
                    s.depth.append(s.depth[at] + 1)
                    s.bytes_.append(text_bytes(turn))
                at = s.children[at][turn]
        return s


def text_bytes(turn: bytes) -> int:
    return int.from_bytes(turn[DIGEST:], "big")


def splitters(rows: DataFrame, *, shard_turns: int = SHARD_TURNS, most_shards: int = MOST_SHARDS) -> Skeleton | None:
    """rows: (conv_id, path).  Splitters come from about 16 paths a shard, by a hash."""
    n, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path") / F.lit(STEP)), F.lit(0.0))).first()
    if not n:
        return None
    shards = int(min(max(1, -(-(turns + n) // shard_turns)), most_shards, n))
    reach = max(1, SPLIT_BYTES // (STEP * shards))
    part = rows if n <= SAMPLED * shards else rows.filter(hash_unit(F.col("conv_id"), seed=13) < SAMPLED * shards / n)
    got = sorted((bytes(p), c) for p, c in part.select(F.substring("path", 1, STEP * reach), "conv_id").toLocalIterator())
    at = sorted({got[len(got) * i // shards] for i in range(1, shards)}) if got else []
    return Skeleton.of(at)


class Node:
    __slots__ = ("buffer", "children", "convs", "depth", "ends", "held", "leaves", "least", "own_bytes", "saved", "skeleton")

    def __init__(self, depth: int, own_bytes: int, skeleton: int):
        self.depth, self.own_bytes, self.skeleton = depth, own_bytes, skeleton
        self.convs = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None  # digest so far, or pieces of a skeleton node
        self.held: list[str] = []
        self.buffer: list[tuple] = []  # finished children that wait for the smallest member


NODE, BELOW, PART, ENDS = range(4)
_OUT = "kind int, sk int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, shard int, seq long, piece binary"
_FIELDS = [f.split()[0] for f in _OUT.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in _OUT.split(", ")]


class Shard:
    """The open path of a shard; ``out`` collects finished rows."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton, self.out = number, skeleton, []
        self.stack, self.path, self.seq = [Node(0, 0, 0)], b"", 0

    def add(self, path: bytes, conv: int) -> None:
        if path.startswith(self.path):
            same = len(self.path) // STEP
        else:
            same, least = 0, min(len(path), len(self.path))
            while (same + 1) * STEP <= least and path[same * STEP : (same + 1) * STEP] == self.path[same * STEP : (same + 1) * STEP]:
                same += 1
        while len(self.stack) > same + 1:
            self.close()
        for i in range(same * STEP, len(path), STEP):
            turn, above = path[i : i + STEP], self.stack[-1]
            known = self.skeleton.children[above.skeleton].get(turn, -1) if above.skeleton >= 0 else -1
            self.stack.append(Node(above.depth + 1, text_bytes(turn), known))
        self.path = path
        node = self.stack[-1]
        node.convs += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton >= 0:
            node.held.append(str(conv))
            if len(node.held) >= PIECE // 8:
                self.hand_over(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv).encode())
        else:
            node.ends.update(b",%d" % conv)

    def hand_over(self, node: Node) -> None:
        self.out.append((ENDS, node.skeleton, None, None, None, None, None, None, None, None, self.number, self.seq, ",".join(node.held).encode()))
        self.seq += 1
        node.held = []

    def close(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.convs += node.convs
            above.least = node.least if above.least is None else min(above.least, node.least)
        if node.skeleton >= 0:
            if node.held:
                self.hand_over(node)
            self.out.append((PART, node.skeleton, node.least, None, None, node.convs, node.children, node.leaves, node.saved, None, self.number, None, None))
            return
        for c in node.buffer:
            self.out.append((NODE, None, *c[:2], node.least, *c[2:], self.number, None, None))
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.convs - 1) * node.own_bytes
        done = (node.least, node.depth, node.convs, node.children, leaves, saved, (node.ends or hashlib.sha256()).hexdigest())
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        if above.skeleton >= 0:
            self.out.append((BELOW, above.skeleton, *done[:2], None, *done[2:], self.number, None, None))
        else:
            above.buffer.append(done)

    def finish(self) -> None:
        while self.stack:
            self.close()


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_FIELDS)


def _deal(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            splits = shared.value.splits
            at = [bisect_right(splits, k) for k in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b.column("conv_id"), b.column("path")], names=["shard", "conv_id", "path"])

    return run


def _grow(shared):
    """Rows come sorted by (shard, path, conv_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for b in batches:
            for number, conv, path in zip(*(b.column(n).to_pylist() for n in ("shard", "conv_id", "path")), strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.finish()
                        yield _table(shard.out)
                    shard = Shard(number, shared.value)
                shard.add(path, conv)
                if len(shard.out) >= 8192:
                    yield _table(shard.out)
                    shard.out = []
        if shard is not None:
            shard.finish()
            if shard.out:
                yield _table(shard.out)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sk, piece) come sorted by (sk, shard, seq)."""
    sk, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sk], pa.int32()), pa.array([digest.hexdigest()])], names=["sk", "ends_sha256"])

    for b in batches:
        for k, piece in zip(b.column("sk").to_pylist(), b.column("piece").to_pylist(), strict=True):
            if k != sk:
                if sk is not None:
                    yield done()
                sk, digest = k, hashlib.sha256(piece)
            else:
                digest.update(b",")
                digest.update(piece)
    if sk is not None:
        yield done()


def _summed(skeleton: Skeleton, parts: list) -> list[tuple]:
    """Skeleton nodes from the sums of their parts: (sk, conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens).  parts: (sk, least, n, children, leaves, saved)."""
    got = {p[0]: list(p[1:]) for p in parts}
    order = sorted(got, key=lambda k: -skeleton.depth[k])
    for k in order:
        got[k][2] += sum(c in got for c in skeleton.children[k].values())
    for k in order:
        least, n, children, leaves, saved = got[k]
        got[k][3] = leaves if children else 1
        got[k][4] = saved + (n - 1) * skeleton.bytes_[k]
        if k:
            up = got[skeleton.parent[k]]
            up[3] += got[k][3]
            up[4] += got[k][4]
    return [(k, v[0], skeleton.depth[k], got[skeleton.parent[k]][0] if k else None, *v[1:]) for k, v in got.items()]


def build(rows: DataFrame, *, shard_turns: int = SHARD_TURNS, most_shards: int = MOST_SHARDS) -> DataFrame:
    """rows: (conv_id, path), one for each conversation, as of ``paths`` -> one row for each
    distinct prefix: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    rows = durable(rows.select("conv_id", "path"))
    skeleton = splitters(rows, shard_turns=shard_turns, most_shards=most_shards)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    if skeleton is None:
        return spark.createDataFrame([], ", ".join(f for f in _OUT.split(", ") if f.split()[0] in columns)).select(columns)
    shared = spark.sparkContext.broadcast(skeleton)
    dealt = rows.mapInArrow(_deal(shared), "shard int, conv_id long, path binary")
    sorted_ = dealt.repartitionById(len(skeleton.splits) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    grown = durable(sorted_.mapInArrow(_grow(shared), _OUT))
    # one row for each node of the skeleton, so at most SPLIT_BYTES / 22
    sums = grown.filter(F.col("kind") == PART).groupBy("sk").agg(F.min("conv_id"), *(F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))).collect()
    top = spark.createDataFrame(_summed(skeleton, [tuple(r) for r in sums]), "sk int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    pieces = grown.filter(F.col("kind") == ENDS).select("sk", "shard", "seq", "piece").repartition("sk").sortWithinPartitions("sk", "shard", "seq")
    ends = pieces.select("sk", "piece").mapInArrow(_digests, "sk int, ends_sha256 string")
    none = F.lit(hashlib.sha256().hexdigest())
    upper = top.join(ends, "sk", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)).select(columns)
    parents = F.broadcast(top.select("sk", F.col("conv_id").alias("of")))
    lower = grown.filter(F.col("kind").isin(NODE, BELOW)).join(parents, "sk", "left").withColumn("parent_conv_id", F.coalesce("of", "parent_conv_id")).select(columns)
    return lower.unionByName(upper)
