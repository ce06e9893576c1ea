"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A text is a sparse vector: hashed words (damped counts, scaled to length 1), structure
statistics and its length.  The score is the logistic of a linear part and of all pairwise
interactions of rank ``rank``, taken in linear time: half the square of the sum of the
factors minus the sum of their squares.

The machine is fitted on at most about ``sample_rows`` labelled rows, chosen by a hash of
the id; its size is fixed by ``buckets`` and ``rank``.

Cases: null text counts as empty; empty texts are scored from their statistics; without
labelled rows every score is 0.5; labels other than 0 and 1, and null ones, are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import U, Chunk, Prefix, chunks, row_of, words
from .common import hash_unit
from .textstats import DIGIT, PUNCT, UPPER, base_counts, per_row

BUCKETS = 1 << 13
RANK = 8
SAMPLE_ROWS = 5000


def features(c: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the hashed words, in order of rows, and the statistics."""
    w = words(c)
    counts = base_counts(c, w)
    row = row_of(w.first)
    bucket = (Prefix(c.data).of(w.start, w.end) >> U(20)).astype(np.int64) % buckets
    key, n = np.unique(row * buckets + bucket, return_counts=True)
    row, bucket = key // buckets, key % buckets
    value = np.log1p(n)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=c.rows))
    value = (value / norm[row]).astype(np.float32)
    size, nw = np.diff(c.offsets), counts["n_words"]
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(nw, 1)
    stats = np.stack(
        [
            np.log1p(nw),
            np.log1p(size),
            counts["word_chars"] * per_word / 10,
            counts["n_symbols"] * per_word,
            np.log1p(counts["n_dup_lines"]),
            counts["n_repeat_words"] * per_word,
            np.bincount(row, minlength=c.rows) * per_word,
            per_row(UPPER[c.data], c.offsets) * per_byte * 10,
            per_row(DIGIT[c.data], c.offsets) * per_byte * 10,
            per_row(PUNCT[c.data], c.offsets) * per_word,
        ],
        1,
    )
    return row, bucket, value, stats.astype(np.float32)


class Machine:
    def __init__(self, buckets: int, stats: int, rank: int):
        rng = np.random.default_rng(0)
        n = buckets + stats
        self.buckets = buckets
        self.bias = np.float32(0)
        self.w = np.zeros(n, np.float32)
        self.v = rng.normal(0, 0.02, (n, rank)).astype(np.float32)
        self.mean, self.scale = np.zeros(stats, np.float32), np.ones(stats, np.float32)

    def sparse(self, rows: int, row, bucket, value, stats):
        """The statistics join the words as further features of each row."""
        z = np.clip((stats - self.mean) / self.scale, -4, 4) * 0.3
        k = stats.shape[1]
        r = np.concatenate([row, np.repeat(np.arange(rows), k)])
        f = np.concatenate([bucket, np.tile(np.arange(k) + self.buckets, rows)])
        x = np.concatenate([value, z.ravel().astype(np.float32)])
        o = np.argsort(r, kind="stable")
        return r[o], f[o], x[o]

    def parts(self, rows: int, r, f, x):
        at = np.searchsorted(r, np.arange(rows))
        vx = self.v[f] * x[:, None]
        total = np.add.reduceat(vx, at, axis=0)
        squares = np.add.reduceat(vx * vx, at, axis=0)
        linear = np.add.reduceat(self.w[f] * x, at)
        return self.bias + linear + 0.5 * (total * total - squares).sum(1), total, vx

    def score(self, rows: int, *feat) -> np.ndarray:
        z = self.parts(rows, *self.sparse(rows, *feat))[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def fit(self, examples: list[tuple], labels: np.ndarray, epochs: int = 12, size: int = 128, rate: float = 0.03, decay: float = 1e-5):
        stats = np.stack([e[2] for e in examples])
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-3
        rng = np.random.default_rng(1)
        params = [self.w, self.v]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        self.bias = np.float32(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for i in range(0, len(order), size):
                pick = order[i : i + size]
                rows = len(pick)
                row = np.repeat(np.arange(rows), [len(examples[j][0]) for j in pick])
                r, f, x = self.sparse(rows, row, np.concatenate([examples[j][0] for j in pick]), np.concatenate([examples[j][1] for j in pick]), stats[pick])
                z, total, vx = self.parts(rows, r, f, x)
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / rows).astype(np.float32)
                gx = g[r] * x
                n = len(self.w)
                grads = [np.bincount(f, gx, n).astype(np.float32) + decay * self.w]
                gv = gx[:, None] * (total[r] - vx)
                grads.append(np.stack([np.bincount(f, gv[:, k], n) for k in range(self.v.shape[1])], 1).astype(np.float32) + decay * self.v)
                step += 1
                for p, d, a, b in zip(params, grads, first, second, strict=True):
                    a += 0.1 * (d - a)
                    b += 0.01 * (d * d - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
                self.bias -= np.float32(0.02 * g.sum())
        return self


def _extract(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            row, bucket, value, stats = features(c, buckets)
            cut = np.searchsorted(row, np.arange(c.rows + 1))
            cols = [[a[cut[i] : cut[i + 1]].astype(t).tobytes() for i in range(c.rows)] for a, t in ((bucket, np.int32), (value, np.float32))]
            yield pa.RecordBatch.from_arrays(
                [c.batch.column("label"), *(pa.array(x, pa.binary()) for x in cols), pa.array([s.tobytes() for s in stats], pa.binary())], names=["label", "f", "x", "s"]
            )

    return run


def fit(labelled: DataFrame, *, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id", buckets: int = BUCKETS, rank: int = RANK, sample_rows: int = SAMPLE_ROWS) -> Machine | None:
    """labelled: rows with text and a label 0 or 1."""
    rows = labelled.select(F.col(label_col).cast("int").alias("label"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("id")).filter("label in (0, 1)")
    total = rows.count()
    if total > sample_rows:
        rows = rows.filter(hash_unit(F.col("id"), seed=10) < sample_rows / total)
    got = rows.select("label", "text", "id").mapInArrow(_extract(buckets), "label int, f binary, x binary, s binary").toArrow().to_pandas()
    if not len(got):
        return None
    got = got.sort_values(["s", "label"], kind="stable")
    examples = [(np.frombuffer(f, np.int32), np.frombuffer(x, np.float32), np.frombuffer(s, np.float32)) for f, x, s in zip(got["f"], got["x"], got["s"], strict=True)]
    return Machine(buckets, len(examples[0][2]), rank).fit(examples, got["label"].to_numpy().astype(np.float32))


def predict(documents: DataFrame, machine: Machine | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> doc_id, score (0 to 1, higher: label 1 is likelier)."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if machine is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for c in chunks(batches):
            score = m.score(c.rows, *features(c, m.buckets))
            yield pa.RecordBatch.from_arrays([c.batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
