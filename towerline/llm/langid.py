"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of up to ``order - 1`` bytes with escape probabilities,
frozen after training; a text gets the exact length of its code under each of them, and
the shortest wins.  The trees are fitted on a sample of the training rows: about
``sample_bytes`` of text for each language, chosen by a hash of the id, whole texts only.
What is broadcast is bounded by ``sample_bytes`` n-grams for each language.

Cases: null texts and texts without a letter give ``und`` with score 0; so does an empty
training set; ties go to the language first in order; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import chunks
from .common import hash_unit
from .ngrams import Scorer, by_group, counter, keys, partial_matching


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", order: int = 4, sample_bytes: int = 2_000_000) -> tuple[list[str], Scorer]:
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).filter("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    share = F.least(F.lit(1.0), F.lit(float(sample_bytes)) / F.greatest(F.col("bytes"), F.lit(1)))
    chosen = rows.join(F.broadcast(sizes), "lang").filter(hash_unit(F.col("id"), seed=2) < share).select("lang", "text")
    counts = chosen.mapInArrow(counter(order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, models = [], []
    for lang, grams, n in by_group(counts):
        langs.append(lang)
        models.append(partial_matching(grams, n, order))
    return langs, Scorer(models, order)


def _predict(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, scorer = broadcast.value
        for c in chunks(batches):
            keep = [c.batch.column(i) for i, f in enumerate(c.batch.schema) if f.name not in ("text", "has_letter")]
            names = [f.name for f in c.batch.schema if f.name not in ("text", "has_letter")]
            pred = np.full(c.rows, "und", object)
            score = np.zeros(c.rows)
            letter = c.batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            if langs and letter.any():
                total = np.zeros((len(c.data) + 1, len(langs)))
                np.cumsum(scorer(keys(c, scorer.order)), axis=0, out=total[1:])
                length = -(total[c.offsets[1:]] - total[c.offsets[:-1]])
                best = np.argmin(length, 1)
                weight = np.exp(-(length - length.min(1, keepdims=True)))
                share = weight[np.arange(c.rows), best] / weight.sum(1)
                pred[letter] = np.array(langs, object)[best][letter]
                score[letter] = share[letter]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(pred, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return run


def predict(documents: DataFrame, langs: list[str], scorer: Scorer, *, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """-> doc_id, the extra columns, lang_pred, score (share of the winner)."""
    extra = extra or {}
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        *[c.alias(k) for k, c in extra.items()],
        F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    kinds = "".join(f", {k} {t}" for k, t in rows.dtypes if k in extra)
    shared = documents.sparkSession.sparkContext.broadcast((langs, scorer))
    return rows.mapInArrow(_predict(shared), f"doc_id {dict(rows.dtypes)['doc_id']}{kinds}, lang_pred string, score double")
