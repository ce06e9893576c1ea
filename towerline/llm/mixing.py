"""Mixing documents towards target domain weights, with DataFrame functions only.

1. A labelled table names the domain of some documents.  A naive Bayes classifier over the
   presence of words and of binned structure statistics is counted by Spark on about
   ``sample_rows`` labelled rows; the ``vocabulary`` tokens that tell most enter it.
2. Every document gets its posterior of each domain (soft membership) and its tokens.
3. Rates r of documents shall be at least 0 (at most ``max_rate``, if given) and shall make
   sum(r * tokens * posterior) equal to the target of each domain, or come nearest to it.
   From rate 1, projected gradient steps for the squared gap move each rate by
   ``posterior . step`` and project it on its bounds; rates at a bound that the gradient
   pushes against stay.  A step is scaled by the inverse of the domains' Gram matrix over
   the rates that are free to move.  Rates lie in a table; an iteration is two aggregations
   over it and a write.
4. A document gets floor(rate + u) copies, with u uniform from a hash of id and text.

Cases: null text has no tokens and rate 1; documents with a null id are classified like
others (labels never match them); a label row without a document, a null label, or more
labels for one id (the smallest domain counts) do no harm; without any labels there is one
domain and every rate is target / tokens (1 by default); more than ``MOST_DOMAINS`` domains
raise a ValueError; other columns pass through ``resample``, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, hash_unit

SAMPLE_ROWS = 20_000
VOCABULARY = 192
ITERATIONS = 40
#: Lengths of a scaled step that are tried.
PARTS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01)
TOLERANCE = 1e-7
MOST_DOMAINS = 64
LEAST_DOCS = 5
#: A sign enters the vocabulary if some domain holds it so many times as often as all do.
TELLING = 2.0
#: ... and by so many standard deviations more often than if it were spread evenly.
SIGNIFICANT = 6.0


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")


def _bin(name: str, share: Column, scale: float) -> Column:
    return F.concat(F.lit(f"\x01{name}"), F.least(F.floor(share * scale), F.lit(9)).cast("string"))


def signs(text: Column, words: Column) -> Column:
    """Distinct words (cut at common punctuation, lower case) and binned statistics as tokens."""
    n = F.greatest(F.size(words), F.lit(1))
    stats = F.array(
        _bin("symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")) / n, 10),
        _bin("upper", F.regexp_count(text, F.lit("[A-Z]")) / n, 3),
        _bin("distinct", F.size(F.array_distinct(words)) / n, 10),
        _bin("size", F.log2(n.cast("double")), 0.5),
    )
    return F.concat(F.split(F.lower(text), r"[\x20\x09-\x0D.,;:!?]+"), stats)


@dataclass
class Domains:
    """Weights of a naive Bayes classifier; by_token[i][k] belongs to vocabulary[i]."""

    names: list[str]
    vocabulary: list[str]
    prior: list[float]
    by_token: list[list[float]]

    def places(self, found: Column) -> Column:
        """Places in the vocabulary of a text's signs, from 1."""
        if not self.vocabulary:
            return F.array().cast("array<int>")
        known = F.array(*map(F.lit, self.vocabulary))
        return F.transform(F.array_intersect(known, found), lambda t: F.array_position(known, t).cast("int"))

    def with_posterior(self, rows: DataFrame, places: str, name: str) -> DataFrame:
        """rows with an array of a probability for each domain instead of the places.

        The steps are selects of their own, so that none is worked out more than once."""
        held = [c for c in rows.columns if c != places]
        keep = [F.col(f"`{c}`") for c in held]

        def score(k: int) -> Column:
            weights = F.array(*[F.lit(float(t[k])) for t in self.by_token]) if self.by_token else F.array(F.lit(0.0))
            return F.aggregate(F.col(places), F.lit(float(self.prior[k])), lambda s, i: s + F.element_at(weights, i))

        ks = range(len(self.names))
        rows = rows.select(*keep, *[score(k).alias(f"__s{k}") for k in ks])
        top = F.array_max(F.array(*[F.col(f"__s{k}") for k in ks]))
        rows = rows.select(*keep, *[F.col(f"__s{k}") for k in ks], top.alias("__top"))
        rows = rows.select(*keep, *[F.exp(F.col(f"__s{k}") - F.col("__top")).alias(f"__e{k}") for k in ks])
        total = sum((F.col(f"__e{k}") for k in ks), F.lit(0.0))
        rows = rows.select(*keep, *[F.col(f"__e{k}") for k in ks], total.alias("__sum"))
        # out of a generator, so that no filter above is pushed below and repeats the steps
        return rows.select(*keep, F.explode(F.array(F.array(*[F.col(f"__e{k}") / F.col("__sum") for k in ks]))).alias(name))


def fit_domains(documents: DataFrame, labels: DataFrame, domain: Column, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> Domains:
    named = labels.select(F.col(id_col).alias("id"), domain.cast("string").alias("domain")).filter("id is not null and domain is not null").groupBy("id").agg(F.min("domain").alias("domain"))
    total = named.count()
    if total > sample_rows:
        named = named.filter(hash_unit(F.col("id"), seed=6) < sample_rows / total)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = durable(documents.select(F.col(id_col).alias("id"), text.alias("text")).join(named, "id").select("domain", signs(F.col("text"), tokens(F.col("text"))).alias("signs")))
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).orderBy("domain").limit(MOST_DOMAINS + 1).collect()}
    names = sorted(sizes)
    if len(names) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    if len(names) < 2:
        return Domains(names or ["all"], [], [0.0], [])
    n = [float(sizes[k]) for k in names]
    counts = rows.select("domain", F.explode(F.array_distinct("signs")).alias("sign")).groupBy("sign").agg(*[F.count_if(F.col("domain") == k).cast("double").alias(f"n{i}") for i, k in enumerate(names)])
    share = [(F.col(f"n{i}") + 0.5) / (n[i] + 1.0) for i in range(len(names))]
    overall = (sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0.0)) + 0.5) / (sum(n) + 1.0)
    more = [F.ln(s / overall) for s in share]
    surplus = [(F.col(f"n{i}") - overall * n[i]) / F.sqrt(overall * n[i]) for i in range(len(names))]
    tells = F.array_max(F.array(*[F.when((m >= math.log(TELLING)) & (z >= SIGNIFICANT), m * s).otherwise(0.0) for m, s, z in zip(more, share, surplus, strict=True)]))
    seen = sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0.0))
    best = counts.withColumn("tells", tells).filter((seen >= LEAST_DOCS) & (F.col("tells") > 0)).orderBy(F.desc("tells"), "sign").limit(vocabulary).collect()
    prior = [math.log(x / sum(n)) for x in n]
    weights = []
    for r in best:
        p = [(r[f"n{i}"] + 0.5) / (n[i] + 1.0) for i in range(len(names))]
        weights.append([math.log(x) - math.log(1 - x) for x in p])
        for i, x in enumerate(p):
            prior[i] += math.log(1 - x)
    return Domains(names, [r["sign"] for r in best], prior, weights)


@dataclass
class Step:
    """A projected step: every rate moves by ``posterior . move``, but for those that are at
    a bound and that the gap pushes against it."""

    gap: list[float]
    move: list[float]


def _dot(posterior: list[Column], v) -> Column:
    return sum((p * F.lit(float(x)) for p, x in zip(posterior, v, strict=True)), F.lit(0.0))


def _held(r: Column, along: Column, most: float) -> Column:
    return ((r >= most) & (along >= 0)) | ((r <= 0) & (along <= 0))


def _moved(r: Column, along: Column, by: Column, most: float) -> Column:
    return F.when(_held(r, along, most), r).otherwise(F.least(F.greatest(r + by, F.lit(0.0)), F.lit(most)))


def rate(posterior: Column, steps: list[Step], max_rate: float | None) -> Column:
    """The rate of a document after all steps."""
    most = math.inf if max_rate is None else float(max_rate)
    start = F.lit(min(1.0, most))
    if not steps:
        return start
    p = [F.element_at(posterior, i + 1) for i in range(len(steps[0].gap))]
    taken = F.array(*[F.struct(_dot(p, s.gap).alias("along"), _dot(p, s.move).alias("by")) for s in steps])
    return F.aggregate(taken, start, lambda r, s: _moved(r, s["along"], s["by"], most))


def fit_rates(table: DataFrame, targets: list[float], *, max_rate: float | None = None, iterations: int = ITERATIONS) -> list[Step]:
    """table: (__tokens, __posterior) -> the steps that take all rates from 1 to the least
    squared gap.

    Each iteration scales the gradient by the inverse of the domains' Gram matrix over the
    rates that are free to move, tries several lengths of that step and of the plain
    gradient step in one aggregation, and takes the best."""
    k, most = len(targets), math.inf if max_rate is None else float(max_rate)
    goal, steps = np.array(targets, float), []
    scale = max(goal.sum(), 1.0)
    t, p, r = F.col("__tokens").cast("double"), [F.element_at("__posterior", i + 1) for i in range(k)], F.col("__r")

    def gaps(rows: DataFrame, rates: list[Column]) -> list[np.ndarray]:
        got = rows.agg(*[F.sum(x * t * q).alias(f"s{n}_{i}") for n, x in enumerate(rates) for i, q in enumerate(p)]).first()
        return [goal - np.array([got[f"s{n}_{i}"] or 0.0 for i in range(k)]) for n in range(len(rates))]

    now = table.select("__tokens", "__posterior", F.lit(min(1.0, most)).alias("__r"))
    gap = gaps(now, [r])[0]
    for _ in range(iterations):
        if np.linalg.norm(gap) / scale < TOLERANCE:
            break
        along = _dot(p, gap)
        free = F.when(_held(r, along, most), 0.0).otherwise(t)
        got = now.select(free.alias("__f"), "__posterior").agg(*[F.sum(F.col("__f") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
        gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        longest = float(np.linalg.eigvalsh(gram)[-1])
        if longest <= 0:
            break
        scaled = np.linalg.pinv(gram, rcond=1e-10) @ gap
        tries = [part * scaled for part in PARTS] + [part * gap / longest for part in (1.0, 4.0, 16.0)]
        left = gaps(now, [_moved(r, along, _dot(p, m), most) for m in tries])
        best = int(np.argmin([np.linalg.norm(x) for x in left]))
        if np.linalg.norm(left[best]) > np.linalg.norm(gap) * (1 - 1e-6):
            break
        steps.append(Step(gap.tolist(), tries[best].tolist()))
        now = durable(now.select("__tokens", "__posterior", _moved(r, along, _dot(p, tries[best]), most).alias("__r")))
        gap = left[best]
    return steps


def memberships(documents: DataFrame, domains: Domains, *, text_col: str = "text", columns: dict[str, Column]) -> DataFrame:
    """The columns, __tokens (their number) and __posterior of each document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = [F.col(f"`{c}`") for c in columns]
    rows = documents.select(*[c.alias(k) for k, c in columns.items()], tokens(text).alias("__w"), text.alias("__t"))
    rows = rows.select(*held, F.size("__w").cast("long").alias("__tokens"), signs(F.col("__t"), F.col("__w")).alias("__signs"))
    rows = rows.select(*held, "__tokens", domains.places(F.col("__signs")).alias("__at"))
    return domains.with_posterior(rows, "__at", "__posterior")


def even_targets(table: DataFrame, k: int, power: float = 0.5) -> list[float]:
    """Shares in proportion to a power of the expected shares, with the same total."""
    got = table.agg(*[F.sum(F.col("__tokens") * F.element_at("__posterior", i + 1)).alias(f"s{i}") for i in range(k)]).first()
    now = np.array([got[f"s{i}"] or 0.0 for i in range(k)])
    flat = now**power
    return list(flat / max(flat.sum(), 1e-12) * now.sum())


def copies(r: Column, doc_id: Column, text: Column) -> Column:
    return F.floor(r + hash_unit(doc_id, text, seed=66)).cast("int")


def mix(documents: DataFrame, labels: DataFrame, domain: Column, *, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", max_rate: float | None = None) -> DataFrame:
    """-> doc_id, n_tokens, domain (the likeliest), posterior, rate, copies.

    targets: tokens wanted of each domain (default: :func:`even_targets`)."""
    domains = fit_domains(documents, labels, domain, id_col=id_col, text_col=text_col)
    u = hash_unit(F.col(id_col), F.col(text_col), seed=66)
    table = durable(memberships(documents, domains, text_col=text_col, columns={"doc_id": F.col(id_col), "u": u}))
    goal = even_targets(table, len(domains.names)) if targets is None else [targets.get(k, 0.0) for k in domains.names]
    steps = fit_rates(table, goal, max_rate=max_rate)
    names = F.array(*map(F.lit, domains.names))
    top = F.element_at(names, F.array_position("__posterior", F.array_max("__posterior")).cast("int"))
    fitted = F.when(F.col("__tokens") == 0, 1.0).otherwise(rate(F.col("__posterior"), steps, max_rate))
    return table.withColumn("rate", fitted).select(
        "doc_id", F.col("__tokens").alias("n_tokens"), top.alias("domain"), F.col("__posterior").alias("posterior"), "rate", F.floor(F.col("rate") + F.col("u")).cast("int").alias("copies")
    )


def resample(documents: DataFrame, labels: DataFrame, domain: Column, *, keep: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, thinned so that each domain named in ``keep``
    holds that part of its expected tokens and others stay whole (no rate above 1)."""
    domains = fit_domains(documents, labels, domain, id_col=id_col, text_col=text_col)
    table = durable(memberships(documents, domains, text_col=text_col, columns={}))
    now = even_targets(table, len(domains.names), 1.0)
    goal = [n * keep.get(k, 1.0) for k, n in zip(domains.names, now, strict=True)]
    steps = fit_rates(table, goal, max_rate=1.0)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])  # packed, so that no name clashes
    rows = memberships(documents, domains, text_col=text_col, columns={"__row": row})
    r = F.when(F.col("__tokens") == 0, 1.0).otherwise(rate(F.col("__posterior"), steps, 1.0))
    return rows.filter(copies(r, F.col(f"__row.`{id_col}`"), F.col(f"__row.`{text_col}`")) >= 1).select("__row.*")
