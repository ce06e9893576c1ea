"""Toxicity: a lexicon trie met by Levenshtein automata, weighed by context windows.

**Lexicon.**  Words that labelled toxic texts hold far more often than others (texts that are
equal count once): log odds less their standard error of ``ODDS``, at most ``TERMS`` words.

**Matching.**  The distinct words of a chunk walk the trie of the lexicon together.  The state
of a word at a trie node is the row of its Levenshtein automaton: the edit distances between
the node's prefix and the prefixes of the word that are within reach of it.  A word leaves
when its automaton is dead (every entry above the most edits), so a subtree is entered by
the few words that can still match below it.  Terms of fewer than 4 letters match exactly,
those below 8 within one edit, longer ones within two.

**Context.**  The words around a match say how likely it is mentioned and not used:
quotation marks open before it, words of reporting before it, denial before it; address
(second person) speaks for use.  A match counts for its abuse part and, apart, for its quoted
part, so that the model can weigh them differently.

**Score.**  A logistic model over both parts of the matches by distance, their density, and a
weight for each term and distance, fitted on the same labelled texts.  The weight of quoted
matches starts below that of abuse and moves only as far as labels ask.

Labels are read from at most about ``sample_rows`` texts, chosen by a hash of the id.
Everything else covers whole texts of all documents.

Cases: a null text is empty; empty texts, and those without a match, get the score of no
match; without labels of both kinds every score is 0; labels other than 0 and 1, and null
ones, are not used; repeated ids keep a row each; a null id keeps its row; empty tables give
no rows; further columns are ignored; words longer than the longest term can reach are
passed by, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import Chunk, Prefix, chunks, row_of, words
from .common import hash_unit

SAMPLE_ROWS = 8_000
TERMS = 300
LONGEST = 32  # letters of a term
MIN_TEXTS = 4
ODDS = 2.75  # log odds of a term, less their standard error
MATCHED = 2048  # words that go down the trie together
HELD = 1 << 20  # words whose match a task remembers
WINDOW = 6
#: Fixed cues (lower case, in the languages at hand).
REPORTING = frozenset("said says say wrote writes called calls quoted quote word term reported reports dit disait écrit mot appelé sagte sagt schrieb wort nannte dijo dice escribió palabra llamó".split())
DENIAL = frozenset("not never no don't ne pas jamais nicht kein keine nie nunca jamás".split())
ADDRESS = frozenset("you your you're u tu te toi vous votre du dich dir ihr euch sie usted ustedes eres vos".split())
OPENING = ("\"", "“", "«", "„", "‘", "'", "‹")
CLOSING = ("\"", "”", "»", "“", "’", "'", "›")


def most_edits(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


@dataclass
class Trie:
    """Nodes in order of depth first: letter, children, and the term that ends there."""

    terms: list[str]
    letter: list[int] = field(default_factory=lambda: [0])
    children: list[list[int]] = field(default_factory=lambda: [[]])
    term: list[int] = field(default_factory=lambda: [-1])
    reach: list[int] = field(default_factory=lambda: [0])  # most edits of the terms below

    def __post_init__(self):
        known: list[dict[str, int]] = [{}]
        for i, t in enumerate(self.terms):
            at, edits = 0, most_edits(len(t))
            self.reach[0] = max(self.reach[0], edits)
            for ch in t:
                if ch not in known[at]:
                    known[at][ch] = len(known)
                    self.children[at].append(len(known))
                    known.append({})
                    self.letter.append(ord(ch))
                    self.children.append([])
                    self.term.append(-1)
                    self.reach.append(0)
                at = known[at][ch]
                self.reach[at] = max(self.reach[at], edits)
            self.term[at] = i

        sizes = [len(c) for c in self.children]
        self.fan = np.array(sizes)
        self.begin = np.cumsum([0, *sizes])[:-1]
        self.below = np.array([c for cs in self.children for c in cs], np.int64)
        self.letters, self.ends, self.reaches = np.array(self.letter, np.uint32), np.array(self.term), np.array(self.reach, np.uint8)
        self.allowed = np.array([most_edits(len(t)) for t in self.terms], np.uint8)
        # sizes of words that can match a term below a node; children come after their node
        low, high = np.full(len(sizes), 1 << 30), np.full(len(sizes), -1)
        for node in reversed(range(len(sizes))):
            own = [(len(t) - most_edits(len(t)), len(t) + most_edits(len(t))) for t in [self.terms[self.term[node]]]] if self.term[node] >= 0 else []
            spans = own + [(low[c], high[c]) for c in self.children[node]]
            low[node], high[node] = min((a for a, _ in spans), default=1 << 30), max((b for _, b in spans), default=-1)
        self.low, self.high = low, high

    @property
    def longest(self) -> int:
        return max((len(t) + most_edits(len(t)) for t in self.terms), default=0)

    def match(self, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """letters: code points of words in rows, 0 beyond their end -> (word, term, distance)
        of every pair within the term's most edits.  Goes down the trie by levels: at each,
        the pairs of a node and a word whose automaton is alive there."""
        parts = [self._match(letters[i : i + MATCHED], sizes[i : i + MATCHED]) for i in range(0, len(letters), MATCHED)]
        out = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3)]
        out[0] = out[0] + np.repeat(np.arange(len(parts)) * MATCHED, [len(p[0]) for p in parts])
        return out[0], out[1], out[2]

    def _match(self, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = int(self.allowed.max(initial=0))
        width, none = 2 * d + 1, np.uint8(d + 1)
        padded = np.zeros((len(letters), letters.shape[1] + 2 * width), np.uint32)
        padded[:, width : width + letters.shape[1]] = letters  # padded[:, width + p]: letter p
        words_, terms_, dists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        node, word = np.zeros(len(letters), np.int64), np.arange(len(letters))
        # band[:, j]: distance of the node's prefix (depth t) from the word's prefix of t - d + j
        band = np.broadcast_to(np.where(np.arange(width) >= d, np.arange(width) - d, none).astype(np.uint8), (len(letters), width))
        places, t = np.arange(width), 0
        while len(word):
            fan = self.fan[node]
            of = np.repeat(np.arange(len(node)), fan)
            child = self.below[np.repeat(self.begin[node] - np.cumsum(fan) + fan, fan) + np.arange(len(of))]
            size = sizes[word[of]]
            fits = (size >= self.low[child]) & (size <= self.high[child])
            of, child, size, t = of[fits], child[fits], size[fits], t + 1
            word, old = word[of], band[of]
            # both step on; the node's letter is missing in the word; the word has one more
            new = old + (padded[word, t - d - 1 + width : t + d + width] != self.letters[child][:, None])
            np.minimum(new[:, :-1], old[:, 1:] + np.uint8(1), out=new[:, :-1])
            new[(t - d + places < 0)[None] | (t - d + places > size[:, None])] = none
            for j in range(1, width):
                np.minimum(new[:, j], new[:, j - 1] + np.uint8(1), out=new[:, j])
            new[t - d + places > size[:, None]] = none
            np.minimum(new, none, out=new)
            at = size - t + d
            hit = np.flatnonzero((self.ends[child] >= 0) & (at >= 0) & (at < width))
            term, dist = self.ends[child[hit]], new[hit, at[hit]]
            ok = dist <= self.allowed[term]
            words_.append(word[hit[ok]])
            terms_.append(term[ok])
            dists.append(dist[ok].astype(np.int64))
            live = new.min(1, initial=none) <= self.reaches[child]
            node, word, band = child[live], word[live], new[live]
        return np.concatenate(words_), np.concatenate(terms_), np.concatenate(dists)


PLAIN = np.ones(256, bool)  # bytes that a word is not trimmed of: letters, digits, beyond ASCII
PLAIN[:128] = False
PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass
class Tokens:
    """Words of a chunk without punctuation at their ends; ``raw``: with it."""

    start: np.ndarray
    end: np.ndarray
    raw_start: np.ndarray
    raw_end: np.ndarray
    row: np.ndarray
    first: np.ndarray


def tokens(c: Chunk) -> Tokens:
    w = words(c)
    n = len(c.data)
    plain = PLAIN[c.data]
    at = np.arange(n)
    after = np.append(np.where(plain, at, n), n)
    after = np.minimum.accumulate(after[::-1])[::-1]
    before = np.maximum.accumulate(np.where(plain, at, -1)) if n else np.zeros(0, np.int64)
    start = np.minimum(after[w.start], w.end)
    end = np.maximum(before[w.end - 1] + 1, start) if len(w.end) else w.end
    return Tokens(start, end, w.start, w.end, row_of(w.first), w.first)


def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        i = b.schema.get_field_index("text")
        low = pc.utf8_lower(b.column(i))
        yield pa.RecordBatch.from_arrays([low if j == i else b.column(j) for j in range(b.num_columns)], names=b.schema.names)


def hashed(c: Chunk, t: Tokens, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of short words, index of each among the distinct ones, hash and place of these)."""
    size = t.end - t.start
    at = np.flatnonzero((size > 0) & (size <= 4 * longest))
    hashes, firsts, back = np.unique(Prefix(c.data).of(t.start[at], t.end[at]), return_index=True, return_inverse=True)
    return at, back, hashes, at[firsts]


def texts_of(c: Chunk, t: Tokens, places: np.ndarray) -> list[str]:
    raw = c.data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(t.start[places].tolist(), t.end[places].tolist(), strict=True)]


def letters_of(found: list[str], longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, letters, sizes) of the words of at most ``longest`` letters."""
    keep = np.array([i for i, w in enumerate(found) if len(w) <= longest and "\0" not in w], np.int64)
    sizes = np.array([len(found[i]) for i in keep], np.int64)
    flat = np.frombuffer("".join(found[i] for i in keep).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros((len(keep), longest), np.uint32)
    out[np.repeat(np.arange(len(keep)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return keep, out, sizes


def quotedness(c: Chunk, t: Tokens, i: int) -> float:
    """How likely word i is mentioned and not used, 0 to 1, from the window around it."""
    lo, hi = max(t.first[t.row[i]], i - WINDOW), min(t.first[t.row[i] + 1], i + WINDOW + 1)
    raw = c.data
    around = [raw[t.raw_start[j] : t.raw_end[j]].tobytes().decode("utf-8", "replace") for j in range(lo, hi)]
    bare = [raw[t.start[j] : t.end[j]].tobytes().decode("utf-8", "replace") for j in range(lo, hi)]
    me = i - lo
    opened = max((j for j in range(me + 1) if around[j].startswith(OPENING)), default=-1)
    shut = opened >= 0 and any(around[j].rstrip(".,;:!?").endswith(CLOSING) for j in range(opened, me) if j > opened or len(around[j]) > 1 and j < me)
    closes = any(around[j].rstrip(".,;:!?").endswith(CLOSING) for j in range(me, len(around)))
    logit = -2.5
    if opened >= 0 and not shut and closes:
        logit += 3.0
    logit += 1.5 * any(w in REPORTING for w in bare[max(me - 4, 0) : me])
    logit += 1.0 * any(w in DENIAL for w in bare[max(me - 3, 0) : me])
    logit -= 1.0 * any(w in ADDRESS for w in bare[max(me - 3, 0) : me + 4] if w)
    return float(1 / (1 + np.exp(-logit)))


class Matcher:
    """Nearest term of words (ties: first term), remembered for up to ``HELD`` words of a task."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.forget()

    def forget(self) -> None:
        self.hashes, self.found = np.zeros(0, np.uint64), np.zeros((0, 2), np.int32)

    def nearest(self, found: list[str]) -> np.ndarray:
        """(term, distance) of each word, -1 for none."""
        keep, letters, sizes = letters_of(found, self.trie.longest)
        word, term, dist = self.trie.match(letters, sizes)
        o = np.lexsort((term, dist, word))
        word, term, dist = word[o], term[o], dist[o]
        first = np.append(np.ones(min(len(word), 1), bool), word[1:] != word[:-1])
        out = np.full((len(found), 2), -1, np.int32)
        out[keep[word[first]]] = np.stack([term[first], dist[first]], 1)
        return out

    def of(self, c: Chunk, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(place, (term, distance)) of the words of a chunk that match a term."""
        at, back, hashes, firsts = hashed(c, t, self.trie.longest)
        where = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[where] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        out = np.full((len(hashes), 2), -1, np.int32)
        out[known] = self.found[where[known]]
        new = np.flatnonzero(~known)
        out[new] = self.nearest(texts_of(c, t, firsts[new]))
        if len(self.hashes) + len(new) > HELD:
            self.forget()
        merged = np.concatenate([self.hashes, hashes[new]])
        o = np.argsort(merged, kind="stable")
        self.hashes, self.found = merged[o], np.concatenate([self.found, out[new]])[o]
        hit = np.flatnonzero(out[back, 0] >= 0)
        return at[hit], out[back[hit]].astype(np.int64)


def matches(c: Chunk, matcher: Matcher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, distance, quotedness) of each match, and the number of words of each row."""
    t = tokens(c)
    place, hit = matcher.of(c, t)
    q = np.array([quotedness(c, t, int(i)) for i in place])
    return t.row[place], hit[:, 0], hit[:, 1], q, np.diff(t.first)


SHARED = 8


@dataclass
class Toxicity:
    trie: Trie
    bias: float = -3.0
    shared: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.7, 0.4, 0.2, 0.15, 0.1, 0.0, 0.0]))
    own: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def features(self, rows: int, row, term, dist, q, counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shared features of each row, and (row, term and distance, value) of its own ones."""
        x = np.zeros((rows, SHARED))
        for d in range(3):
            for part, weight in ((0, 1 - q), (3, q)):
                x[:, part + d] = np.log1p(np.bincount(row, (dist == d) * weight, rows))
        used = np.bincount(row, (1 - q) / (1.0 + dist), rows)
        x[:, 6] = np.log1p(100 * used / np.maximum(counts, 1))
        x[:, 7] = np.log1p(counts) * (used > 0)
        key = row * (3 * max(len(self.trie.terms), 1)) + term * 3 + dist
        u, back = np.unique(key, return_inverse=True)
        value = np.log1p(np.bincount(back, 1 - q, len(u))) if len(u) else np.zeros(0)
        many = 3 * max(len(self.trie.terms), 1)
        return x, u // many, u % many, value

    def logits(self, x, r, f, v) -> np.ndarray:
        return self.bias + x @ self.shared + np.bincount(r, self.own[f] * v, len(x))

    def score(self, x, r, f, v) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x, r, f, v), -30, 30)))

    def fit(self, x, r, f, v, y, steps: int = 400, rate: float = 0.05) -> Toxicity:
        """Adam on the log loss; shared weights are pulled to where they start, own ones to 0."""
        self.own = np.zeros(3 * max(len(self.trie.terms), 1))
        start, n = self.shared.copy(), len(y)
        theta = [np.array([self.bias]), self.shared, self.own]
        first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
        for step in range(1, steps + 1):
            g = (1 / (1 + np.exp(-np.clip(theta[0] + x @ theta[1] + np.bincount(r, theta[2][f] * v, n), -30, 30))) - y) / n
            grads = [np.array([g.sum()]), x.T @ g + 2.0 / n * (theta[1] - start), np.bincount(f, g[r] * v, len(theta[2])) + 0.5 / n * theta[2]]
            for t, d, a, b in zip(theta, grads, first, second, strict=True):
                a += 0.1 * (d - a)
                b += 0.01 * (d * d - b)
                t -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
        self.bias, self.shared, self.own = float(theta[0][0]), theta[1], theta[2]
        return self


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each text, at most LONGEST letters, with a letter in them."""
    for c in chunks(lowered(batches)):
        t = tokens(c)
        at, back, _, firsts = hashed(c, t, LONGEST)
        found = texts_of(c, t, firsts)
        ok = np.array([2 < len(w) <= LONGEST and not w.isdigit() for w in found], bool)
        pairs = np.unique(np.stack([t.row[at], back], 1)[ok[back]] if len(at) else np.zeros((0, 2), np.int64), axis=0)
        label = c.batch.column("label").to_numpy()
        for i in range(0, len(pairs), 1 << 16):
            p = pairs[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([found[j] for j in p[:, 1]], pa.string()), pa.array(label[p[:, 0]])], names=["word", "label"])


def _examples(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        matcher = Matcher(model.trie)
        for c in chunks(lowered(batches)):
            x, r, f, v = model.features(c.rows, *matches(c, matcher))
            cut = np.searchsorted(r, np.arange(c.rows + 1))
            own = [[a[cut[i] : cut[i + 1]].astype(k).tobytes() for i in range(c.rows)] for a, k in ((f, np.int32), (v, np.float32))]
            yield pa.RecordBatch.from_arrays([c.batch.column("label"), pa.array([p.tobytes() for p in x], pa.binary()), *(pa.array(o, pa.binary()) for o in own)], names=["label", "x", "f", "v"])

    return run


def lexicon(rows: DataFrame, terms: int = TERMS, least: float = ODDS) -> list[str]:
    """rows: (label, text).  Words that toxic texts hold far more often, surest first."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (totals.get(0) and totals.get(1)):
        return []
    n0, n1 = float(totals[0]), float(totals[1])
    counts = rows.mapInArrow(_words_of, "word string, label int").groupBy("word").agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
    sure = odds - F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    top = counts.filter(F.col("a") >= MIN_TEXTS).withColumn("sure", sure).filter(F.col("sure") >= least).orderBy(F.desc("sure"), "word").limit(terms)
    return sorted(r["word"] for r in top.select("word").collect())


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample_rows: int = SAMPLE_ROWS, terms: int = TERMS) -> Toxicity | None:
    """labelled: rows with a text and a label, 1 for toxic."""
    rows = labelled.select(F.col(label_col).cast("int").alias("label"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("id")).filter("label in (0, 1)")
    total = rows.count()
    if total > sample_rows:
        rows = rows.filter(hash_unit(F.col("id"), seed=12) < sample_rows / total)
    rows = rows.select("label", "text").distinct().persist()
    try:
        model = Toxicity(Trie(lexicon(rows, terms)))
        if not model.trie.terms:
            return None
        shared = labelled.sparkSession.sparkContext.broadcast(model)
        got = rows.mapInArrow(_examples(shared), "label int, x binary, f binary, v binary").toArrow().to_pandas()
    finally:
        rows.unpersist()
    got = got.sort_values(["x", "f", "v", "label"], kind="stable")
    f = [np.frombuffer(b, np.int32) for b in got["f"]]
    v = [np.frombuffer(b, np.float32) for b in got["v"]]
    r = np.repeat(np.arange(len(got)), [len(a) for a in f])
    x = np.stack([np.frombuffer(b) for b in got["x"]])
    return model.fit(x, r, np.concatenate(f).astype(np.int64), np.concatenate(v).astype(np.float64), got["label"].to_numpy().astype(float))


def predict(documents: DataFrame, model: Toxicity | None, *, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """-> doc_id, score (0 to 1), n_matches, n_misspelled, quoted (share of the matches that
    the context takes for quotation; 0 if there are none)."""
    extra = extra or {}
    rows = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *(v.alias(k) for k, v in extra.items()))
    kept = ["doc_id", *extra]
    if model is None:
        return rows.select(*kept, F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_matches"), F.lit(0).cast("long").alias("n_misspelled"), F.lit(0.0).alias("quoted"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        matcher = Matcher(m.trie)
        for c in chunks(lowered(batches)):
            row, term, dist, q, counts = matches(c, matcher)
            score = m.score(*m.features(c.rows, row, term, dist, q, counts))
            n = np.bincount(row, minlength=c.rows)
            more = [n, np.bincount(row, dist > 0, c.rows).astype(np.int64), np.bincount(row, q, c.rows) / np.maximum(n, 1)]
            yield pa.RecordBatch.from_arrays([*(c.batch.column(k) for k in kept), pa.array(score), *(pa.array(a) for a in more)], names=[*kept, "score", "n_matches", "n_misspelled", "quoted"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"`{k}` {types[k]}" for k in kept) + ", score double, n_matches long, n_misspelled long, quoted double")
