import math
import os
import random
import re
from collections import Counter
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from towerline.llm import bpe, factor_machine, jaccard_join, langid, line_dedup, mixing, ngrams, permutation_index, perplexity, queries
from towerline.llm.bytetext import Chunk, words
from towerline.llm.textstats import base_counts

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
U = np.uint64


def chunk(texts):
    data = b"".join(texts)
    off = np.cumsum([0, *map(len, texts)])
    return Chunk(None, np.frombuffer(data, np.uint8), off, np.ones(len(texts), bool))


def counts_brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    rep = {k for i, x in enumerate(wins) if wins.count(x) > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(rep)


def test_structure_counts(rows):
    texts = [t or "" for _, t, *_ in rows if len(t or "") < 4000] + ["a\na\n\n a\na", "x\n", "\n\n", "#*$ <>|&% #", "é é\né é", "a b c d e f g h a b c d e f g h"]
    got = base_counts(chunk([t.encode() for t in texts]))
    have = list(zip(*(got[k].tolist() for k in perplexity.COUNTS), strict=True))
    assert have == [counts_brute(t) for t in texts]


def test_words_stay_within_rows():
    w = words(chunk([b"ab", b"cd e", b"", b" f"]))
    assert w.counts().tolist() == [1, 2, 0, 1]


def grams(texts, order):
    k, n = np.unique(ngrams.keys(chunk(texts), order), return_counts=True)
    return k, n


@pytest.mark.parametrize("build", [ngrams.partial_matching, ngrams.kneser_ney])
def test_models_sum_to_one(build):
    rnd = random.Random(0)
    text = "".join(rnd.choice("abcd") for _ in range(3000)).encode()
    m = build(*grams([text], 3), 3)
    for ctx in (b"ab", b"zz", b"\0a", b"dz"):
        base = (ctx[0] << 16) | (ctx[1] << 8)
        total = np.exp(m.logp(np.arange(base, base + 256, dtype=U))).sum()
        assert total == pytest.approx(1, abs=1e-6)


def ppm_brute(text, order):
    return ppm_of_texts([text], order)


def ppm_of_texts(texts, order):
    """Probability of one byte after a context, straight from the definition."""
    count = {}
    for text in texts:
        for i in range(len(text)):
            for o in range(order):
                ctx = (b"\0" * order + text[:i])[-o:] if o else b""
                count.setdefault(ctx, {}).setdefault(text[i], 0)
                count[ctx][text[i]] += 1

    def p(ctx, s):
        out, excluded, left = 1.0, set(), len(ctx)
        while True:
            seen = count.get(ctx[len(ctx) - left :] if left else b"", {})
            if seen:
                total, kinds = sum(seen.values()), len(seen)
                gone = sum(n for t, n in seen.items() if t in excluded)
                scale = 1 - gone / (total + kinds)
                if s in seen:
                    return out * seen[s] / (total + kinds) / scale
                out *= kinds / (total + kinds) / scale
                excluded |= set(seen)
            if left == 0:
                return out / (256 - len(excluded))
            left -= 1

    return p


def test_partial_matching_is_the_definition():
    text = b"abracadabra abracab"
    m, p = ngrams.partial_matching(*grams([text], 3), 3), ppm_brute(text, 3)
    for ctx in (b"ab", b"ra", b"xy", b"ca"):
        for s in b"abrxz":
            got = float(np.exp(m.logp(np.array([(ctx[0] << 16) | (ctx[1] << 8) | s], U)))[0])
            assert got == pytest.approx(p(ctx, s), rel=1e-9)


def test_predictions_are_the_shortest_codes(spark):
    rnd = random.Random(9)
    text = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) for _ in range(6))
    train = [(i, text(letters), x) for i, (x, letters) in enumerate([("a", "abcd"), ("b", "cdef")] * 10)]
    tests = [(100 + i, text(rnd.choice(["abcd", "cdef", "abef"])), None) for i in range(15)] + [(200, "12 34", None), (201, None, None)]
    langs, scorer = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(tests, "doc_id long, text string, lang string"), langs, scorer).collect()}
    models = {x: ppm_of_texts([t.encode() for _, t, y in train if y == x], 4) for x in "ab"}
    for i, t, _ in tests:
        if i >= 200:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        b = b"\0" * 3 + t.encode()
        bits = {x: -sum(math.log(p(b[k : k + 3], b[k + 3])) for k in range(len(b) - 3)) for x, p in models.items()}
        best = min(bits, key=bits.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(bits[best] - v) for v in bits.values()), abs=1e-4)


def test_sorted_hash_finds_all_and_nothing_else():
    rng = np.random.default_rng(1)
    k = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    t = ngrams.SortedHash(k)
    at = t.find(k)
    assert (k[t.order][at] == k).all()
    assert (t.find(np.setdiff1d(np.arange(5000, dtype=U), k)) == -1).all()


@tables
def test_language_accuracy_held_out(spark):
    got = queries.op2_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert r > 0.99


def test_language_odd_cases(spark, odd, rows, empty):
    langs, scorer = langid.fit(odd)
    got = langid.predict(odd, langs, scorer).collect()
    assert len(got) == len(rows)
    assert all((r["lang_pred"] in ("en", "fr", "und")) and 0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"}
    none, s = langid.fit(empty)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(odd, none, s).collect()} == {("und", 0.0)}


@tables
def test_quality_rules_tell_labels_apart(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op4_quality_rules(spark, sf).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = {x["quality"]: x["k"] for x in got.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert r[1] > 0.96 and r[0] < 0.5


def kneser_ney_brute(texts, order):
    """p(byte | bytes before) from the definition, over the distinct texts."""
    levels = [Counter()]
    for t in set(texts):
        b = b"\0" * (order - 1) + t
        levels[0].update(b[i : i + order] for i in range(len(t)))
    for _ in range(order - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    levels = levels[::-1]

    def p(g):
        if not g:
            return 1 / 256
        seen = levels[len(g) - 1]
        n = [max(sum(v == k for v in seen.values()), 0.5) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), 0.95 * k) for k in (1, 2, 3)]
        after = {h: v for h, v in seen.items() if h[:-1] == g[:-1]}
        if not after:
            return p(g[1:])
        total = sum(after.values())
        freed = sum(d[min(v, 3)] for v in after.values()) / total
        own = after.get(g, 0)
        return (own - d[min(own, 3)]) / total + freed * p(g[1:])

    return p


def verdicts_brute(rows):
    """rows: (id, lang, text, half) -> id: (log perplexity, kept)."""
    value = {}
    for lang, text, half in {r[1:] for r in rows}:
        other = [t.encode() for _, x, t, h in rows if x == lang and h != half] or [t.encode() for _, x, t, h in rows if x == lang]
        p, b = kneser_ney_brute(other, perplexity.ORDER), b"\0" * 4 + text.encode()
        value[lang, text] = -np.mean([math.log(p(b[i : i + 5])) for i in range(len(b) - 4)]) if text else None
    failed = lambda t: (lambda c: c[0] < 20 or 100 * c[4] > 30 * c[0])(counts_brute(t))
    sound = [(x, t, v, len(t.encode())) for (x, t), v in value.items() if not failed(t)]
    mid = {x: np.median([v for y, _, v, _ in sound if y == x]) for x, *_ in sound}
    z = {(x, t): (v - mid[x]) / math.sqrt(1 / n + 1 / perplexity.SETTLED) for x, t, v, n in sound}
    every = np.median([abs(v) for v in z.values()])
    spread = {y: max(1.4826 * max(np.median([abs(v) for (x, _), v in z.items() if x == y]), every), perplexity.LEAST_SPREAD) for y in mid}
    kept = {k: -perplexity.LOWER <= v / spread[k[0]] <= perplexity.UPPER for k, v in z.items()}
    return {i: (value[x, t], kept.get((x, t), False)) for i, x, t, _ in rows}


@pytest.mark.parametrize("most_grams", [perplexity.MOST_GRAMS, 10])
def test_quality_rules_are_the_definition(spark, most_grams, monkeypatch):
    rnd = random.Random(3)
    words = {x: ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 5))) for _ in range(40)] for x, letters in (("a", "abcde"), ("b", "éßxyz"))}
    data = [(i, x, " ".join(rnd.choice(words[x]) for _ in range(rnd.randint(15, 45)))) for i, x in enumerate("ab" * 14)]
    data += [(100, "a", " ".join("".join(rnd.choice("#$%&QWRT") for _ in range(6)) for _ in range(40))), (101, "a", data[0][2]), (102, "c", "only text of c " * 2), (103, "d", None), (104, "d", "")]
    df = spark.createDataFrame(data, "doc_id long, lang string, text string")
    halves = [(r["lang"], r["text"], r["half"]) for r in perplexity.keyed(df, "text", "lang").collect()]
    want = verdicts_brute([(i, *h) for (i, *_), h in zip(data, halves, strict=True)])
    monkeypatch.setattr(perplexity, "PER_BUCKET", 300)
    got = {r["doc_id"]: r for r in perplexity.judge_documents(df, most_grams=most_grams).collect()}
    assert {i: r["kept"] for i, r in got.items()} == {i: k for i, (_, k) in want.items()} and not got[100]["kept"]
    for i, (v, _) in want.items():
        assert got[i]["log_perplexity"] is v is None or got[i]["log_perplexity"] == pytest.approx(v, abs=1e-5)


def shuffled_bytes(spark):
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_models_in_pieces_shuffle_no_text(spark, monkeypatch, tmp_path):
    """All documents, whatever lands in a piece; n-grams of the texts stay where they are."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    data = [(i, "ab"[i % 2], " ".join(rnd.choice(words) for _ in range(800))) for i in range(300)]
    df = spark.createDataFrame(data + data[:40], "doc_id long, lang string, text string").repartition(3)
    df.write.parquet(path := f"{tmp_path}/docs")
    df = spark.read.parquet(path)
    want = sorted((r["doc_id"], r["kept"], round(r["log_perplexity"], 6)) for r in perplexity.judge_documents(df).collect())
    monkeypatch.setattr(perplexity, "PER_BUCKET", 2000)
    before = shuffled_bytes(spark)
    got = sorted((r["doc_id"], r["kept"], round(r["log_perplexity"], 6)) for r in perplexity.judge_documents(df, most_grams=1).collect())
    assert got == want
    assert shuffled_bytes(spark) - before < sum(len(t) for *_, t in data)


def test_documents_meet_verdicts_of_pieces(spark, monkeypatch, tmp_path):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    data = [(i, "ab"[i % 2] if i % 7 else None, " ".join(rnd.choice(words) for _ in range(600)), "clash") for i in range(300)] + [(300, "a", None, "x"), (None, "a", "", "x"), (301, "a", "loop " * 400, "x")]
    spark.createDataFrame(data + data[:40], "doc_id long, lang string, text string, __key string").repartition(3).write.parquet(path := f"{tmp_path}/docs")
    df = spark.read.parquet(path)
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    want = rows(perplexity.filter_documents(df))
    monkeypatch.setattr(perplexity, "fit", partial(perplexity.fit, most_grams=1))
    monkeypatch.setattr(perplexity, "PER_BUCKET", 2000)
    before = shuffled_bytes(spark)
    got = perplexity.filter_documents(df)
    assert got.columns == df.columns and rows(got) == want and 0 < len(want) < len(data) + 40
    assert shuffled_bytes(spark) - before < 2 * sum(len(t or "") for _, _, t, _ in data)


def test_quality_rules_odd_cases(odd, rows, empty):
    got = perplexity.judge_documents(odd).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["base_failed"] and not by[4]["kept"] and by[4]["log_perplexity"] is None and by[13]["base_failed"]
    kept = perplexity.filter_documents(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)
    assert perplexity.judge_documents(empty).count() == 0


@tables
def test_copies_of_one_text_move_no_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    hot = docs.join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").filter("lang = 'de' and length(text) > 500").orderBy("doc_id").limit(1).select("text", "lang")
    n = docs.filter("lang = 'de'").count()
    copies = spark.range(10**6, 10**6 + 2 * n).withColumnRenamed("id", "doc_id").crossJoin(hot)
    verdicts = lambda d: {r["doc_id"]: r["kept"] for r in perplexity.judge_documents(d).collect()}
    plain, with_copies = verdicts(docs), verdicts(docs.unionByName(copies))
    assert {i: k for i, k in with_copies.items() if i < 10**6} == plain
    assert all(k for i, k in with_copies.items() if i >= 10**6)


def test_languages_without_a_word(spark):
    df = spark.createDataFrame([(1, "some text of en", "en"), (2, None, "de"), (3, "", "de"), (4, None, None)], "doc_id long, text string, lang string")
    for most in (perplexity.MOST_GRAMS, 1):
        got = {r["doc_id"]: (r["log_perplexity"] is None, r["kept"]) for r in perplexity.judge_documents(df, most_grams=most).collect()}
        assert got == {1: (False, False), 2: (True, False), 3: (True, False), 4: (True, False)}


def test_machine_identity_and_learning():
    m = factor_machine.Machine(16, 2, 4)
    f, x = np.array([1, 3, 16, 17]), np.array([0.5, -1.0, 2.0, 0.3], np.float32)
    z = m.parts(1, np.zeros(4, int), f, x)[0][0]
    pairs = sum(float(m.v[f[i]] @ m.v[f[j]]) * x[i] * x[j] for i in range(4) for j in range(i))
    assert z == pytest.approx(pairs, abs=1e-5)


@tables
def test_quality_classifier_held_out(spark):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op10_quality_classifier(spark, SF).filter("held_out").join(lab, "doc_id").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert np.mean(good[:, None] > bad[None]) > 0.95 and ((got.predicted == 1) == (got.score >= 0.3)).all()


def test_classifier_odd_cases(odd, rows, empty):
    labelled = odd.withColumn("label", F.when(F.col("doc_id") > 9, 1).when(F.col("doc_id") < 5, 0).when(F.col("doc_id") == 6, 7))
    m = factor_machine.fit(labelled)
    got = factor_machine.predict(odd, m).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert factor_machine.fit(labelled.limit(0)) is None
    assert {r["score"] for r in factor_machine.predict(odd, None).collect()} == {0.5}
    assert factor_machine.predict(empty, m).count() == 0


def brute_nearest(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    o = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in o]


def test_footrule_is_the_definition():
    rng = np.random.default_rng(4)
    perms = np.stack([rng.permutation(12)[:5] for _ in range(40)]).astype(np.int32)
    place = lambda perm, p: list(perm).index(p) if p in perm else 5
    files = permutation_index.Files(perms, 12)
    for q in perms[:10]:
        assert files.footrule(q).tolist() == [sum(abs(place(v, p) - place(q, p)) for p in range(12)) for v in perms]


@tables
def test_search_recall(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    got = queries.op1_permutation_index(spark, SF).toPandas()
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        mine = got[got.query_id == ids[q]].sort_values("rank")
        want = brute_nearest(ids, x, q, 10)
        hit += len({i for i, _ in want} & set(mine.vec_id))
        total += 10
        assert mine["rank"].tolist() == list(range(1, 11)) and mine.score.is_monotonic_increasing
    assert hit / total >= 0.9


@tables
def test_search_prunes(spark):
    """Few vectors are reranked, and most true neighbours are among them."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    e = df.toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    got = permutation_index.search(df, F.col("vec_id") % 100 == 0).toPandas()
    hit = [len({i for i, _ in brute_nearest(ids, x, q, 10)} & set(got[got.query_id == ids[q]].vec_id)) for q in np.flatnonzero(ids % 100 == 0)]
    assert np.mean(hit) >= 9 and got.n_candidates.mean() <= 0.12 * len(ids)


def test_search_odd_cases(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [0.0, 2.0]), (200, None), (300, []), (400, [0.0, 0.0]), (500, [float("nan"), 1.0]), (600, [1.0, None]), (700, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("vec", F.lit(1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in permutation_index.search(df, F.col("vec_id") % 100 == 0).collect())
    assert got == [(0, 1, 5), (0, 2, 100), (0, 3, 3), (100, 1, 0), (100, 2, 5), (100, 3, 3)]
    assert permutation_index.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    twice = spark.createDataFrame([(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in permutation_index.search(twice, F.col("vec_id") == 100).collect())
    assert got == [(100, 1, 1), (100, 1, 2), (100, 2, 1), (100, 2, 2)]


def test_tokenizer_is_the_library(odd, rows):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocabulary()
    t = tokenizers.Tokenizer.from_file(path)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in bpe.tokenize(odd, path).collect()), key=repr)
    want = []
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    b = bpe.WordBpe(path)
    rnd = random.Random(1)
    for _ in range(2000):
        s = "".join(rnd.choice("aàÀßΣσİı ﬁ'sS'llreté<|endoftext|>\x1c\x85\xa0٣½日🙂\n!?#01") for _ in range(rnd.randint(0, 40)))
        assert b.encode(s) == t.encode(s, add_special_tokens=False).ids
        assert b.decode(b.encode(s)) == t.decode(b.encode(s), skip_special_tokens=False)


def brute_rates(tokens, posterior, goal, most):
    """Many small projected gradient steps on one rate for each document."""
    x = tokens[:, None] * posterior
    r = np.full(len(tokens), min(1.0, most))
    for _ in range(30_000):
        r = np.clip(r + posterior @ (goal - r @ x) / np.trace(x.T @ posterior), 0, most)
    return r


def fitted_rates(spark, tokens, posterior, goal, most):
    df = spark.createDataFrame([(i, int(n), [float(v) for v in q]) for i, (n, q) in enumerate(zip(tokens, posterior, strict=True))], "i int, __tokens long, __posterior array<double>")
    steps = mixing.fit_rates(df, list(goal), max_rate=most)
    return np.array([r["r"] for r in df.select("i", mixing.rate(F.col("__posterior"), steps, most).alias("r")).orderBy("i").collect()])


def test_rates_reach_their_targets(spark):
    """Targets that can be met are met; others are as near as brute force comes."""
    rng = np.random.default_rng(0)
    t = rng.integers(1, 500, 300).astype(float)
    cases = [(rng.dirichlet([a] * 3, 300), f, most) for a, f, most in ((0.3, (0.2, 1.0, 2.0), None), (0.02, (0.1, 0.95, 0.9), 1.0), (0.3, (1.0, 0.1, 0.1), 1.0))]
    cases.append((np.tile([0.6, 0.3, 0.1], (300, 1)), (1.0, 0.1, 0.1), 1.0))
    for p, factor, most in cases:
        now = t @ p
        goal = now * factor
        r = fitted_rates(spark, t, p, goal, most)
        gap = lambda x: np.linalg.norm((t * x) @ p - goal) / now.sum()  # noqa: E731, B023
        assert r.min() >= 0 and (most is None or r.max() <= most)
        assert gap(r) <= gap(brute_rates(t, p, goal, np.inf if most is None else most)) * 1.01 + 1e-6


def test_mixing_odd_cases(spark, odd, rows, empty):
    labels = spark.createDataFrame([(1, "a"), (2, "b"), (2, "a"), (None, "a"), (6, None), (99, "b"), (20, "b")], "doc_id long, kind string")
    got = mixing.mix(odd, labels, F.col("kind")).collect()
    assert len(got) == len(rows) and all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got)
    one = mixing.mix(odd, labels.limit(0), F.col("kind")).collect()
    assert {round(r["rate"], 9) for r in one} == {1.0}
    kept = mixing.resample(odd, labels, F.col("kind"), keep={"b": 0.5})
    assert kept.columns == odd.columns and kept.count() <= len(rows)
    assert mixing.mix(empty, labels, F.col("kind")).count() == 0


def test_names_inside_clash_with_none(spark, odd):
    """Stages pass columns on, also those named like the ones used inside."""
    names = "__id __gone __lines __kept __w __t __tokens __signs __at __posterior __a __b __rid __rth __row __l __lang __key a b row t id text2 lines kept gone solid".split()
    df = odd.select("doc_id", "text", "lang", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    labels = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, kind string")
    for out in (line_dedup.drop_common_lines(df), jaccard_join.keep_one_each(df), perplexity.filter_documents(df), mixing.resample(df, labels, F.col("kind"), keep={"b": 0.5})):
        got = out.collect()
        assert out.columns == df.columns and all(tuple(r)[3:] == tuple(range(len(names))) for r in got)


@tables
def test_classifier_of_domains(spark):
    d, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = mixing.mix(d, lab, queries.label_domain()).join(lab.withColumn("true", queries.label_domain()), "doc_id")
    r = {x["true"]: x["ok"] for x in got.groupBy("true").agg(F.avg((F.col("true") == F.col("domain")).cast("double")).alias("ok")).collect()}
    assert r["clean"] > 0.95 and math.isfinite(sum(r.values()))
