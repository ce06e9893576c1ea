"""Hard negatives, toxicity and the prefix trie against brute force."""

import hashlib
import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from towerline.llm import hard_negatives, prefix_trie, queries, toxicity

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def mined_brute(rows, positives=5, negatives=10):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, tuple(math.floor(256 * x) for x in v), (label + 1) % 10 if i % 7 == 0 else label))
    sizes = [len(v) for _, v, _ in good]
    usual = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    good = [g for g in good if len(g[1]) == usual]
    out = []
    for a, av, al in {g for g in good if g[0] % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(av, v, strict=True)), i, label) for i, v, label in good if i != a)
        for ps, p, _ in [s for s in scored if s[2] == al][:positives]:
            fits = [s for s in scored if s[2] != al and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **how):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label, **how).collect()))


SCHEMA = "vec_id long, embedding array<double>, label int, id string, key string, b string"


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PIECE", 4)
    monkeypatch.setattr(hard_negatives, "SLAB", 16)
    rnd = random.Random(1)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    vec = lambda: [x + rnd.gauss(0, 0.4) for x in rnd.choice(centres)]
    rows = [(i, vec(), rnd.randrange(10)) for i in range(0, 1300, 5)]
    rows += [(i + 3, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], 3) for i in range(2000, 2040)]  # a hot group of copies
    rows += [(3000, None, 1), (3100, [], 1), (3200, [None] * 6, 1), (3300, [math.nan] * 6, 1), (3400, [math.inf] + [0.0] * 5, 1), (3500, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [(3600, [0.0] * 6, 2), (3700, [1.0] * 5, 2), (700, rows[3][1], 1), rows[20], rows[20], (3800, [-9.0] * 6, 4), (3900, [1e4] * 6, 5)]
    df = spark.createDataFrame([(*r, "clash", "x", "y") for r in rows], SCHEMA).repartition(3)
    want = mined_brute(rows)
    assert len(want) > 300
    for block in (4096, 64):
        assert mined(df, block=block, clusters=3) == want


def test_hard_negatives_small_cases(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    one = [(100, [1.0, 0.0], 1), (200, [0.5, 0.0], 1), (1, [0.25, 0.0], 2), (2, [0.25, 0.0], 2)]
    assert mined(spark.createDataFrame([(*r, "", "", "") for r in one], SCHEMA)) == mined_brute(one) != []
    large = [(i, [x * 1e6 for x in v], label) for i, v, label in one]  # products beyond 2**52
    assert mined(spark.createDataFrame([(*r, "", "", "") for r in large], SCHEMA)) == mined_brute(large) == sorted(
        (a, p, r, n, ps * 10**12, ns * 10**12) for a, p, r, n, ps, ns in mined_brute(one)
    )


def test_walks_end_early():
    rng = np.random.default_rng(0)
    x = np.floor(256 * (np.repeat(rng.normal(0, 1, (20, 32)), 500, 0) + rng.normal(0, 0.2, (10000, 32))))
    centre = x[:500].mean(0) / np.linalg.norm(x[:500].mean(0))
    members = x[:20]
    width = np.arccos(hard_negatives.angle_cosines(members, centre)).max()
    listed = hard_negatives.Listed(np.arange(10000), x, np.zeros(10000, int), centre, width)
    size = np.linalg.norm(members, axis=1)
    held, met = listed.walk(members, size, [np.array([-(2**63)])] * 20, lambda i, s, ids, labels: [ids != i], 5)
    assert met.max() < 5000
    for i, h in enumerate(held):
        s = (x @ members[i]).astype(int)
        s[i] = -(2**62)
        assert h[0][0].tolist() == sorted(s, reverse=True)[:5]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_trie_meets_every_word_within_reach():
    rnd = random.Random(2)
    word = lambda most: "".join(rnd.choice("abé") for _ in range(rnd.randint(1, most)))
    for _ in range(20):
        terms, found = sorted({word(11) for _ in range(25)}), list({word(14) for _ in range(150)})
        trie = toxicity.Trie(terms)
        keep, letters, sizes = toxicity.letters_of(found, trie.longest)
        have = {(found[keep[w]], terms[t], int(d)) for w, t, d in zip(*trie.match(letters, sizes), strict=True)}
        assert have == {(w, t, distance(w, t)) for w in found for t in terms if distance(w, t) <= toxicity.most_edits(len(t))}


LABELLED = "doc_id long, text string, label int, lang string, score string, x string"


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("bcdfgaeiou") for _ in range(rnd.randint(2, 8)))
    bad = ["stupid", "worthless", "moronic"]
    rows = []
    for i in range(600):
        w = [word() for _ in range(rnd.randint(10, 60))]
        if i % 3 == 0:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w), int(i % 3 == 0), "en", "clash", "clash"))
    model = toxicity.fit(spark.createDataFrame(rows, LABELLED))
    return rows, model, word


def test_toxicity_finds_misspelled_terms_and_spares_quotation(spark, judged):
    rows, model, word = judged
    assert {"stupid", "worthless", "moronic"} <= set(model.trie.terms)
    fill = lambda n: " ".join(word() for _ in range(n))
    texts = {
        1: f"{fill(10)} STUPID, {fill(5)} moronic! {fill(5)} worthless {fill(5)}", 2: f"{fill(10)} stup1d {fill(5)} wortless {fill(4)} morronic {fill(6)}", 3: fill(30), 4: "", 5: None, 6: " \n",
        7: f'{fill(10)} they wrote the word "stupid" {fill(10)}', 8: f"{fill(10)} you stupid {fill(10)}", 9: fill(60_000) + " stupid", 10: "x" * 300_000,
    }
    out = {r["doc_id"]: r for r in toxicity.predict(spark.createDataFrame([(k, v, None, None, "a", "b") for k, v in texts.items()], LABELLED), model).collect()}
    assert out[1]["score"] > 0.9 and out[1]["n_misspelled"] == 0 and out[1]["n_matches"] == 3
    assert out[2]["score"] > 0.5 and out[2]["n_misspelled"] >= 3
    assert out[3]["score"] < 0.2 and out[4]["score"] == out[5]["score"] == out[6]["score"] == out[10]["score"] < 0.2
    assert out[7]["quoted"] > 0.7 > 0.1 > out[8]["quoted"] and out[7]["score"] < out[8]["score"]
    assert out[9]["n_matches"] >= 1


def test_toxicity_without_labels_and_on_odd_rows(spark, odd, empty, judged):
    assert toxicity.fit(spark.createDataFrame([], LABELLED)) is None
    assert toxicity.fit(spark.createDataFrame([(1, "a b", 1, "", "", ""), (2, "c", None, "", "", "")], LABELLED)) is None
    assert {r["score"] for r in toxicity.predict(odd, None).collect()} == {0.0}
    got = toxicity.predict(odd, judged[1])
    assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.predict(empty, judged[1]).count() == 0


@tables
def test_toxicity_held_out(spark):
    got = queries.op12_toxicity(spark, SF).filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("quality = 1 and toxic is not null")
    rows = got.select("toxic", "predicted").collect()
    toxic, clean = [r[1] for r in rows if r[0] == 1], [r[1] for r in rows if r[0] == 0]
    assert sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def crc_head(c):
    return zlib.crc32(str(c).encode()) % 9


def trie_brute(conversations):
    """conversations: id -> list of (role, text) -> rows of the nodes."""
    nodes = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in nodes if len(p) == len(path) + 1 and p[:-1] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(conversations[c]) == len(path))))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def grown(rows, **how):
    return sorted((tuple(r) for r in prefix_trie.build(rows, **how).collect()), key=repr)


TURNS = "conv_id long, turn long, role string, text string, path string, shard int, sk int"


@pytest.fixture(scope="module")
def talk():
    rnd = random.Random(4)
    out = {}
    for c in range(-12, 70):
        if c % 5 == 0 and rnd.random() < 0.2:
            continue
        out[c] = [(rnd.choice(["user", "", "bot"]), rnd.choice(["a", "é b", "", "c" * 40])) for _ in range(rnd.randrange(12))] or [("user", "a")]
    out |= {c: [("user", "first"), ("bot", "same é")] for c in range(100, 160)}  # a hot group of copies
    out[200] = [("user", str(i)) for i in range(700)]
    out[201] = out[200][:699] + [("bot", "other end")]
    return out


def test_trie_equals_brute_force_at_any_number_of_shards(spark, talk, monkeypatch):
    rows = [(c, i, r or None, t or None, "clash", 1, 2) for c, turns in talk.items() for i, (r, t) in enumerate(turns)] + [(None, 0, "user", "nobody", "", 1, 2)]
    own = prefix_trie.paths(spark.createDataFrame(rows, TURNS).repartition(5))
    short = {c: t for c, t in talk.items() if len(t) < 100}
    want = trie_brute(short)
    for turns in (10**6, 60, 9):
        assert grown(own.filter("conv_id < 200"), shard_turns=turns) == want
    whole = grown(own)
    monkeypatch.setattr(prefix_trie, "SPLIT_BYTES", 4000)  # cut splitters
    assert grown(own, shard_turns=40) == whole
    assert len([r for r in whole if r[0] in (200, 201)]) >= 700


def test_spliced_conversations(spark, talk):
    talk = {c: t for c, t in talk.items() if len(t) < 100}
    rows = [(c, i, r, t, "", 1, 2) for c, turns in talk.items() for i, (r, t) in enumerate(turns)]
    own = prefix_trie.paths(spark.createDataFrame(rows, TURNS))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    got = grown(prefix_trie.spliced(own, F.col("conv_id") - F.col("conv_id") % 5, head), shard_turns=50)
    base = lambda c: c - int(math.fmod(c, 5))
    assert got == trie_brute({c: talk.get(base(c), [])[: crc_head(c)] + t[crc_head(c) :] for c, t in talk.items()})


def test_trie_small_cases(spark):
    assert grown(prefix_trie.paths(spark.createDataFrame([], TURNS))) == []
    none = [(5, None, None, None, "", 1, 2), (5, 0, "user", "x", "", 1, 2)]
    assert grown(prefix_trie.paths(spark.createDataFrame(none, TURNS))) == trie_brute({5: [("", ""), ("user", "x")]})


@tables
@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_prefix_trie"])
def test_new_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE[name])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(want.columns).collect()))) == sorted(map(repr, want.fetchall()))
