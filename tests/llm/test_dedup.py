import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from towerline.llm import jaccard_join, line_dedup, repeats, substring_dedup, suffix_dedup
from towerline.llm.bytetext import Prefix, anchors

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda b: hashlib.sha256(b).hexdigest()


def passages_brute(rows, w):
    docs = [(i, WORDS.findall(t or "")) for i, t, *_ in rows]
    least = {}
    for i, x in docs:
        if i is not None:
            for p in range(len(x) - w + 1):
                k = tuple(x[p : p + w])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, x in docs:
        gone = set()
        if i is not None:
            for p in range(len(x) - w + 1):
                if least[tuple(x[p : p + w])] < i:
                    gone.update(range(p, p + w))
        out.append((i, len(x), len(gone), sha(" ".join(v for k, v in enumerate(x) if k not in gone).encode())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,limit", [(50, 20_000), (20, 20_000), (20, 1)])
def test_passages(odd, rows, window, limit):
    got = substring_dedup.remove_repeated_passages(odd, window=window, limit=limit).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == passages_brute(rows, window)


def bytes_brute(rows, w, keep):
    docs = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[p : p + w] for _, b in docs for p in range(len(b) - w + 1))
    first = {}
    for i, b in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        for p in range(len(b) - w + 1):
            first.setdefault(b[p : p + w], (i, b, p))
    out = []
    for i, b in docs:
        gone = set()
        for p in range(len(b) - w + 1):
            k = b[p : p + w]
            if seen[k] > 1 and (keep == "none" or first[k] != (i, b, p)):
                gone.update(range(p, p + w))
        spans = sum(1 for k in gone if k - 1 not in gone)
        out.append((i, len(b), len(gone), spans, sha(bytes(v for k, v in enumerate(b) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,limit", [(200, 20_000), (60, 20_000), (60, 1)])
def test_bytes_without_any_copy(odd, rows, window, limit):
    got = suffix_dedup.remove_repeated_bytes(odd, window=window, keep="none", limit=limit).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == bytes_brute(rows, window, "none")


def test_bytes_keep_first(spark, passage):
    rows = [(1, "head " + passage), (2, passage + " tail"), (3, "other text that stays")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeated_bytes(df, window=100).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == bytes_brute(rows, 100, "first")


def test_longest_factors_are_the_brute_force_ones():
    rnd = random.Random(2)
    s = np.array([rnd.randint(0, 2) for _ in range(200)])
    x = suffix_dedup.Suffixes(s, 256)
    common = lambda i, j: next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), 0)
    for earlier in (True, False):
        want = [max([common(i, j) for j in (range(i) if earlier else range(i + 1, len(s)))], default=0) for i in range(len(s))]
        assert list(x.factor(earlier)) == want


def test_factors_anywhere_are_those_of_neighbours(monkeypatch):
    rnd = random.Random(3)
    for top, size in ((2, 200), (300, 500), (2**20, 300)):
        s = np.array([rnd.choice((0, 1, top)) for _ in range(size)])
        x = suffix_dedup.Suffixes(s, 256)
        assert list(x.repeated()) == list(np.maximum(x.factor(True), x.factor(False)))
    assert list(suffix_dedup.Suffixes(np.array([7]), 200).repeated()) == [0]


def test_bytes_without_any_copy_look_at_neighbours_only(spark, passage, monkeypatch):
    """No search for nearest smaller or greater positions where any other copy counts."""
    monkeypatch.delattr(suffix_dedup.Suffixes, "nearest")
    rows = [(1, "head " + passage), (2, passage + " tail"), (3, "other text that stays")]
    spec = suffix_dedup.Spec("byte", 100, 32, "all")
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    at = np.arange(3)
    shard = suffix_dedup.Shard.of(spec, at, at, np.zeros(3, np.int64), np.ones(3, np.int64), np.concatenate(data), np.cumsum([0, *map(len, data)]))
    stretch = (at[:2], shard.off[:2], shard.off[1:3])
    row, lo, hi = suffix_dedup._by_factors(shard, spec, stretch, stretch)
    n = len(passage)
    assert sorted(zip(row.tolist(), (lo - shard.off[row]).tolist(), (hi - shard.off[row]).tolist(), strict=True)) == [(0, 5, 5 + n), (1, 0, n)]


def test_automaton_statistics():
    a = substring_dedup.SuffixAutomaton()
    refs = ["abcabx", "xabcd"]
    for r in refs:
        a.add(r)
    q = "zabcabcdx"
    want = [max((n for n in range(i + 2) if any(q[i + 1 - n : i + 1] in r for r in refs)), default=0) for i in range(len(q))]
    assert a.statistics(q) == want


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(0)
    block = rng.integers(0, 4, 60)
    s = np.concatenate([rng.integers(0, 4, 100), block, rng.integers(0, 4, 50), block]).astype(np.uint8)
    at = set(anchors(Prefix(s).sliding(10), np.full(len(s), len(s)), 40, 10))
    a, b = {x - 100 for x in at if 100 <= x <= 150}, {x - 210 for x in at if 210 <= x <= 260}
    for start in range(21):
        assert {x for x in a if start <= x <= start + 30} & {x for x in b if start <= x <= start + 30}


def test_a_gram_whose_key_is_zero_is_an_anchor():
    grams = np.full(300, 1 << 40, np.uint64)
    grams[150] = 5  # the upper half, by which grams are compared, is 0
    at = anchors(grams, np.full(300, 300), 101, 1)
    assert 150 in at and all(any(s <= a < s + 101 for a in at) for s in range(200))


@pytest.mark.parametrize("mode", ["all", "first", "smaller"])
def test_classes_that_stream_by_are_decided_alike(mode, monkeypatch):
    rng = np.random.default_rng(3)
    cols = {"h": rng.integers(0, 4, 900), "salt": np.full(900, -1), "c": rng.integers(0, 2, 900), "rid": rng.integers(0, 40, 900), "rth": np.zeros(900, int), "pos": np.arange(900)}
    cols["c"][cols["h"] == 2] = 0
    order = np.lexsort([cols[k] for k in ("pos", "rth", "rid", "c", "salt", "h")])
    cols = {k: v[order] for k, v in cols.items()}
    spec = repeats.Spec("byte", 10, 4, mode)

    def decided(step):
        batches = [pa.RecordBatch.from_pydict({k: v[i : i + step] for k, v in cols.items()}) for i in range(0, 900, step)]
        return sorted(r for b in repeats._classify(spec)(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns)))

    whole = decided(900)
    monkeypatch.setattr(repeats, "ROWS_OUT", 5)
    assert decided(7) == whole and {r[0] for r in whole} == {0, 1}


def test_many_rows_without_an_id_are_told_apart(spark):
    rnd = random.Random(8)
    rows = [(None, f"{i:05d}" + "".join(rnd.choice("abcdef") for _ in range(25))) for i in range(70_000)]
    rows[7], rows[60_000] = (None, "x" + rows[9][1]), (None, rows[9][1] + "y")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeated_bytes(df, window=25, keep="none").filter("n_removed > 0").select("n_bytes", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(30, 30), (31, 30), (31, 30)]


def lines_brute(rows):
    docs = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    low = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, ls in docs:
        if i is not None:
            for x in ls:
                held.setdefault(low(x), set()).add(i)
    out = []
    for i, ls in docs:
        stay = [x for x in ls if i is None or len(low(x)) < 40 or len(held[low(x)]) < 5 or max(held[low(x)]) == i]
        out.append((i, len(ls), len(ls) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def test_lines(odd, rows):
    got = line_dedup.drop_common_lines(odd, stats=True)
    assert set(odd.columns) <= set(got.columns)
    have = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr)
    assert have == lines_brute(rows) and sum(h[2] for h in have) > 0


def jaccard_brute(rows, t=0.8):
    sets = []
    for i, text, *_ in rows:
        w = WORDS.findall(text or "")
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    n = len(sets)
    up = list(range(n))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    links = [0] * n
    for a in range(n):
        for b in range(n):
            x, y = sets[a][1], sets[b][1]
            if a != b and x and y and len(x & y) >= t * len(x | y):
                links[a] += 1
                up[max(root(a), root(b))] = min(root(a), root(b))
    out = []
    for k in range(n):
        ids = [sets[m][0] for m in range(n) if root(m) == root(k) and sets[m][0] is not None]
        out.append((sets[k][0], (min(ids) if ids else None) if sets[k][1] else sets[k][0], links[k]))
    return sorted(out, key=repr)


def test_near_duplicates(odd, rows):
    got = jaccard_join.near_duplicates(odd).select("doc_id", "class_id", "n_links")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == jaccard_brute(rows)


def test_large_groups_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(200)]
    rows = []
    for i in range(30):
        w = list(base)
        w[rnd.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "n_links")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == jaccard_brute(rows)


def test_a_large_group_has_few_different_links(spark, monkeypatch):
    """Trees agree on the node that the others hang on."""
    edges = []
    connected = jaccard_join.connected
    monkeypatch.setattr(jaccard_join, "connected", lambda e: edges.append(e.count()) or connected(e))
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(400)]
    rows = []
    for i in range(200):
        w = list(base)
        w[rnd.randrange(400)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["class_id"], r["n_links"]) for r in got.collect()} == {(0, 199)}
    assert edges[0] < 4 * len(rows)


def test_one_of_each_stays(odd):
    got = jaccard_join.keep_one_each(odd)
    ids = sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None)
    assert got.columns == odd.columns
    assert 6 in ids and 8 not in ids and 9 in ids and 10 not in ids and ids.count(7) == 1


def test_unrelated_texts_of_one_id_stay(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, text(0)), (1, text(1)), (1, text(1)), (1, ""), (1, " "), (1, None), (2, text(0)), (3, text(2)), (3, text(1) + " more")]
    got = jaccard_join.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(1, text(0)), (1, text(1)), (1, ""), (1, " "), (1, None), (3, text(2))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_forest_depth_reaches_its_recall():
    d = int(jaccard_join.forest_depth(0.8, 24, 8, 0.99999))
    assert 1 - (1 - 0.8**d) ** 24 >= 0.99999 > 1 - (1 - 0.8 ** (d + 1)) ** 24
    a = np.arange(1, 40)
    least = jaccard_join.least_similarity(a[:, None], a[None], 0.8)
    for x in range(1, 40):
        for y in range(1, 40):
            s = [k / (x + y - k) for k in range(min(x, y) + 1) if k >= 0.8 * (x + y - k) - 1e-9]
            assert least[x - 1, y - 1] == pytest.approx(min(s) if s else 2)
    depth = jaccard_join.forest_depth(np.minimum(least, 1), 24, 8, 0.99999)
    assert depth.min() == d and depth.max() == 8 and len(np.unique(depth)) > 2


def chain(n, rnd, size=60):
    """Texts of which only neighbours are near each other."""
    word = lambda: f"w{rnd.randint(0, 10**9)}"
    w = [word() for _ in range(size)]
    out = []
    for i in range(n):
        out.append((i, " ".join(w)))
        w = [word() for _ in range(4)] + w[:-4]
    return out


def test_a_long_chain_goes_by_trie_nodes(spark, monkeypatch):
    """Small blocks: the chain is dealt by trie nodes, a dense group by blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rnd = random.Random(12)
    base = [f"d{i}" for i in range(200)]
    dense = []
    for i in range(50):
        w = list(base)
        w[rnd.randrange(200)] = f"edit{i}"
        dense.append((1000 + i, " ".join(w)))
    rows = chain(80, rnd) + dense
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(df).select("doc_id", "class_id", "n_links")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == jaccard_brute(rows)


def test_a_chain_of_ten_thousand_texts(spark):
    rows = chain(10_000, random.Random(13))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard_join.near_duplicates(df).groupBy("class_id", "n_links").count().collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2), (0, 2, 9998)]


def test_empty_tables(empty):
    assert substring_dedup.remove_repeated_passages(empty).count() == 0
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert line_dedup.drop_common_lines(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one_each(empty).count() == 0
