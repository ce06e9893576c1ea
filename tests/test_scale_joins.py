"""Joins, selections and searches that hold no group in one task, against brute force."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from towerline.functions.names import ancestors
from towerline.operators import serving, space, statistics

START = datetime(2024, 3, 1)


def test_ancestors_of_names(spark):
    names = ["net/c1", "net/c12/Rel-3", "a,b=1/c", "/x/y", "", "plain", "a//b", None]
    got = {r["n"]: r["a"] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", ancestors(F.col("n")).alias("a")).collect()}
    parents = {"net", "net/c1", "net/c12", "a", "a,b=1", "", "/x", "plain", "a/", "net/c12/Rel-3", "b"}
    for n in filter(None, names):
        assert {p for p in parents if n == p or n.startswith(p + ",") or n.startswith(p + "/")} == set(got[n]) & parents
    assert got[None] is None and got[""] == [""]


def test_containment_join_is_the_pairwise_one(spark):
    rnd = random.Random(1)
    part = lambda: rnd.choice(["a", "b", "ab", "1", "12"])
    dn = lambda: "".join(part() + rnd.choice([",", "/", ""]) for _ in range(rnd.randint(1, 4)))
    children = [(rnd.choice("xy"), dn(), i) for i in range(300)]
    parents = sorted({(rnd.choice("xy"), dn().rstrip(",/") or "a") for _ in range(40)})
    got = serving.under(spark.createDataFrame(children, "ems string, dn string, id int"), spark.createDataFrame([(*p, f"c{i}") for i, p in enumerate(parents)], "ems string, dn string, cell_name string"))
    want = sorted((e, d, i, f"c{k}") for e, d, i in children for k, (pe, pd) in enumerate(parents) if pe == e and (d == pd or d.startswith(pd + ",") or d.startswith(pd + "/")))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_changes_and_snapshots_of_cells(spark):
    at = lambda d: datetime(2024, 1, d)
    cells = spark.createDataFrame([("e", "n/c1", "one"), ("e", "n/c12", "twelve"), ("f", "n/c1", "other")], "ems string, dn string, cell_name string")
    log = [("e", "n/c1", at(1), 1), ("e", "n/c1/R-1", at(1), 2), ("e", "n/c1,S=2", at(3), 3), ("e", "n/c12", at(2), 4), ("f", "n/c1/R-9", at(2), 5), ("e", "n/c1", at(9), 6), ("e", "n", at(2), 7), ("e", "n/c1/R-1", at(1), 2)]
    cm = spark.createDataFrame(log, "ems string, dn string, time timestamp, id int")
    changes = serving.cm_changes(cm, cells, at(1), at(9))
    assert sorted((r["id"], r["cell_name"]) for r in changes.collect()) == [(1, "one"), (2, "one"), (3, "one"), (4, "twelve"), (5, "other")]
    assert sorted(r["id"] for r in serving.cm_changes(cm, cells, at(1), at(9), "one").collect()) == [1, 2, 3]
    snap = lambda d, c=None: sorted((r["id"], r["cell_name"]) for r in serving.cell_snapshot(cm, cells, at(d), c).collect())
    assert snap(2) == [(1, "one"), (2, "one"), (4, "twelve"), (5, "other")] and snap(5, "one") == [(3, "one")] and snap(20, "one") == [(6, "one")]


def test_as_of_join_spreads_a_hot_key(spark):
    rnd = random.Random(2)
    time = lambda: START + timedelta(seconds=rnd.randrange(500_000))
    left = [("hot" if i % 5 else rnd.choice("abc"), time(), i) for i in range(6000)] + [(None, START, -1), ("hot", None, -2), ("none", time(), -3)]
    right = sorted({("hot" if i % 3 else rnd.choice("abc"), time()) for i in range(1500)})
    right = [(k, t, i) for i, (k, t) in enumerate(right)] + [(None, START - timedelta(days=1), -9)]
    df = spark.createDataFrame(left, "k string, at timestamp, id int")
    got = {r["id"]: r["v"] for r in serving.as_of_join(df, spark.createDataFrame(right, "k string, t timestamp, v int"), ["k"], "at", "t").collect()}
    held = {}
    for k, t, v in sorted((r for r in right if r[0]), key=lambda r: r[1]):
        held.setdefault(k, ([], []))
        held[k][0].append(t)
        held[k][1].append(v)
    from bisect import bisect_right

    for k, t, i in left:
        if i >= 0:
            at = bisect_right(held[k][0], t)
            assert got[i] == (held[k][1][at - 1] if at else None)
    assert got[-2] is None and got[-3] is None and got[-1] == -9 and len(got) == len(left)
    plan = serving.as_of_join(df, spark.createDataFrame(right, "k string, t timestamp, v int"), ["k"], "at", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert all("__b" in line.split("], [")[1] or "__asks" in line for line in plan.splitlines() if "Window [" in line)


@pytest.mark.parametrize("name", ["uniform", "heavy tie", "heavy tail", "few"])
def test_exact_percentiles(spark, name):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(-5, 5, 20_000), "heavy tie": np.where(rng.random(20_000) < 0.6, 7.0, rng.normal(0, 1, 20_000)),
        "heavy tail": np.exp(rng.normal(0, 8, 20_000)) * rng.choice([-1, 1], 20_000), "few": np.array([3.0, 1.0, 2.0]),
    }[name]
    rows = [(["a", "b", None][i % 3], float(v)) for i, v in enumerate(values)] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    at = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in statistics.percentiles(df, "v", at, ["g"]).collect()}
    for g in ("a", "b", None):
        mine = [v for k, v in rows if k == g and v is not None]
        for q in at:
            assert got[g, q] == pytest.approx(np.percentile(mine, 100 * q), rel=1e-12, abs=1e-12)
    assert all(got["empty", q] is None for q in at)
    whole = {r["q"]: r["value"] for r in statistics.percentiles(df, "v", at).collect()}
    assert whole == {q: pytest.approx(np.percentile(values, 100 * q), rel=1e-12, abs=1e-12) for q in at}
    spread = statistics.spread(df, "v").first()
    assert spread["n"] == len(values) and spread["median"] == pytest.approx(np.median(values)) and spread["abs_p99"] == pytest.approx(np.percentile(np.abs(values), 99))


def test_percentiles_do_not_deal_rows_by_few_groups(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(3000).selectExpr("cast(id % 3 as string) as g", "cast(id as double) as v")
        got = statistics.percentile_columns(df, {"m": (F.col("v"), 0.5)}, ["g"])
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r["m"] for r in got.collect()) == [1498.5, 1499.5, 1500.5]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == 3 and plan.count("SortMergeJoin") == 1


def test_last_pass_orders_a_small_part(spark):
    """Four million distinct values: what is put in order at last is a small part of them."""
    df = spark.range(4_000_000).select((F.xxhash64("id") / F.lit(1e10)).alias("v"))
    got = statistics.percentile_columns(df, {"m": (F.col("v"), 0.5), "t": (F.col("v"), 0.999)}).first()
    exact = df.agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.999)))).first()[0]
    assert [got["m"], got["t"]] == pytest.approx(exact, rel=1e-14)


def test_dyadic_nodes_are_few_and_cover_each_tick_once(spark):
    rnd = random.Random(4)
    spans = [(0, 0), (5, 5), (-7, 9), (0, 2**22 - 1), (1, 2**22), (-(2**20) + 3, 5 * 10**6), (3, 4 * 2**31)] + [(a, a + rnd.randrange(3000)) for a in (rnd.randrange(-5000, 5000) for _ in range(40))]
    got = spark.createDataFrame(spans, "lo long, hi long").select("lo", "hi", statistics.dyadic_nodes(F.col("lo"), F.col("hi")).alias("n")).collect()
    for r in got:
        parts = sorted((n["node"] << n["level"], (n["node"] + 1) << n["level"]) for n in r["n"])
        assert parts[0][0] == r["lo"] and parts[-1][1] == r["hi"] + 1 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert len(parts) < 64


def test_overlaps_of_years_and_minutes(spark):
    rnd = random.Random(5)
    rows = [("g" if i % 4 else "h", i, START + timedelta(seconds=(s := rnd.randrange(10**7))), START + timedelta(seconds=s + rnd.choice([0, 30, 90, 3600, 10**5]))) for i in range(400)]
    rows += [("g", 1000 + i, START - timedelta(days=3650), START + timedelta(days=1 + i)) for i in range(5)]
    got = statistics.overlaps(spark.createDataFrame(rows, "g string, id int, start timestamp, end timestamp"), "g", 60)
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3])
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200


def km(a, b):
    return math.sqrt((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2)


def test_nearest_have_no_radius(spark):
    rnd = random.Random(6)
    places = [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(300)] + [(1000 + i, 4.0, 4.0) for i in range(600)] + [(5000, 9e4, -3e5), (5001, -1e6, 2.0)]
    places += [(6000 + i, 500 + i / 1000, 500.0) for i in range(50)]
    points = spark.createDataFrame([(*p, "clash") for p in places] + [(7000, None, 1.0, "")], "id int, x double, y double, rx string")
    seeds = [(0, 4.0, 4.0), (1, 0.1, 9.0), (2, 8e5, 8e5), (3, 500.0, 499.0)]
    near = space.k_nearest(points, spark.createDataFrame(seeds, "seed int, x double, y double"), 7).orderBy("seed", "rank").collect()
    got = [(r["seed"], r["rank"], r["id"], pytest.approx(r["km"])) for r in near]
    want = []
    for s, *at in seeds:
        best = sorted((round(km(at, p[1:]), 9), p[0]) for p in places)[:7]
        want += [(s, i, p, d) for i, (d, p) in enumerate(best, 1)]
    assert got == sorted(want)
    sites = points.select(F.col("id").alias("site"), "x", "y")
    near = {r["site"]: r["km"] for r in space.nearest_other(sites).collect()}
    for i, *at in places[::17] + places[-53:]:
        assert near[i] == pytest.approx(min(km(at, p[1:]) for p in places if p[0] != i))
    assert near[7000] is None and len(near) == len(places) + 1
    few = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], "id int, x double, y double")
    assert [r["id"] for r in space.k_nearest(few, spark.createDataFrame([(9, 50.0, 0.0)], "seed int, x double, y double"), 5).orderBy("rank").collect()] == [2, 1]
    assert space.nearest_other(spark.createDataFrame([(1, 0.0, 0.0)], "site int, x double, y double")).first()["km"] is None


def test_distance_to_any_line(spark):
    rnd = random.Random(7)
    lines = [(x := rnd.uniform(0, 50), y := rnd.uniform(0, 50), x + rnd.uniform(-2, 2), y + rnd.uniform(-2, 2)) for _ in range(80)] + [(0.0, 0.0, 400.0, 300.0), (7.0, 7.0, 7.0, 7.0)]
    spots = [(i, rnd.uniform(-5, 55), rnd.uniform(-5, 55)) for i in range(200)] + [(900, 1e5, 1e5), (901, 7.0, 7.0), (902, 7.0, 7.0)]

    def far(px, py, x1, y1, x2, y2):
        d = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = 0.0 if not d else max(0.0, min(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / d))
        return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))

    points, segments = spark.createDataFrame(spots, "id int, x double, y double"), spark.createDataFrame(lines, "x1 double, y1 double, x2 double, y2 double")
    got = {r["id"]: r["km"] for r in space.distance_to_line(points, segments, "id").collect()}
    assert got == {i: pytest.approx(min(far(x, y, *s) for s in lines), abs=1e-9) for i, x, y in spots}
    assert space.distance_to_line(points, segments.limit(0), "id").filter("km is null").count() == len(spots)


def spaced_brute(rows, d):
    kept, squares = [], {}
    for i, x, y, _ in sorted(rows, key=lambda p: (-p[3], p[0])):
        g = (int(x // d), int(y // d))
        if all(math.sqrt((x - a) ** 2 + (y - b) ** 2) >= d for u in (-1, 0, 1) for v in (-1, 0, 1) for a, b in squares.get((g[0] + u, g[1] + v), ())):
            kept.append(i)
            squares.setdefault(g, []).append((x, y))
    return sorted(kept)


def counted(monkeypatch):
    rounds, decide = [], space._decide
    monkeypatch.setattr(space, "_decide", lambda km: rounds.append(1) or decide(km))
    return rounds


def test_a_chain_of_a_hundred_thousand_points_takes_few_rounds(spark, monkeypatch):
    rounds = counted(monkeypatch)
    points = spark.range(100_000).select(F.col("id").cast("int").alias("top"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"), (-F.col("id")).cast("double").alias("height"))
    got = space.space_out(points, 1.5).agg(F.count("*"), F.sum(F.col("top") % 2)).first()
    assert tuple(got) == (50_000, 0) and len(rounds) < 20


@pytest.mark.parametrize("region", [40, 400, 10**6])
def test_spacing_by_regions_is_the_sequential_rule(spark, monkeypatch, region):
    rounds, rnd = counted(monkeypatch), random.Random(8)
    rows = [(i, rnd.uniform(0, 60), rnd.uniform(0, 60), float(rnd.randint(0, 30))) for i in range(1500)] + [(3000 + i, 30 + rnd.random(), 30 + rnd.random(), float(i % 7)) for i in range(700)]
    got = space.space_out(spark.createDataFrame(rows, "top int, x double, y double, height double"), 1.5, region)
    assert sorted(r["top"] for r in got.collect()) == spaced_brute(rows, 1.5) and len(rounds) < 30
    assert space.space_out(spark.createDataFrame([], "top int, x double, y double, height double"), 1.5).count() == 0


def test_numbers_across_ranges(spark):
    rows = [(i, i * 7919 % 101) for i in range(2000)]
    got = space.numbered(spark.createDataFrame(rows, "a int, b int").repartition(5), [F.desc("b"), F.col("a")], "n").collect()
    assert [r["n"] for r in sorted(got, key=lambda r: (-r["b"], r["a"]))] == list(range(1, 2001))
