"""Many rows in one place: same rows as SQL, and pairs of places instead of pairs of rows."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from towerline import plans
from towerline.operators import space

SF, TIMES = "/root/testdata/sf0.001", 6
LEVELS = ["h18_serves", "h09_histograms", "h08_footprint", "h07_layer_weights", "h10_relation_mass", "h05_received", "h07_best_share", "g29_layer_summary", "h06_best_server"]
COVERAGE = ["h33_largest_villages", "h29_planning_counts", "h32_score_plans", "h31_uncoverable", "h19_served_levels", "h17_coverage", "h28_greedy_cover"]
TOPS = ["h25_proposals", "h27_candidates"]
KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def crowd(tmp_path_factory):
    """The smallest tables several times over: keys shifted by thousands lie in the same places."""
    path, con = tmp_path_factory.mktemp("crowd"), duckdb.connect()
    for t, k in KEYS.items():
        con.execute(f"COPY (SELECT t.* REPLACE ({k} + i * 1000 AS {k}) FROM '{SF}/{t}.parquet' t, range({TIMES}) r(i)) TO '{path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return str(path), con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 3) + 0.0
    return v


def matches(spark, crowd, monkeypatch, name, most):
    """The query's rows are those of its SQL, out of at most so many pairs."""
    pairs, within = [], space.within

    def counted(*args, **kw):
        out = within(*args, **kw)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(space, "within", counted)
    path, con = crowd
    df = plans.QUERIES[name](spark, path)
    cols = sorted(df.columns)
    have = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(plans.ORACLE[name])
    at = [rel.columns.index(c) for c in cols]
    assert have == sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall()) and sorted(rel.columns) == cols and have
    assert pairs and max(pairs) <= most


@pytest.mark.parametrize("name", ["h16_bullington", "h15_profile", "h20_line_of_sight", "h21_nearest_hub"])
def test_paths_are_worked_out_between_places(spark, crowd, monkeypatch, name):
    matches(spark, crowd, monkeypatch, name, 100)


def test_gathered_ids_come_back(spark, monkeypatch):
    monkeypatch.setattr(space, "GATHERED", 10)
    rows = [(0.5, i) for i in range(300)] + [(1.5, 7)]
    arrays = space.gathered(spark.createDataFrame(rows, "x double, id long"), ["x"], "id", "ids")
    assert arrays.count() > 20 and sorted(map(tuple, space.spread(arrays, id="ids").collect())) == sorted(rows)


@pytest.mark.parametrize("name", COVERAGE)
def test_coverage_is_worked_out_between_places(spark, crowd, monkeypatch, name):
    matches(spark, crowd, monkeypatch, name, 400)


@pytest.mark.parametrize("name", LEVELS)
def test_levels_are_worked_out_for_rows_alike(spark, crowd, monkeypatch, name):
    matches(spark, crowd, monkeypatch, name, 300)


@pytest.mark.parametrize("name", TOPS)
def test_tops_meet_villages_between_places(spark, crowd, monkeypatch, name):
    matches(spark, crowd, monkeypatch, name, 60)


def test_a_crowd_asks_once_for_the_nearest_line(spark, monkeypatch):
    met, rings = [], space._rings

    def counted(open_, key, candidates, *rest):
        return rings(open_, key, lambda *a: (met.append((c := candidates(*a)).count()), c)[1], *rest)

    monkeypatch.setattr(space, "_rings", counted)
    points = spark.range(5000).selectExpr("id", "cast(id % 5 as double) as x", "0.0 as y")
    lines = spark.range(40).selectExpr("cast(id as double) as x1", "1.0 as y1", "cast(id + 30 as double) as x2", "cast(id + 1 as double) as y2")
    got = space.distance_to_line(points, lines, "id").groupBy("km").count().collect()
    assert sum(r["count"] for r in got) == 5000 and sum(met) <= 40 * 5 * 4


def test_a_crowd_asks_once_for_its_neighbours(spark, monkeypatch):
    met, rings = [], space._rings

    def counted(open_, key, candidates, *rest):
        return rings(open_, key, lambda *a: (met.append((c := candidates(*a)).count()), c)[1], *rest)

    monkeypatch.setattr(space, "_rings", counted)
    sites = spark.range(4001).selectExpr("id as site", "cast(if(id = 4000, 9, id % 4) as double) as x", "0.0 as y")
    got = {r["km"]: r["count"] for r in space.nearest_other(sites).groupBy("km").count().collect()}
    assert got == {0.0: 4000, 6.0: 1} and sum(met) <= 300


@pytest.mark.parametrize("name", ["h17_coverage", "h18_serves", "h15_profile"])
def test_pairs_are_spread_in_all_tasks(spark, crowd, name):
    rows = plans.QUERIES[name](spark, crowd[0])
    assert rows.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["h05_received", "h07_layer_weights", "h17_coverage", "h18_serves"])
def test_pairs_are_not_shuffled(spark, crowd, name):
    plan = plans.QUERIES[name](spark, crowd[0])._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "RoundRobinPartitioning" not in plan


def test_a_hot_square_is_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(space, "LEAST_WORK", 1)
    left = spark.range(400).selectExpr("id as a", "array(id) as l", "if(id < 390, 0.5, id / 10.0) as x", "0.5 as y")
    right = spark.range(30).selectExpr("id as b", "array(id, -id) as r", "id / 10.0 as rx", "0.6 as ry")
    pairs = lambda df: sorted((r["a"], r["b"], round(r["km"], 9)) for r in df.select("a", "b", "km").collect())
    got = space.within(left, right, 1.0, ids=("l", "r"))
    assert pairs(got) == pairs(space.within(left, right, 1.0))
    assert got.filter("a < 390").select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
