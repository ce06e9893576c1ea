"""How queries over window sums, reports and versions are planned, and that they stay right."""

import os

import pytest
from pyspark.sql import functions as F

from towerline import plans
from towerline.operators import kpis, network, quality
from towerline.plans import gold, sources
from towerline.plans.views import Views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["d27_lte_kpi_hour", "d27_lte_kpi_day", "d27_gsm_kpi_15m", "d27_gsm_kpi_hour", "d27_gsm_kpi_day", "d04_gsm_cell_15m"])
def test_window_sums_are_hashed(spark, name):
    text = plan(plans.QUERIES[name](spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text and "filter(array(" not in text


def test_long_rows_are_summed_before_they_meet_cells(spark):
    lines = plan(plans.QUERIES["d04_gsm_cell_15m"](spark, SF)).splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line and ("cell_dn#" in line or "__dn#" in line)]
    assert below and all("HashAggregate" in line for line in below)


def test_cells_of_several_entries_are_summed_again(spark):
    a, b = kpis.GSM_COUNTERS["tch_req"], kpis.GSM_COUNTERS["ho_in"]
    rows = [("e", "d1", a, 1.0, "v", False), ("e", "d1", b, 2.0, "v", None), ("e", "d2", a, 4.0, "u", True), ("e", "d3", a, 8.0, "w", False), ("e", "d3", "else", 16.0, "w", True), ("f", "d3", a, 32.0, "w", False), ("e", "d4", a, None, None, None), (None, "d1", a, 64.0, "a", True)]
    rows = spark.createDataFrame(rows, "ems string, cell_dn string, measurement string, value double, vendor string, suspect boolean").selectExpr("*", "timestamp_ntz'2024-03-01 00:00:00' as period_start")
    cells = [("e", "d1", "c", "GSM"), ("e", "d2", "c", "GSM"), ("e", "d3", "x", "GSM"), ("e", "d3", "y", "GSM"), ("e", "d4", "z", "GSM"), ("f", "d3", "l", "LTE"), (None, "d1", "n", "GSM")]
    got = kpis.cell_counters(rows, spark.createDataFrame(cells, "ems string, dn string, cell_name string, technology string"), "GSM").collect()
    want = {"c": (5.0, 2.0, "u", True, True), "x": (8.0, None, "w", True, True), "y": (8.0, None, "w", True, True), "z": (None, None, None, False, None)}
    assert len(got) == len(want) and {r["cell_name"]: (r["tch_req"], r["ho_in"], r["vendor"], r["reported"], r["suspect"]) for r in got} == want


def test_least_vendor_of_a_window(spark):
    rows = [("c", "b", 1.0), ("c", None, 2.0), ("c", "ab", 4.0), ("d", None, 8.0), ("e", "b", 16.0)]
    wide = spark.createDataFrame(rows, "cell_name string, vendor string, tch_req double").selectExpr("*", "timestamp_ntz'2024-03-01 00:00:00' as period_start", "true as reported", "false as suspect")
    got = {r["cell_name"]: (r["vendor"], r["tch_req"], r["periods_reported"]) for r in kpis.window_sums(wide, "GSM", "15m").collect()}
    assert got == {"c": ("ab", 7.0, 3), "d": (None, 8.0, 1), "e": ("b", 16.0, 1)}
    none = kpis.window_sums(wide.filter("cell_name = 'd'"), "GSM", "15m").collect()
    assert [(r["vendor"], r["tch_req"]) for r in none] == [(None, 8.0)] and kpis.window_sums(wide.filter("false"), "GSM", "15m").count() == 0


@pytest.mark.parametrize("name", ["d33_worst_cells_week", "d39_worst_summary"])
def test_worst_cells_join_nothing(spark, name):
    text = plan(plans.QUERIES[name](spark, SF))
    assert "Join" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("n, floor", [(1, 0.0), (2, 0.0), (0, 0.02)])
def test_worst_cells_of_sums_are_those_of_rows(spark, n, floor):
    sums = kpis.window_sums(Views(spark, SF).wide().withColumn("cell_name", F.substring("cell_name", 2, 1)), "GSM", "day").persist()
    rows = lambda s, g: kpis.kpi_rows(s, kpis.wanted("GSM"), kpis.periods_expected(g, 15))
    days = rows(sums, "day").withColumnRenamed("period", "day").withColumn("value", F.round("value", 9))
    weeks = rows(kpis.week_sums(sums), "week").withColumnRenamed("period", "week_start")
    want = kpis.worst_cells_week(days, weeks, kpis.kpi_catalog(spark), persistence_n=n, min_coverage=floor)
    got = kpis.worst_cells_of_sums(sums, kpis.wanted("GSM"), persistence_n=n, min_coverage=floor, digits=9)
    assert got.columns == want.columns
    fixed = lambda df: sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in df.collect())
    assert fixed(got) == fixed(want) and got.count() > 100
    sums.unpersist()


def test_compare_takes_what_the_reference_has(spark, monkeypatch):
    seen = []
    compare = network.compare
    monkeypatch.setattr(network, "compare", lambda gold_, ref, **kw: (seen.append(gold_), compare(gold_, ref, **kw))[1])
    assert plans.QUERIES["d40_compare"](spark, SF).count() == len(gold._REFERENCE)
    assert {r[0] for r in seen[0].select("kpi_id").distinct().collect()} == set(gold._REFERENCE)


def test_conflicts_read_values_once(spark):
    text = plan(plans.QUERIES["c05_with_conflict"](spark, SF))
    assert text.count("l_suppkey") and text.count("FileScan parquet [l_") <= 3


def test_conflicts_are_those_of_joins(spark):
    x, y, n = 1.0, 2.0, None
    values = [("e", "f", h, k, v) for k, vs in enumerate([(x, x, x), (x, x, y), (y, x, x), (n, x, x), (x, n, x), (n, n, n), (n, n, x), (float("nan"), float("nan"), x)]) for h, v in zip("abc", vs, strict=True)]
    values += [("e", "f", "a", 20, x), ("e", "f", "c", 21, x), ("e", "f", "a", None, x), ("e", "f", "c", None, y), ("e", "g", "a", 1, x), ("e", "g", "c", 1, y), ("e", "h", "a", 1, x), ("e", None, "a", 1, x)]
    v = spark.createDataFrame(values, "ems string, file_name string, file_hash string, k int, value double")
    s = spark.createDataFrame([("e", "f", "c", 3, True), ("e", "g", "a", 1, False), ("e", "h", None, 0, False)], "ems string, file_name string, latest_hash string, versions int, late boolean")
    want = set()
    for e, f, h, k, a in values:
        for e2, f2, h2, k2, b in values:
            same = a == b or (a != a and b != b and a is not None and b is not None)
            if f == f2 == "f" and k is not None and k == k2 and h == "c" and h2 != "c" and not same:
                want.add(k)
    found = quality.conflicts(v, s, ["k"])
    assert sorted(r["k"] for r in found.collect()) == sorted(want) and len(want) > 2
    plain = quality.with_conflict(quality.latest_version(v, s), found, ["k"])
    one = quality.latest_with_conflict(v, s, ["k"]).select(*plain.columns)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, plain.collect()))


def test_collections_are_made_once(spark, monkeypatch):
    """For the number of files they are not counted but estimated."""
    hours = sources._hours

    class Uncounted:
        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            assert name != "count"
            return getattr(self.df, name)

    monkeypatch.setattr(sources, "_hours", lambda v: Uncounted(hours(v)))
    v = Views(spark, SF)
    path, n = sources.pm_files(v, True), hours(v).count()
    assert abs(sources._about(v) / n - 1) < 0.1
    assert spark.read.text(path).select(F.regexp_count("value", F.lit("<measCollecFile>")).alias("n")).agg(F.sum("n")).first()[0] == n
