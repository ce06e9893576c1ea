"""Queries of the radio, geometry and planning operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import radio
from ..operators import space as sp
from ..operators import statistics as st
from .registry import register, rounded
from .views import Views, place_sql

RASTER_N, STEP = 60, 100 / 59


def points(v: Views):
    """Customers as points with users and environment weights."""
    p = v.place("customer", "c_custkey", "point")
    density = F.abs("c_acctbal")
    u, s = radio.environment_weights(density)
    return p.select("point", "x", "y", u.alias("urban"), s.alias("suburban"), (F.col("c_nationkey") + 1).cast("double").alias("users"))


def cells(v: Views):
    c = v.place("supplier", "s_suppkey", "cell")
    return c.select("cell", F.col("x").alias("rx"), F.col("y").alias("ry"), F.lit(46.0).alias("power_dbm"), (F.lit(20.0) + F.col("s_nationkey") % 5 * 5).alias("mast_m"), ((F.col("cell") * 53) % 360).cast("double").alias("azimuth"), F.lit(4.0).alias("tilt"))


def villages(v: Views):
    return v.place("part", "p_partkey", "village").select("village", "x", "y", (F.col("p_size") * 100).alias("population"))


def sites(v: Views):
    return v.place("supplier", "s_suppkey", "site").select("site", "x", "y")


def raster(v: Views):
    r = v.spark.range(RASTER_N).select(F.col("id").cast("int").alias("row")).crossJoin(v.spark.range(RASTER_N).select(F.col("id").cast("int").alias("col")))
    return r.withColumn("height", 200 + 40 * F.sin(F.col("row") / 7.0) + 40 * F.cos(F.col("col") / 5.0))


RASTER = f"raster AS (SELECT r::INT AS row, c::INT AS col, 200 + 40 * sin(r / 7.0) + 40 * cos(c / 5.0) AS height FROM range({RASTER_N}) a(r), range({RASTER_N}) b(c))"
PTS = f"pts AS (SELECT point, x, y, greatest(0.0, least(1.0, (abs(c_acctbal) - 850) / 2050)) AS urban, greatest(0.0, least(1.0, (abs(c_acctbal) - 425) / 425)) * (1 - greatest(0.0, least(1.0, (abs(c_acctbal) - 850) / 2050))) AS suburban, (c_nationkey + 1)::DOUBLE AS users FROM {place_sql('customer', 'c_custkey', 'point')})"
CELLS = f"cel AS (SELECT cell, x AS rx, y AS ry, 20.0 + s_nationkey % 5 * 5 AS mast, (cell * 53) % 360 AS azimuth FROM {place_sql('supplier', 's_suppkey', 'cell')})"
VIL = f"vil AS (SELECT village, x, y, p_size * 100 AS population FROM {place_sql('part', 'p_partkey', 'village')})"
SITES = f"sit AS (SELECT site, x, y FROM {place_sql('supplier', 's_suppkey', 'site')})"
_LOSS = """(69.55 + 26.16 * log10(942.5) - ((1.1 * log10(942.5) - 0.7) * 1.5 - (1.56 * log10(942.5) - 0.8)) - 13.82 * log10({h}) + (44.9 - 6.55 * log10({h})) * log10(greatest({d}, 0.02)))"""


def loss_sql(d: str, h: str, u: str, s: str) -> str:
    med = _LOSS.format(d=d, h=h)
    return f"greatest({u} * {med} + {s} * ({med} - 2 * pow(log10(942.5 / 28), 2) - 5.4) + (1 - {u} - {s}) * ({med} - 4.78 * pow(log10(942.5), 2) + 18.33 * log10(942.5) - 40.94), 32.45 + 20 * log10(942.5) + 20 * log10(greatest({d}, 0.02)))"


GAIN = "14 - least(least(12 * pow(({a}) / 70, 2), 25) + least(12 * pow(({t}) / 10, 2), 20), 25)"
_AZ = "(((degrees(atan2(x - rx, y - ry)) - azimuth + 180) % 360 + 360) % 360 - 180)"
_TILT = "degrees(atan2(mast - 1.5, greatest(km, 0.02) * 1000)) - 4"
LEVELS = f"""{PTS}, {CELLS}, pr AS (SELECT *, sqrt((x - rx) * (x - rx) + (y - ry) * (y - ry)) AS km FROM pts, cel),
levels AS (SELECT point, cell, km, 46 + {GAIN.format(a=_AZ, t=_TILT)} - {loss_sql('km', 'mast', 'urban', 'suburban')} AS level FROM pr WHERE km <= 8)"""
BEST = """rk AS (SELECT *, row_number() OVER (PARTITION BY point ORDER BY round(level, 9) DESC, cell) AS n FROM levels),
best AS (SELECT point, max(cell) FILTER (WHERE n = 1) AS best, max(level) FILTER (WHERE n = 1) AS level, max(cell) FILTER (WHERE n = 2) AS second, max(level) FILTER (WHERE n = 2) AS second_level,
 10 * log10(pow(10, max(level) FILTER (WHERE n = 1) / 10) / (coalesce(sum(pow(10, level / 10)) FILTER (WHERE n > 1), 0) + pow(10, -12.32))) AS sinr_db, max(level) FILTER (WHERE n = 1) >= -110 AS covered FROM rk GROUP BY point)"""


KM, MHZ = 8.0, 942.5


def levels(v: Views):
    """By points alike and cells alike (see `each_pair`)."""
    return sp.received(points(v), cells(v), KM, MHZ)


def each_pair(rows):
    return sp.spread(rows, point="points", cell="cells").select("point", "cell", *[c for c in rows.columns if c not in ("points", "cells")])


def best(v: Views):
    p = points(v)
    won = sp.best_server(sp.in_reach(p.select(*sp.POINT).distinct(), sp.alike(cells(v), sp.CELL), KM, MHZ), sp.POINT, -110.0)
    return p.select("point", *sp.POINT).join(won, sp.POINT).drop(*sp.POINT)


def layer_weights(v: Views):
    """Each cell is a layer; its bandwidth sets it apart from cells alike."""
    p, c = points(v), cells(v).withColumn("mhz", (F.col("cell") % 3 * 5 + 5).cast("double"))
    layer = [*sp.CELL, "mhz"]
    totals = sp.layer_totals(sp.in_reach(p.select(*sp.POINT).distinct(), sp.alike(c, layer), KM, MHZ), sp.POINT)
    rows = sp.in_reach(sp.gathered(p, sp.POINT, "point", "points").join(totals, sp.POINT), sp.gathered(c, layer, "cell", "cells"), KM, MHZ, ("points", "cells"))
    share = sp.layer_share(F.col("level"), F.col("strongest"), F.col("mhz")) / F.nullif(F.col("total"), F.lit(0.0))
    return each_pair(rounded(rows.select("points", "cells", share.alias("weight")), 6)).withColumnRenamed("cell", "band")


register("h01_path_loss", lambda v: rounded(points(v).select("point", radio.path_loss_db(942.5, F.col("x") / 10 + 0.1, F.lit(30.0), F.col("urban"), F.col("suburban")).alias("loss")), 6), f"WITH {PTS} SELECT point, round({loss_sql('(x / 10 + 0.1)', '30.0', 'urban', 'suburban')}, 6) AS loss FROM pts")
register("h02_antenna_gain", lambda v: rounded(points(v).select("point", radio.antenna_gain_db(F.col("x") * 7 - 300, F.col("y") / 10 - 5).alias("gain")), 6), f"WITH {PTS} SELECT point, round({GAIN.format(a='((x * 7 - 300 + 180) % 360 + 360) % 360 - 180', t='y / 10 - 5')}, 6) AS gain FROM pts")
_EFF = "[0.1523, 0.2344, 0.3770, 0.6016, 0.8770, 1.1758, 1.4766, 1.9141, 2.4063, 2.7305, 3.3223, 3.9023, 4.5234, 5.1152, 5.5547]"
register("h03_efficiency_and_cqi", lambda v: rounded(points(v).select("point", radio.spectral_efficiency(F.col("x") / 2 - 15).alias("se"), radio.cqi(F.col("x") / 2 - 15).alias("cqi")), 6), f"WITH {PTS}, s AS (SELECT point, x / 2 - 15 AS s FROM pts) SELECT point, round(CASE WHEN s < -10 THEN 0.0 ELSE least(0.6 * log2(1 + pow(10, s / 10)), 4.4) END, 6) AS se, len(list_filter({_EFF}, lambda e: e <= log2(1 + pow(10, s / 10))))::INT AS cqi FROM s")
register("h04_area_and_weights", lambda v: rounded(v.table("customer").select("c_custkey", radio.area_class(F.abs("c_acctbal")).alias("area"), radio.environment_weights(F.abs("c_acctbal"))[0].alias("urban"), radio.environment_weights(F.abs("c_acctbal"))[1].alias("suburban")), 6), f"WITH {PTS} SELECT point AS c_custkey, CASE WHEN abs(c_acctbal) >= 2900 THEN 'urban' WHEN abs(c_acctbal) >= 850 THEN 'suburban' ELSE 'rural' END AS area, round(urban, 6) AS urban, round(suburban, 6) AS suburban FROM pts JOIN customer ON point = c_custkey")
register("h05_received", lambda v: each_pair(rounded(levels(v), 4)), f"WITH {LEVELS} SELECT point, cell, round(km, 4) AS km, round(level, 4) AS level FROM levels")
register("h06_best_server", lambda v: rounded(best(v), 4), f"WITH {LEVELS}, {BEST} SELECT point, best, round(level, 4) AS level, second, round(second_level, 4) AS second_level, round(sinr_db, 4) AS sinr_db, covered FROM best")
register("h07_best_share", lambda v: rounded(best(v).select("point", sp.best_share(F.col("level"), F.col("second_level"), -110.0).alias("share")), 6), f"WITH {LEVELS}, {BEST} SELECT point, round(CASE WHEN coalesce(second_level >= -110, false) THEN 0.5 * (1 + tanh((level - second_level) / 6)) ELSE 1.0 END, 6) AS share FROM best")
register("h07_layer_weights", layer_weights, f"WITH {LEVELS}, m AS (SELECT *, (cell % 3 * 5 + 5)::DOUBLE AS mhz, max(level) OVER (PARTITION BY point) AS top FROM levels), r AS (SELECT point, cell AS band, mhz * 0.5 * (1 + tanh((level - top + 8) / 6)) * 0.5 * (1 + tanh((level + 110) / 6)) AS raw FROM m) SELECT point, band, round(raw / sum(raw) OVER (PARTITION BY point), 6) AS weight FROM r")
register("h08_footprint", lambda v: rounded(sp.footprint(best(v), points(v)), 4), f"WITH {LEVELS}, {BEST}, b AS (SELECT * FROM best JOIN pts USING (point) WHERE covered) SELECT best AS cell, count(*) AS points, round(sum(users), 4) AS users, round(sum(users * sinr_db) / sum(users), 4) AS sinr_db, round(sum(CASE WHEN sinr_db < 0 THEN users ELSE 0 END) / sum(users), 4) AS edge_share FROM b GROUP BY 1")
register("h09_histograms", lambda v: rounded(sp.histogram(best(v).filter("covered").join(points(v).select("point", "users"), "point"), "best", radio.cqi(F.col("sinr_db")), "users"), 4), f"WITH {LEVELS}, {BEST} SELECT best, len(list_filter({_EFF}, lambda e: e <= log2(1 + pow(10, sinr_db / 10))))::INT AS bin, round(sum(users), 4) AS weight FROM best JOIN pts USING (point) WHERE covered GROUP BY 1, 2")
register("h10_relation_mass", lambda v: rounded(sp.relation_mass(best(v), points(v)), 4), f"WITH {LEVELS}, {BEST} SELECT best AS source, second AS target, round(sum(users), 4) AS mass FROM best JOIN pts USING (point) WHERE covered AND level - second_level <= 6 GROUP BY 1, 2")
register("h11_erlang_b", lambda v: rounded(v.table("part").select("p_partkey", radio.erlang_b(F.col("p_retailprice") / 100, F.col("p_size")).alias("b")), 6), "SELECT p_partkey, round(list_reduce(list_prepend(1.0::DOUBLE, range(1, p_size + 1)::DOUBLE[]), lambda b, k: (p_retailprice / 100) * b / (k + (p_retailprice / 100) * b)), 6) AS b FROM part")
def _shares(v: Views):
    li = v.table("lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    per = v.table("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("all"))
    total = v.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.floor("o_totalprice").cast("double").alias("total"))
    return li.join(per, "l_orderkey").join(total, "l_orderkey").select("l_orderkey", "l_suppkey", "total", (F.col("q") / F.col("all")).alias("share"))


register("h12_apportion", lambda v: sp.apportion(_shares(v), "l_orderkey", "l_suppkey", "total", "share").select("l_orderkey", "l_suppkey", "part"),
         "WITH q AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), s AS (SELECT l_orderkey, l_suppkey, floor(o_totalprice) AS total, q / sum(q) OVER (PARTITION BY l_orderkey) AS share FROM q JOIN orders ON o_orderkey = l_orderkey), u AS (SELECT *, round_even(total * round(sum(share) OVER (PARTITION BY l_orderkey ORDER BY l_suppkey), 12), 0) AS u FROM s) SELECT l_orderkey, l_suppkey, (u - coalesce(lag(u) OVER (PARTITION BY l_orderkey ORDER BY l_suppkey), 0))::BIGINT AS part FROM u")
_SEG = f"seg AS (SELECT x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM {place_sql('supplier', 's_suppkey', 'site')} WINDOW w AS (PARTITION BY s_nationkey ORDER BY site) QUALIFY x2 IS NOT NULL)"


def segments(v: Views):
    """A line through the sites of each nation."""
    w = Window.partitionBy("s_nationkey").orderBy("site")
    return v.place("supplier", "s_suppkey", "site").select(F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2")).dropna()


register("h13_distance_to_line", lambda v: rounded(sp.distance_to_line(villages(v), segments(v), "village"), 6), f"WITH {VIL}, {_SEG}, t AS (SELECT village, x, y, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, greatest(0.0, least(1.0, coalesce(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0))) AS t FROM vil, seg) SELECT village, round(min(sqrt(pow(x - x1 - t * dx, 2) + pow(y - y1 - t * dy, 2))), 6) AS km FROM t GROUP BY 1")


def height_sql(source: str, cols: str) -> str:
    return f"""gp AS (SELECT {cols}, x, y, greatest(0.0, least(x / {STEP!r}, {RASTER_N - 1}.0)) AS gx, greatest(0.0, least(y / {STEP!r}, {RASTER_N - 1}.0)) AS gy FROM {source}),
gh AS (SELECT {cols}, x, y, (a.height * (1 - (gx - floor(gx))) + b.height * (gx - floor(gx))) * (1 - (gy - floor(gy))) + (c.height * (1 - (gx - floor(gx))) + d.height * (gx - floor(gx))) * (gy - floor(gy)) AS ground_m FROM gp
 JOIN raster a ON a.row = floor(gy) AND a.col = floor(gx) JOIN raster b ON b.row = floor(gy) AND b.col = least(floor(gx) + 1, {RASTER_N - 1})
 JOIN raster c ON c.row = least(floor(gy) + 1, {RASTER_N - 1}) AND c.col = floor(gx) JOIN raster d ON d.row = least(floor(gy) + 1, {RASTER_N - 1}) AND d.col = least(floor(gx) + 1, {RASTER_N - 1}))"""


def at_height(v: Views, p):
    return sp.height_at(p, raster(v), STEP, RASTER_N, RASTER_N)


register("h14_height_at", lambda v: rounded(at_height(v, villages(v)).select("village", "ground_m"), 6), f"WITH {RASTER}, {VIL}, {height_sql('vil', 'village')} SELECT village, round(ground_m, 6) AS ground_m FROM gh")


def ways(v: Views):
    """Each place of a site to the places of sites within 12 km: heights depend on no more."""
    s = sites(v).select("x", "y").distinct()
    near = sp.within(s, s.select(F.col("x").alias("rx"), F.col("y").alias("ry")), 12.0)
    return near.select(F.struct(F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("rx").alias("x2"), F.col("ry").alias("y2")).alias("path"), "km").select("path", "path.*", "km")


def between_sites(v: Views, rows):
    """Rows of ways for each site to the sites after it."""
    at = lambda x, y, ids: sp.gathered(sites(v).withColumnsRenamed({"x": x, "y": y}), [x, y], "site", ids)
    met = rows.select(*[c for c in rows.columns if c != "path"], "path.*").join(at("x1", "y1", "sites"), ["x1", "y1"]).join(at("x2", "y2", "hubs"), ["x2", "y2"])
    each = sp.spread(sp.dealt(met), site="sites").withColumn("hubs", F.filter("hubs", lambda h: h > F.col("site")))
    return sp.spread(each, hub="hubs").select((F.col("site") * 100000 + F.col("hub")).alias("path"), *[c for c in rows.columns if c != "path"])


PATHS = f"{SITES}, path AS (SELECT * FROM (SELECT a.site * 100000 + b.site AS path, a.site AS site, b.site AS hub, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS km, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM sit a, sit b WHERE a.site < b.site) WHERE km <= 12)"
PROFILE = f"{RASTER}, {PATHS}, st AS (SELECT path, km AS total, i, x1 + (x2 - x1) * (i / 20.0) AS x, y1 + (y2 - y1) * (i / 20.0) AS y FROM path, range(21) r(i)), {height_sql('st', 'path, total, i')}, prof AS (SELECT path, i, total, total * (i / 20.0) AS km, ground_m, max(ground_m) FILTER (WHERE i = 0) OVER (PARTITION BY path) + 30 AS tx, max(ground_m) FILTER (WHERE i = 20) OVER (PARTITION BY path) + 40 AS rx FROM gh)"


def profiles(v: Views):
    p = sp.profile(ways(v), raster(v), 21, STEP, RASTER_N, RASTER_N)
    ends = p.groupBy("path").agg((F.max(F.when(F.col("i") == 0, F.col("ground_m"))) + 30).alias("tx_m"), (F.max(F.when(F.col("i") == 20, F.col("ground_m"))) + 40).alias("rx_m"))
    return p.select("path", "i", "km", "total_km", "ground_m").join(ends, "path")


def profile_rows(v: Views):
    steps = rounded(profiles(v).select("path", "i", "km", "ground_m"), 5).groupBy("path").agg(F.collect_list(F.struct("i", "km", "ground_m")).alias("steps"))
    return between_sites(v, steps).select("path", F.inline("steps"))


CLEAR = "clear AS (SELECT path, bool_and(tx + (rx - tx) * km / total - (ground_m + 500 * km * (total - km) / 8500) >= 0.6 * 17.3 * sqrt(km * (total - km) / (8 * total))) AS clear FROM prof WHERE km > 1e-9 AND km < total - 1e-9 GROUP BY 1)"
register("h15_profile", profile_rows, f"WITH {PROFILE} SELECT path, i::INT AS i, round(km, 5) AS km, round(ground_m, 5) AS ground_m FROM prof")
_J = "CASE WHEN v > -0.78 THEN 6.9 + 20 * log10(sqrt((v - 0.1) * (v - 0.1) + 1) + v - 0.1) ELSE 0 END"
register("h16_bullington", lambda v: between_sites(v, rounded(sp.bullington_db(profiles(v), 942.5), 4)), f"""WITH {PROFILE}, q AS (SELECT *, ground_m + 500 * km * (total - km) / 8500 AS hc FROM prof WHERE km > 1e-9 AND km < total - 1e-9),
m AS (SELECT path, max((hc - tx) / km) AS s1, max((hc - rx) / (total - km)) AS s2, max((hc - (tx * (total - km) + rx * km) / total) * sqrt(0.002 * total / (299.792458 / 942.5 * km * (total - km)))) AS v0, max(total) AS d, max(tx) AS a, max(rx) AS b FROM q GROUP BY 1),
n AS (SELECT *, greatest(1e-6, least(d - 1e-6, (b - a + s2 * d) / greatest(s1 + s2, 1e-9))) AS p FROM m),
k AS (SELECT path, d, CASE WHEN s1 < (b - a) / d THEN v0 ELSE (a + s1 * p - (a * (d - p) + b * p) / d) * sqrt(0.002 * d / (299.792458 / 942.5 * p * (d - p))) END AS v FROM n), l AS (SELECT path, d, {_J} AS j FROM k)
SELECT path, round(j + (1 - exp(-j / 6)) * (10 + 0.02 * d), 4) AS loss_db FROM l""")


def coverage(v: Views, village_rows=None, site_rows=None, ids=None):
    """Places of villages in reach of a site's, LTE and GSM, and whether the level is above
    the indoor one: (x, y, rx, ry, technology, km, level, covered).  Other columns of
    village_rows and site_rows stay (ids: as in `within`)."""
    vil = villages(v).select("x", "y").distinct() if village_rows is None else village_rows
    sit = (sites(v).select("x", "y").distinct() if site_rows is None else site_rows).withColumnsRenamed({"x": "rx", "y": "ry"})
    near = sp.within(vil, sit, KM, ids=ids)
    loss = radio.path_loss_db(MHZ, F.col("km"), F.lit(30.0), F.lit(0.0), F.lit(0.0))
    both = F.explode(F.array(F.struct(F.lit("LTE").alias("technology"), (46.0 - 27.78 + 14 - loss).alias("level"), F.lit(-110.0).alias("floor")), F.struct(F.lit("GSM").alias("technology"), (43.0 + 14 - loss).alias("level"), F.lit(-100.0).alias("floor"))))
    rows = near.withColumn("t", both)
    return rows.select(*near.columns, "t.technology", "t.level", (F.col("t.level") >= F.col("t.floor") + 14.2).alias("covered"))


def coverage_rows(v: Views):
    at = lambda rows, name: sp.gathered(rows, ["x", "y"], name, name + "s")
    rows = rounded(coverage(v, at(villages(v), "village"), at(sites(v), "site"), ("villages", "sites")).select("sites", "villages", "technology", "km", "level", "covered"), 4)
    return sp.spread(rows, site="sites", village="villages").select("site", "village", "technology", "km", "level", "covered")


COV = f"{VIL}, {SITES}, nr AS (SELECT site, village, sqrt(pow(v.x - s.x, 2) + pow(v.y - s.y, 2)) AS km FROM vil v, sit s), cv AS (SELECT site, village, km, {loss_sql('km', '30.0', '0.0', '0.0')} AS loss FROM nr WHERE km <= 8), cov AS (SELECT site, village, 'LTE' AS technology, km, 32.22 - loss AS level, 32.22 - loss >= -95.8 AS covered FROM cv UNION ALL SELECT site, village, 'GSM', km, 57 - loss, 57 - loss >= -85.8 FROM cv)"


def covered_places(v: Views):
    """Places of a village and of a site that covers it."""
    return coverage(v).filter("covered").select("x", "y", "rx", "ry").distinct()


def covered_villages(v: Views):
    return villages(v).join(covered_places(v).select("x", "y").distinct(), ["x", "y"], "left_semi").select("village")


def covered(v: Views):
    return coverage_rows(v).filter("covered").select("site", "village").distinct()


def cover_classes(v: Views):
    """Of the sites in one place the lowest covers what all of them do; villages in one place
    are covered together: (site, village, n)."""
    vil = villages(v).groupBy("x", "y").agg(F.min("village").alias("village"), F.count("*").alias("n"))
    sit = sites(v).groupBy("x", "y").agg(F.min("site").alias("site"))
    return coverage(v, vil, sit).filter("covered").select("site", "village", "n").distinct()


register("h17_coverage", coverage_rows, f"WITH {COV} SELECT site, village, technology, round(km, 4) AS km, round(level, 4) AS level, covered FROM cov")
register("h18_serves", lambda v: each_pair(levels(v).select("points", "cells", radio.serves(F.col("level"), -110.0).alias("served"))), f"WITH {LEVELS} SELECT point, cell, level >= -95.8 AS served FROM levels")
register("h19_served_levels", lambda v: rounded(sp.served_levels(coverage(v), villages(v)), 4), f"WITH {COV} SELECT village, round(max(level) FILTER (WHERE technology = 'LTE'), 4) AS \"LTE\", round(max(level) FILTER (WHERE technology = 'GSM'), 4) AS \"GSM\" FROM vil LEFT JOIN cov USING (village) GROUP BY 1")
register("h20_line_of_sight", lambda v: between_sites(v, sp.line_of_sight(profiles(v), 0.6)), f"WITH {PROFILE}, {CLEAR} SELECT * FROM clear")
register("h21_nearest_hub", lambda v: rounded(sp.nearest_hub(sites(v), ways(v).join(sp.line_of_sight(profiles(v), 0.6).filter("clear"), "path").select("x1", "y1", "x2", "y2", "km")), 4), f"WITH {PROFILE}, {CLEAR} SELECT site, arg_min(hub, (round(p.km, 9), hub)) AS hub, round(min(p.km), 4) AS km FROM path p JOIN clear c USING (path) WHERE clear GROUP BY 1")
_OPT = f"{SITES}, o AS (SELECT site, x / 10 AS fiber_km, y / 10 AS grid_km, CASE WHEN site % 2 = 0 THEN site + 1 END AS hub, x / 4 AS hop_km FROM sit)"


def option_rows(v: Views):
    s = sites(v)
    return sp.options(s.select("site", (F.col("x") / 10).alias("fiber_km"), (F.col("y") / 10).alias("grid_km"), F.when(F.col("site") % 2 == 0, F.col("site") + 1).alias("hub"), (F.col("x") / 4).alias("hop_km")))


OPTIONS = f"""{_OPT}, opt AS (SELECT site, 'fiber' AS kind, true AS available, round(fiber_km, 3)::DOUBLE AS distance_km, 10000.0::DOUBLE AS mbps, round_even(150000000 * fiber_km, 0)::BIGINT AS capex, 3000000::BIGINT AS monthly FROM o
UNION ALL SELECT site, 'microwave', hub IS NOT NULL, CASE WHEN hub IS NOT NULL THEN round(hop_km, 3) ELSE 0 END, CASE WHEN hub IS NOT NULL THEN 400 ELSE 0 END, CASE WHEN hub IS NOT NULL THEN 350000000 ELSE 0 END, CASE WHEN hub IS NOT NULL THEN 2000000 ELSE 0 END FROM o
UNION ALL SELECT site, 'satellite', true, 0, 8, 150000000, 25000000 FROM o UNION ALL SELECT site, 'grid_power', grid_km <= 5, round(grid_km, 3), 0, round_even(250000000 * grid_km, 0)::BIGINT, 6000000 FROM o
UNION ALL SELECT site, 'solar_power', grid_km > 5, 0, 0, 650000000, 1500000 FROM o)"""
register("h22_options", option_rows, f"WITH {OPTIONS} SELECT site, kind, available, distance_km::DOUBLE AS distance_km, mbps::DOUBLE AS mbps, capex::BIGINT AS capex, monthly::BIGINT AS monthly FROM opt")
register("h23_village_attributes", lambda v: sp.village_attributes(villages(v)).select("village", "schools", sp.build_cost(F.col("x")).alias("cost")), f"WITH {VIL} SELECT village, CASE WHEN population > 500 THEN greatest(round_even(population / 1500.0, 0), 1) ELSE round_even(population / 1500.0, 0) END::INT AS schools, (1800000000 + round_even(120000000 * x, 0))::BIGINT AS cost FROM vil")
HEIGHTS_N = 20


def heights(v: Views):
    """A raster out of the line items: what was ordered of each square's items."""
    at = lambda c: (F.col(c) % HEIGHTS_N).cast("int")
    return v.table("lineitem").groupBy(at("l_orderkey").alias("row"), at("l_partkey").alias("col")).agg(F.sum("l_quantity").cast("double").alias("height"))


register("h24_high_points", lambda v: rounded(sp.high_points(heights(v), 3)), f"WITH h AS (SELECT (l_orderkey % {HEIGHTS_N})::INT AS row, (l_partkey % {HEIGHTS_N})::INT AS col, sum(l_quantity)::DOUBLE AS height FROM lineitem GROUP BY 1, 2) SELECT a.row, a.col, round(a.height, 6) AS height FROM h a JOIN h b ON b.row BETWEEN a.row - 3 AND a.row + 3 AND b.col BETWEEN a.col - 3 AND a.col + 3 WHERE a.row BETWEEN 3 AND {HEIGHTS_N - 4} AND a.col BETWEEN 3 AND {HEIGHTS_N - 4} GROUP BY 1, 2, a.height HAVING max(b.height) = a.height")


def tops(v: Views):
    return v.place("supplier", "s_suppkey", "top").select("top", "x", "y", F.round("s_acctbal", 2).alias("height"))


TOPS = f"tops AS (SELECT top, x, y, round(s_acctbal, 2) AS height FROM {place_sql('supplier', 's_suppkey', 'top')})"
register("h25_proposals", lambda v: sp.proposals(tops(v), villages(v)).select("top"), f"WITH {TOPS}, {VIL}, n AS (SELECT village, top, height FROM tops t, vil v WHERE sqrt(pow(t.x - v.x, 2) + pow(t.y - v.y, 2)) <= 3) SELECT DISTINCT top FROM (SELECT top, row_number() OVER (PARTITION BY village ORDER BY height DESC, top) AS r FROM n) WHERE r = 1")
register("h26_space_out", lambda v: sp.space_out(tops(v), 6.0).select("top"), f"""WITH RECURSIVE {TOPS}, o AS (SELECT top, x, y, row_number() OVER (ORDER BY height DESC, top) AS i FROM tops),
r AS (SELECT 0::BIGINT AS i, []::STRUCT(top BIGINT, x DOUBLE, y DOUBLE)[] AS kept
 UNION ALL SELECT o.i, CASE WHEN len(list_filter(kept, lambda k: sqrt(pow(k.x - o.x, 2) + pow(k.y - o.y, 2)) < 6)) = 0 THEN list_append(kept, {{'top': o.top::BIGINT, 'x': o.x::DOUBLE, 'y': o.y::DOUBLE}}) ELSE kept END FROM r JOIN o ON o.i = r.i + 1)
SELECT unnest(kept).top AS top FROM (SELECT kept FROM r ORDER BY i DESC LIMIT 1)""")
register("h27_candidates", lambda v: sp.candidates(tops(v), villages(v)).select("top", "persons", "nearest_km", "cost"), f"WITH {TOPS}, {VIL}, n AS (SELECT top, population, sqrt(pow(t.x - v.x, 2) + pow(t.y - v.y, 2)) AS km FROM tops t, vil v) SELECT top, sum(population)::BIGINT AS persons, round(min(km), 3) AS nearest_km, (1800000000 + round_even(120000000 * min(km), 0))::BIGINT AS cost FROM n WHERE km <= 5 GROUP BY top ORDER BY persons DESC, top LIMIT 60")
register("h28_greedy_cover", lambda v: sp.greedy_cover(cover_classes(v)), f"""WITH RECURSIVE {COV}, c AS (SELECT site, list(DISTINCT village) AS vs FROM cov WHERE covered GROUP BY site),
r AS (SELECT 0 AS step, NULL::BIGINT AS site, 0::BIGINT AS newly, []::BIGINT[] AS gone
 UNION ALL SELECT step + 1, site, newly, list_concat(gone, fresh) FROM (
  SELECT r.step, c.site, len(list_filter(vs, lambda x: NOT list_contains(gone, x))) AS newly, gone, list_filter(vs, lambda x: NOT list_contains(gone, x)) AS fresh,
    row_number() OVER (ORDER BY len(list_filter(vs, lambda x: NOT list_contains(gone, x))) DESC, c.site) AS n FROM r, c) WHERE n = 1 AND newly > 0)
SELECT step::INTEGER AS step, site, newly::BIGINT AS newly FROM r WHERE step > 0""")
SERVED = "sv AS (SELECT village, population, coalesce(bool_or(level >= -110) FILTER (WHERE technology = 'LTE'), false) AS outdoor, coalesce(bool_or(covered), false) AS indoor FROM vil LEFT JOIN cov USING (village) GROUP BY 1, 2)"


def planning_counts(v: Views):
    at = villages(v).groupBy("x", "y").agg(F.count("*").alias("n"), F.sum("population").alias("population"))
    served = coverage(v).groupBy("x", "y").agg(F.bool_or((F.col("technology") == "LTE") & (F.col("level") >= -110)).alias("o"), F.bool_or("covered").alias("i"))
    per = at.join(served, ["x", "y"], "left").withColumns({"o": F.coalesce("o", F.lit(False)), "i": F.coalesce("i", F.lit(False))})
    some = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(some("n").alias("villages"), some(F.when(F.col("o"), F.col("n"))).alias("outdoor"), some(F.when(F.col("i"), F.col("n"))).alias("indoor"), F.sum(F.when(F.col("i"), 0).otherwise(F.col("population"))).alias("unserved_persons"))


register("h29_planning_counts", planning_counts, f"WITH {COV}, {SERVED} SELECT count(*) AS villages, count(*) FILTER (WHERE outdoor) AS outdoor, count(*) FILTER (WHERE indoor) AS indoor, sum(CASE WHEN indoor THEN 0 ELSE population END)::BIGINT AS unserved_persons FROM sv")
register("h30_allowed_options", lambda v: sp.allowed_options(option_rows(v), fiber=False, most_capex=500_000_000).select("site", "kind"), f"WITH {OPTIONS} SELECT site, kind FROM opt WHERE available AND kind <> 'fiber' AND capex <= 500000000")
register("h31_uncoverable", lambda v: sp.uncoverable(sp.must_cover(sp.village_attributes(villages(v)), 4000, True), covered_villages(v)), f"WITH {COV} SELECT village FROM vil WHERE (population >= 4000 OR CASE WHEN population > 500 THEN 1 ELSE round_even(population / 1500.0, 0) END > 0) AND village NOT IN (SELECT village FROM cov WHERE covered)")
register("h32_score_plans", lambda v: sp.score_plans(v.spark.range(10).select(F.col("id").alias("plan")).crossJoin(sites(v).select("site", F.col("x").alias("rx"), F.col("y").alias("ry"))).filter("site % 10 = plan"), covered_places(v), villages(v), sites(v).select("site", F.col("site").alias("cost")), 100), f"WITH {COV}, pl AS (SELECT site % 10 AS plan, site FROM sit), c AS (SELECT DISTINCT plan, village FROM pl JOIN cov USING (site) WHERE covered), g AS (SELECT plan, count(*) AS villages, sum(population)::BIGINT AS persons FROM c JOIN vil USING (village) GROUP BY 1), k AS (SELECT plan, count(*) AS sites, sum(site)::BIGINT AS cost FROM pl GROUP BY 1) SELECT plan, sites, cost, coalesce(villages, 0) AS villages, coalesce(persons, 0)::BIGINT AS persons, greatest(cost - 100, 0)::BIGINT AS over_budget FROM k LEFT JOIN g USING (plan)")
register("h33_largest_villages", lambda v: sp.largest_villages(villages(v), covered_villages(v), (10.0, 10.0, 80.0, 80.0), 10).select("village", "population"), f"WITH {COV} SELECT village, population FROM vil WHERE x BETWEEN 10 AND 80 AND y BETWEEN 10 AND 80 AND village IN (SELECT village FROM cov WHERE covered) ORDER BY population DESC, village LIMIT 10")
register("g26_nearest_other", lambda v: rounded(sp.nearest_other(sites(v)), 6), f"WITH {SITES} SELECT a.site, round(min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 6) AS km FROM sit a LEFT JOIN sit b ON a.site <> b.site GROUP BY 1")


def layer_summary(v: Views):
    rows = best(v).join(points(v).select("point", "users"), "point")
    share = rows.agg((F.sum(F.when(F.col("covered"), F.col("users")).otherwise(0.0)) / F.sum("users")).alias("share"))
    return st.beside(share, st.percentile_columns(rows, {"p10": (F.col("level"), 0.1), "p50": (F.col("level"), 0.5), "sinr50": (F.col("sinr_db"), 0.5)}), [])


register("g29_layer_summary", lambda v: rounded(layer_summary(v), 4), f"WITH {LEVELS}, {BEST} SELECT round(sum(CASE WHEN covered THEN users ELSE 0 END) / sum(users), 4) AS share, round(quantile_cont(level, 0.1), 4) AS p10, round(quantile_cont(level, 0.5), 4) AS p50, round(quantile_cont(sinr_db, 0.5), 4) AS sinr50 FROM best JOIN pts USING (point)")
