"""Distances, rasters, terrain paths, coverage and planning as joins and aggregates.

Range joins never build all pairs: both sides are posted in grid squares as wide as the
radius, and one side also in the eight squares around it.  Nearest neighbours have no
radius: squares are widened for what is still open until a wider ring cannot win.
Rows in one place are worked out together, and told apart only in what is returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import inf, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.radio import antenna_gain_db, earth_bulge_m, fresnel_m, knife_edge_db, linear, logistic, path_loss_db
from ..functions.scratch import scratch_path

#: Fixed values of the planning rules.
NEAR_VILLAGE_KM, SPACING_KM, SCORE_KM, CANDIDATES = 3.0, 1.5, 5.0, 60
BUILD_BASE, ROAD_PER_KM = 1_800_000_000, 120_000_000
PERSONS_PER_SCHOOL, SCHOOL_FROM = 1500, 500
MAX_HOP_KM, GRID_POWER_KM = 30.0, 5.0
MAST_M, HUB_M, MICROWAVE_GHZ = 30.0, 40.0, 8.0
#: Fixed values of the options: (Mbit/s, capex (by km if it is laid), monthly cost).
FIBER, MICROWAVE, SATELLITE = (10_000, 150_000_000, 3_000_000), (400, 350_000_000, 2_000_000), (8, 150_000_000, 25_000_000)
GRID_POWER, SOLAR_POWER = (0, 250_000_000, 6_000_000), (0, 650_000_000, 1_500_000)
SERVER_SPREAD_DB, LAYER_MARGIN_DB, LAYER_SPREAD_DB, LAYER_MIN_DBM = 3.0, 8.0, 3.0, -110.0


def hypot(a: Column, b: Column) -> Column:
    return F.sqrt(a * a + b * b)


def within(left: DataFrame, right: DataFrame, radius: float, *, lx: str = "x", ly: str = "y", rx: str = "rx", ry: str = "ry", ids: tuple[str, str] | None = None) -> DataFrame:
    """Pairs of a left and a right row at most `radius` apart, with `km`.  ids: arrays of the
    left and of the right rows whose pairs are to be returned; they are dealt to all tasks."""
    square = lambda c: F.floor(F.col(c) / radius)
    around = F.array(*map(F.lit, (-1, 0, 1)))
    a = left.withColumn("__gx", square(lx)).withColumn("__gy", square(ly))
    b = (
        right.withColumn("__dx", F.explode(around)).withColumn("__dy", F.explode(around))
        .withColumn("__gx", square(rx) + F.col("__dx")).withColumn("__gy", square(ry) + F.col("__dy")).drop("__dx", "__dy")
    )
    km = hypot(F.col(lx) - F.col(rx), F.col(ly) - F.col(ry))
    by = ["__gx", "__gy"]
    if ids:
        a, b = _parted(a, b, by, *ids)
        by = [*by, "__part"]
    return a.join(b, by).withColumn("km", km).filter(F.col("km") <= radius).drop(*by)


GATHERED = 4096  # ids of one array, about
LEAST_WORK, MOST_WORK = 1 << 16, 1 << 26  # pairs of ids in one part of a square
PARTS = 4  # parts for each task, about


def _parted(a: DataFrame, b: DataFrame, by: list[str], ids_a: str, ids_b: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides with a number `__part`, dealt to a fixed number of tasks by it and
    `by`: the left rows of a square are dealt to parts by their ids, and its right rows go to
    each of these, so that the rows are shuffled and not their pairs.  The more pairs a square
    has, the more parts."""
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = lambda rows, ids, name: rows.groupBy(*by).agg(F.sum(F.size(ids)).cast("double").alias(name))
    work = sizes(a, ids_a, "__a").join(sizes(b, ids_b, "__b"), by).select(*by, (F.col("__a") * F.col("__b")).alias("__work"))
    share = F.least(F.lit(float(MOST_WORK)), F.greatest(F.lit(float(LEAST_WORK)), F.col("__all") / (PARTS * tasks)))
    parts = work.crossJoin(F.broadcast(work.agg(F.sum("__work").alias("__all")))).select(*by, F.ceil(F.col("__work") / share).alias("__n"))
    left = a.join(parts, by).withColumn("__part", F.pmod(F.xxhash64(ids_a), F.col("__n"))).drop("__n")
    right = b.join(parts, by).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))).drop("__n")
    return left.repartition(tasks, *by, "__part"), right.repartition(tasks, *by, "__part")


def gathered(rows: DataFrame, by: list[str], id_col: str, into: str) -> DataFrame:
    """A row for each combination of `by`, its ids in an array; many ids are dealt over
    several rows."""
    sizes = rows.groupBy(*by).agg(F.count("*").alias("__n"))
    dealt = rows.join(sizes, by).withColumn("__part", F.pmod(F.xxhash64(id_col), F.ceil(F.col("__n") / GATHERED)))
    return dealt.groupBy(*by, "__part").agg(F.collect_list(id_col).alias(into)).drop("__part")


def dealt(rows: DataFrame) -> DataFrame:
    """Few rows that `spread` makes many, dealt to a fixed number of tasks: by the size of
    the few Spark would put them into one."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread(rows: DataFrame, **ids: str) -> DataFrame:
    """The reverse of `gathered`: a row for each id of the arrays; spread(rows, id="ids")."""
    for name, array in ids.items():
        rows = rows.withColumn(name, F.explode(array)).drop(array)
    return rows


STEP = 4.0  # how much wider the squares of the next round are
FINEST = 12  # levels below the one square that holds everything
CROWDED = 256  # places that a square may hold at the level where a search begins


def _around(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Rows in their own square and in the eight around it."""
    near = lambda c: F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(F.col(c) / size) + d))
    return df.withColumn("__gx", near(x)).withColumn("__gy", near(y))


def _rings(open_: DataFrame, key: str, candidates: Callable[[DataFrame, float], DataFrame], best: Callable[[DataFrame], DataFrame], size: float, whole: float) -> list[DataFrame]:
    """open_: (key, x, y).  Rounds of candidates(open rows, square) -> best(..), rows with
    the key and the distance ``reach`` that a further candidate would have to beat; a key is
    settled when the square is wider than that, and all are when it is as wide as ``whole``."""
    settled = []
    while True:
        found = _written(best(candidates(open_, size)))
        last = size >= whole
        done = found if last else found.filter(F.col("reach") < size - 1e-8)
        settled.append(done)
        if last:
            return settled
        open_ = _written(open_.join(done.select(key).distinct(), key, "left_anti"))
        if not open_.limit(1).count():
            return settled
        size = min(size * STEP, whole)


def _extent(*tables: DataFrame) -> float:
    """A square this wide, with those around it, holds all rows for each of them."""
    rows = tables[0].select("x", "y")
    for t in tables[1:]:
        rows = rows.unionByName(t.select("x", "y"))
    e = rows.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    return max(e[0] or 0.0, e[1] or 0.0, 1e-6) * 1.001


def nearest(queries: DataFrame, points: DataFrame, k: int, *, query: str = "query", point: str = "point", skip_same: bool = False) -> DataFrame:
    """The k points nearest to each query (query, x, y), whatever their distance; ties by
    point id: (query, point, rank, km).  skip_same: a point of the query's own id is none.

    The search begins at squares that hold few places and widens them for the places whose
    k-th neighbour is farther than the next ring.  Queries in one place search together, for
    one point more where their own must be left out.  Of points in one place only the k + 1
    smallest ids count.  Rows without a place take no part."""
    asked = queries.select(F.col(query).alias("__id"), F.col("x").cast("double"), F.col("y").cast("double")).dropna().distinct()
    q = _written(asked.select("x", "y").distinct().withColumn("__q", F.struct("x", "y")))
    wanted = k + 1 if skip_same else k
    same = Window.partitionBy("rx", "ry").orderBy("__p")
    p = points.select(F.col(point).alias("__p"), F.col("x").cast("double").alias("rx"), F.col("y").cast("double").alias("ry")).dropna().distinct()
    p = _written(p.withColumn("__same", F.row_number().over(same)).filter(F.col("__same") <= k + 1).drop("__same"))
    whole = _extent(q, p.withColumnsRenamed({"rx": "x", "ry": "y"}))
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(whole / STEP**i).alias("size")) for i in range(FINEST + 1)]))
    squares = p.select("rx", "ry").distinct().withColumn("l", levels).groupBy("l.level", F.floor(F.col("rx") / F.col("l.size")), F.floor(F.col("ry") / F.col("l.size"))).count()
    full = {r["level"]: r["most"] for r in squares.groupBy("level").agg(F.max("count").alias("most")).collect()}
    start = next((i for i in range(FINEST + 1) if full.get(i, 0) <= CROWDED), FINEST)
    order = Window.partitionBy("__q").orderBy(F.round("km", 9), "__p")

    def candidates(open_: DataFrame, size: float) -> DataFrame:
        posted = p.withColumn("__gx", F.floor(F.col("rx") / size)).withColumn("__gy", F.floor(F.col("ry") / size))
        met = _around(open_, size).join(posted, ["__gx", "__gy"])
        return met.withColumn("km", hypot(F.col("x") - F.col("rx"), F.col("y") - F.col("ry"))).select("__q", "__p", "km")

    def best(met: DataFrame) -> DataFrame:
        first = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
        return first.withColumn("reach", F.when(F.count("*").over(Window.partitionBy("__q")) == wanted, F.max("km").over(Window.partitionBy("__q"))).otherwise(F.lit(inf)))

    rounds = _rings(q, "__q", candidates, best, whole / STEP**start, whole)
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    each = asked.join(out.select("__q.*", "__p", "km", "rank"), ["x", "y"])
    if skip_same:
        own = Window.partitionBy("__id", "x", "y").orderBy("rank")
        each = each.filter("__id <> __p").withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return each.select(F.col("__id").alias(query), F.col("__p").alias(point), "rank", "km")


def nearest_other(sites: DataFrame) -> DataFrame:
    """Distance of each site's nearest other site; null only where there is no other."""
    near = nearest(sites.withColumnRenamed("site", "query"), sites.withColumnRenamed("site", "point"), 1, skip_same=True)
    return sites.select("site").join(near.select(F.col("query").alias("site"), "km"), "site", "left")


def k_nearest(points: DataFrame, seeds: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """The k points nearest to each seed, ties by id."""
    return nearest(seeds, points, k, query="seed", point=id_col).select("seed", id_col, "rank", "km")


POINT, CELL = ["x", "y", "urban", "suburban"], ["rx", "ry", "power_dbm", "mast_m", "azimuth", "tilt"]  # what a level depends on


def in_reach(points: DataFrame, cells: DataFrame, radius: float, f_mhz: float, ids: tuple[str, str] | None = None) -> DataFrame:
    """Level of each cell (CELL) at each point (POINT) within its reach: power, antenna, path
    loss.  Other columns stay, so that a row may stand for all points or cells alike (ids: as
    in `within`)."""
    pairs = within(points, cells, radius, ids=ids)
    azimuth = F.degrees(F.atan2(F.col("x") - F.col("rx"), F.col("y") - F.col("ry")))
    down = F.degrees(F.atan2(F.col("mast_m") - 1.5, F.greatest("km", F.lit(0.02)) * 1000))
    gain = antenna_gain_db(azimuth - F.col("azimuth"), down - F.col("tilt"))
    loss = path_loss_db(f_mhz, F.col("km"), F.col("mast_m"), F.col("urban"), F.col("suburban"))
    return pairs.withColumn("level", F.col("power_dbm") + gain - loss)


def received(points: DataFrame, cells: DataFrame, radius: float, f_mhz: float) -> DataFrame:
    """Levels by points alike and cells alike, ids in arrays: (points, cells, km, level)."""
    return in_reach(gathered(points, POINT, "point", "points"), gathered(cells, CELL, "cell", "cells"), radius, f_mhz, ("points", "cells")).select("points", "cells", "km", "level")


def alike(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells alike in one row: the lowest, the one after it and their number."""
    kind = Window.partitionBy(*by)
    ranked = cells.withColumn("then", F.lead("cell").over(kind.orderBy("cell"))).withColumn("n", F.count("*").over(kind)).withColumn("__i", F.row_number().over(kind.orderBy("cell")))
    return ranked.filter(F.col("__i") == 1).select(*by, "cell", "then", "n")


def best_server(levels: DataFrame, by: list[str], floor_dbm: float, noise_dbm: float = -123.2) -> DataFrame:
    """Best and second cell of each point by level (ties: lower cell), the signal to
    interference and noise ratio, and whether the best is above the floor.

    levels: the columns `by` of a point, level, and cells alike (cell, then, n)."""
    pair = lambda cell: F.struct(F.round("level", 9).alias("key"), (-cell).alias("minus"), F.col("level"), cell.alias("cell"))
    top = levels.groupBy(*by).agg(F.max(pair(F.col("cell"))).alias("a"))
    own = F.col("cell") == F.col("a.cell")
    other = F.when(own, F.col("then")).otherwise(F.col("cell"))
    left = levels.join(top, by)
    rest = left.groupBy(*by).agg(F.first("a").alias("a"), F.max(F.when(other.isNotNull(), pair(other))).alias("b"), F.sum((F.col("n") - own.cast("int")) * linear(F.col("level"))).alias("others"))
    return rest.select(
        *by, F.col("a.cell").alias("best"), F.col("a.level").alias("level"), F.col("b.cell").alias("second"), F.col("b.level").alias("second_level"),
        (10 * F.log10(linear(F.col("a.level")) / (F.col("others") + linear(F.lit(noise_dbm))))).alias("sinr_db"), (F.col("a.level") >= floor_dbm).alias("covered"),
    )


def best_share(level: Column, second: Column, floor_dbm: float) -> Column:
    """Share of users on the best server; all of them if no second one covers the point."""
    return F.when(F.coalesce(second >= floor_dbm, F.lit(False)), logistic((level - second) / SERVER_SPREAD_DB)).otherwise(1.0)


def layer_share(level: Column, strongest: Column, mhz: Column) -> Column:
    """Share of a layer before the shares of a point are brought to a sum of one."""
    return mhz * logistic((level - (strongest - LAYER_MARGIN_DB)) / LAYER_SPREAD_DB) * logistic((level - LAYER_MIN_DBM) / LAYER_SPREAD_DB)


def layer_totals(layers: DataFrame, by: list[str]) -> DataFrame:
    """By point (`by`) the strongest level and the sum of the shares of its layers (level,
    mhz; n layers alike)."""
    top = layers.groupBy(*by).agg(F.max("level").alias("strongest"))
    share = layer_share(F.col("level"), F.col("strongest"), F.col("mhz"))
    return layers.join(top, by).groupBy(*by, "strongest").agg(F.sum(F.col("n") * share).alias("total"))


def footprint(best: DataFrame, points: DataFrame) -> DataFrame:
    """By cell: users, and user-weighted SINR and share of points at the edge."""
    rows = best.filter("covered").join(points.select("point", "users"), "point")
    u = F.nullif(F.sum("users"), F.lit(0.0))
    return rows.groupBy(F.col("best").alias("cell")).agg(
        F.count("*").alias("points"), F.sum("users").alias("users"), (F.sum(F.col("users") * F.col("sinr_db")) / u).alias("sinr_db"),
        (F.sum(F.when(F.col("sinr_db") < 0, F.col("users")).otherwise(0.0)) / u).alias("edge_share"),
    )


def histogram(rows: DataFrame, by: str, bin_: Column, weight: str) -> DataFrame:
    return rows.groupBy(by, bin_.cast("int").alias("bin")).agg(F.sum(weight).alias("weight"))


def relation_mass(best: DataFrame, points: DataFrame, margin_db: float = 6.0) -> DataFrame:
    """Users where two cells are within the margin: the mass of a handover relation."""
    rows = best.filter(F.col("covered") & (F.col("level") - F.col("second_level") <= margin_db)).join(points.select("point", "users"), "point")
    return rows.groupBy(F.col("best").alias("source"), F.col("second").alias("target")).agg(F.sum("users").alias("mass"))


def apportion(shares: DataFrame, source: str, relation: str, total: str, share: str) -> DataFrame:
    """Integer parts of a source's total in proportion to shares: differences of rounded
    running sums, so they add up."""
    order = Window.partitionBy(source).orderBy(relation)
    upto = F.rint(F.col(total) * F.round(F.sum(share).over(order.rowsBetween(Window.unboundedPreceding, 0)), 12))
    return shares.withColumn("__u", upto).withColumn("part", (F.col("__u") - F.coalesce(F.lag("__u").over(order), F.lit(0.0))).cast("long")).drop("__u")


def distance_to_line(points: DataFrame, segments: DataFrame, id_col: str) -> DataFrame:
    """Distance of each point to the nearest segment (x1, y1, x2, y2), however far: null only
    where there is none.

    Segments are cut into pieces no longer than a square and posted where a piece lies.  A
    place asks once for all its points.  The first squares are so wide that a place meets a
    segment, but at least as wide that about one of the places would lie in one: the wider,
    the more a place meets; the narrower, the more pieces there are."""
    s = _written(segments.select(*[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")]).dropna().distinct())
    at = points.select(F.col(id_col), F.col("x").cast("double"), F.col("y").cast("double"))
    q = _written(at.select("x", "y").dropna().distinct().withColumn("__q", F.struct("x", "y")))
    n, mean = s.agg(F.count("*"), F.avg(hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()
    if not n:
        return points.select(id_col).distinct().withColumn("km", F.lit(None).cast("double"))
    whole = _extent(q, s.select(F.col("x1").alias("x"), F.col("y1").alias("y")), s.select(F.col("x2").alias("x"), F.col("y2").alias("y")))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def candidates(open_: DataFrame, size: float) -> DataFrame:
        pieces = F.greatest(F.ceil(hypot(dx, dy) / size), F.lit(1)).cast("int")
        cut = s.withColumn("__m", pieces).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__m") - 1)))
        ends = lambda a, d: (F.floor((a + d * F.col("__i") / F.col("__m")) / size), F.floor((a + d * (F.col("__i") + 1) / F.col("__m")) / size))
        across = lambda a, d: F.explode(F.sequence(F.least(*ends(a, d)), F.greatest(*ends(a, d))))
        posted = cut.withColumn("__gx", across(F.col("x1"), dx)).withColumn("__gy", across(F.col("y1"), dy)).select("x1", "y1", "x2", "y2", "__gx", "__gy").distinct()
        met = _around(open_, size).join(posted, ["__gx", "__gy"])
        t = ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))
        return met.select("__q", hypot(F.col("x") - F.col("x1") - t * dx, F.col("y") - F.col("y1") - t * dy).alias("km"))

    size = max(whole / sqrt(q.count() + 1), whole / sqrt(n + 1) * min(1.0, whole / (9 * sqrt(n) * max(mean, 1e-9))), whole / STEP**FINEST)
    size = min(size, whole)
    rounds = _rings(q, "__q", candidates, lambda met: met.groupBy("__q").agg(F.min("km").alias("km")).withColumn("reach", F.col("km")), size, whole)
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    near = out.select("__q.*", "km").groupBy("x", "y").agg(F.min("km").alias("km"))
    return at.join(near, ["x", "y"], "left").groupBy(id_col).agg(F.min("km").alias("km"))


def stencil(raster: DataFrame) -> DataFrame:
    """Each raster square with the heights of its four corners, edges repeated."""
    keep = raster.select("row", "col", "height")
    last = raster.agg(F.max("row").alias("mr"), F.max("col").alias("mc"))
    rows = keep.crossJoin(F.broadcast(last))
    out = rows.select("row", "col", F.col("height").alias("h00"), F.least(F.col("row") + 1, "mr").alias("r1"), F.least(F.col("col") + 1, "mc").alias("c1"))
    for name, r, c in (("h01", "row", "c1"), ("h10", "r1", "col"), ("h11", "r1", "c1")):
        side = keep.select(F.col("row").alias("__r"), F.col("col").alias("__c"), F.col("height").alias(name))
        out = out.join(side, (F.col(r) == F.col("__r")) & (F.col(c) == F.col("__c"))).drop("__r", "__c")
    return out.drop("r1", "c1")


def height_at(points: DataFrame, raster: DataFrame, step_km: float, rows: int, cols: int) -> DataFrame:
    """Bilinear height of each point, clamped to the raster's edges."""
    gx = F.greatest(F.lit(0.0), F.least(F.col("x") / step_km, F.lit(float(cols - 1))))
    gy = F.greatest(F.lit(0.0), F.least(F.col("y") / step_km, F.lit(float(rows - 1))))
    p = points.withColumn("__gx", gx).withColumn("__gy", gy).withColumn("col", F.floor("__gx").cast("int")).withColumn("row", F.floor("__gy").cast("int"))
    fx, fy = F.col("__gx") - F.col("col"), F.col("__gy") - F.col("row")
    h = (F.col("h00") * (1 - fx) + F.col("h01") * fx) * (1 - fy) + (F.col("h10") * (1 - fx) + F.col("h11") * fx) * fy
    return p.join(stencil(raster), ["row", "col"]).withColumn("ground_m", h).drop("__gx", "__gy", "row", "col", "h00", "h01", "h10", "h11")


def profile(paths: DataFrame, raster: DataFrame, n: int, step_km: float, rows: int, cols: int) -> DataFrame:
    """n evenly spaced ground heights along each path (path, x1, y1, x2, y2)."""
    steps = paths.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("t", F.col("i") / F.lit(n - 1.0))
    at = steps.withColumn("x", F.col("x1") + (F.col("x2") - F.col("x1")) * F.col("t")).withColumn("y", F.col("y1") + (F.col("y2") - F.col("y1")) * F.col("t"))
    total = hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return height_at(at, raster, step_km, rows, cols).withColumn("total_km", total).withColumn("km", total * F.col("t"))


def bullington_db(profiles: DataFrame, f_mhz: float) -> DataFrame:
    """Diffraction loss of each path (path, i, km, total_km, ground_m, tx_m, rx_m: heights
    of the ends above sea level).  One pass of maxima, then expressions."""
    inner = (F.col("km") > 1e-9) & (F.col("km") < F.col("total_km") - 1e-9)
    d, di = F.col("total_km"), F.col("km")
    wave = 299.792458 / f_mhz
    ground = F.col("ground_m") + earth_bulge_m(di, d - di)
    line = (F.col("tx_m") * (d - di) + F.col("rx_m") * di) / d
    v = (ground - line) * F.sqrt(0.002 * d / (wave * di * (d - di)))
    per = profiles.filter(inner).groupBy("path").agg(
        F.max((ground - F.col("tx_m")) / di).alias("s1"), F.max((ground - F.col("rx_m")) / (d - di)).alias("s2"), F.max(v).alias("v"), F.max("total_km").alias("d"), F.max("tx_m").alias("a"), F.max("rx_m").alias("b")
    )
    a, b, s1, s2, dd = (F.col(c) for c in ("a", "b", "s1", "s2", "d"))
    meet = F.greatest(F.lit(1e-6), F.least(dd - 1e-6, (b - a + s2 * dd) / F.greatest(s1 + s2, F.lit(1e-9))))
    peak = (a + s1 * meet - (a * (dd - meet) + b * meet) / dd) * F.sqrt(0.002 * dd / (wave * meet * (dd - meet)))
    edge = knife_edge_db(F.when(s1 < (b - a) / dd, F.col("v")).otherwise(peak))
    return per.select("path", (edge + (1 - F.exp(-edge / 6)) * (10 + 0.02 * dd)).alias("loss_db"))


def line_of_sight(profiles: DataFrame, clearance: float, ghz: float = MICROWAVE_GHZ) -> DataFrame:
    """Whether each path stays above ground and earth by a part of the Fresnel radius."""
    d, di = F.col("total_km"), F.col("km")
    inner = (di > 1e-9) & (di < d - 1e-9)
    path = F.col("tx_m") + (F.col("rx_m") - F.col("tx_m")) * di / d
    ok = path - (F.col("ground_m") + earth_bulge_m(di, d - di)) >= clearance * fresnel_m(di, d - di, ghz)
    return profiles.filter(inner).groupBy("path").agg(F.bool_and(ok).alias("clear"))


def nearest_hub(sites: DataFrame, ways: DataFrame) -> DataFrame:
    """The nearest hub that a site sees, within the longest hop: (site, hub, km).  A hub is a
    site of a higher id; ties go to the lower hub.

    sites: site, x, y; ways: x1, y1, x2, y2, km, the pairs of places that see each other.
    The nearest places with a higher site are found first, then the next id in them."""
    here = sites.select("site", F.col("x").alias("x1"), F.col("y").alias("y1"))
    last = sites.groupBy(F.col("x").alias("x2"), F.col("y").alias("y2")).agg(F.max("site").alias("last"))
    ways = ways.filter(F.col("km") <= MAX_HOP_KM).withColumn("km", F.round("km", 9)).join(last, ["x2", "y2"])
    seen = here.join(ways, ["x1", "y1"]).filter(F.col("last") > F.col("site"))
    near = seen.groupBy("site").agg(F.min("km").alias("near"))
    asked = seen.join(near, "site").filter("km = near").select("x2", "y2", F.col("site").alias("id"), F.lit(None).cast(dict(sites.dtypes)["site"]).alias("hub"), "km")
    hubs = sites.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("site").alias("id"), F.col("site").alias("hub"), F.lit(None).cast("double").alias("km"))
    above = Window.partitionBy("x2", "y2").orderBy(F.desc("id"), F.col("hub").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    found = asked.unionByName(hubs).withColumn("next", F.min("hub").over(above)).filter("hub is null")
    return found.groupBy(F.col("id").alias("site")).agg(F.min("next").alias("hub"), F.min("km").alias("km"))


def served_levels(levels: DataFrame, villages: DataFrame) -> DataFrame:
    """Best level of each technology at each village, by levels at its place (x, y); null
    where nothing reaches it."""
    per = levels.groupBy("x", "y").pivot("technology", ["LTE", "GSM"]).agg(F.max("level"))
    return villages.select("village", "x", "y").join(per, ["x", "y"], "left").drop("x", "y")


def options(sites: DataFrame) -> DataFrame:
    """Five backhaul and power options of each site (fiber_km, grid_km, hub, hop_km)."""
    hop = F.col("hub").isNotNull()
    on_grid = F.col("grid_km") <= GRID_POWER_KM
    cost = lambda per_km, km: F.rint(F.lit(float(per_km)) * F.col(km)).cast("long")

    def option(kind, available, km, mbps, capex, monthly):
        return F.struct(F.lit(kind).alias("kind"), available.alias("available"), km.cast("double").alias("distance_km"), mbps.cast("double").alias("mbps"), capex.cast("long").alias("capex"), monthly.cast("long").alias("monthly"))

    none, yes = F.lit(0), F.lit(True)
    rows = F.array(
        option("fiber", yes, F.round("fiber_km", 3), F.lit(FIBER[0]), cost(FIBER[1], "fiber_km"), F.lit(FIBER[2])),
        option("microwave", hop, F.when(hop, F.round("hop_km", 3)).otherwise(0.0), *[F.when(hop, x).otherwise(0) for x in MICROWAVE]),
        option("satellite", yes, none, *map(F.lit, SATELLITE)),
        option("grid_power", on_grid, F.round("grid_km", 3), none, cost(GRID_POWER[1], "grid_km"), F.lit(GRID_POWER[2])),
        option("solar_power", ~on_grid, none, *map(F.lit, SOLAR_POWER)),
    )
    return sites.select("site", F.explode(rows).alias("x")).select("site", "x.*")


def village_attributes(villages: DataFrame) -> DataFrame:
    """Schools: one for so many persons (half-even), at least one above a size."""
    n = F.rint(F.col("population") / PERSONS_PER_SCHOOL).cast("int")
    return villages.withColumn("schools", F.when(F.col("population") > SCHOOL_FROM, F.greatest(n, F.lit(1))).otherwise(n))


def build_cost(nearest_km: Column) -> Column:
    return F.lit(BUILD_BASE) + F.rint(F.lit(float(ROAD_PER_KM)) * nearest_km).cast("long")


def high_points(raster: DataFrame, r: int) -> DataFrame:
    """Squares that no square within r (in rows and columns) exceeds, edges left out: the
    maximum by row, then of those by column."""
    w = lambda part, order: Window.partitionBy(part).orderBy(order).rowsBetween(-r, r)
    top = raster.withColumn("__m", F.max("height").over(w("row", "col"))).withColumn("__m", F.max("__m").over(w("col", "row")))
    size = raster.agg(F.max("row").alias("mr"), F.max("col").alias("mc"))
    return top.crossJoin(F.broadcast(size)).filter((F.col("height") == F.col("__m")) & F.col("row").between(r, F.col("mr") - r) & F.col("col").between(r, F.col("mc") - r)).select("row", "col", "height")


def proposals(tops: DataFrame, villages: DataFrame) -> DataFrame:
    """The highest top near each village (ties: lower id), each top once.  Of the tops in one
    place only the highest can be it, and villages in one place have the same."""
    first = lambda: F.max(F.struct("height", (-F.col("top")).alias("m"), "top"))
    highest = tops.groupBy("x", "y").agg(first().alias("t")).select("x", "y", "t.height", "t.top")
    near = within(highest, villages.select(F.col("x").alias("rx"), F.col("y").alias("ry")).distinct(), NEAR_VILLAGE_KM)
    best = near.groupBy("rx", "ry").agg(first()["top"].alias("top"))
    return tops.join(best.select("top").distinct(), "top", "left_semi")


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that plans do not grow by the round."""
    path = scratch_path(df.sparkSession, "space")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


REGION = 20_000  # points of a region, about


class _Region:
    """Points of a region in order: which of them the region can decide alone."""

    def __init__(self, km: float):
        self.km = km
        self.kept: dict[tuple[int, int], list[tuple[float, float]]] = {}
        self.boxes: dict[tuple[int, int], list[list[float]]] = {}  # undecided points, joined into boxes where there are many

    def _squares(self, x: float, y: float) -> Iterator[tuple[int, int]]:
        gx, gy = int(x // self.km), int(y // self.km)
        return ((gx + i, gy + j) for i in (-1, 0, 1) for j in (-1, 0, 1))

    def beaten(self, x: float, y: float) -> bool:
        return any(sqrt((x - a) * (x - a) + (y - b) * (y - b)) < self.km for s in self._squares(x, y) for a, b in self.kept.get(s, ()))

    def unsure(self, x: float, y: float) -> bool:
        for s in self._squares(x, y):
            for x0, y0, x1, y1 in self.boxes.get(s, ()):
                dx, dy = max(x0 - x, 0.0, x - x1), max(y0 - y, 0.0, y - y1)
                if sqrt(dx * dx + dy * dy) < self.km:
                    return True
        return False

    def keep(self, x: float, y: float) -> None:
        self.kept.setdefault((int(x // self.km), int(y // self.km)), []).append((x, y))

    def leave(self, x: float, y: float) -> None:
        boxes = self.boxes.setdefault((int(x // self.km), int(y // self.km)), [])
        if len(boxes) < 16:
            boxes.append([x, y, x, y])
        else:  # a wider box only leaves more for the next round
            b = boxes[-1]
            b[:] = [min(b[0], x), min(b[1], y), max(b[2], x), max(b[3], y)]


def _decide(km: float):
    """Rows come sorted by region and then in the order of the rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, region = None, _Region(km)
        for b in batches:
            tops, kept, states = b.column("top"), [], []
            for i, (r, own, x, y) in enumerate(zip(*(b.column(c).to_pylist() for c in ("r", "own", "x", "y")), strict=True)):
                if r != key:
                    key, region = r, _Region(km)
                if own and region.beaten(x, y):
                    kept.append(i)
                    states.append(2)
                elif not own or region.unsure(x, y):
                    region.leave(x, y)
                else:
                    region.keep(x, y)
                    kept.append(i)
                    states.append(1)
            yield pa.RecordBatch.from_arrays([tops.take(pa.array(kept, pa.int64())), pa.array(states, pa.int32())], names=["top", "s"])

    return run


def space_out(points: DataFrame, km: float, region: int = REGION) -> DataFrame:
    """Points kept at least `km` apart, higher first (ties: lower id; no height: last).  The
    result is that of taking them one by one in order.

    The plane is cut into regions of about `region` points.  A task takes the points of its
    region in order, and decides those that no undecided point near them comes before:
    points beyond its border count as undecided.  What is left goes into the next round,
    less what lies near kept points, with regions shifted by half.  A chain of decisions
    costs a round only where it leaves a region, and each round decides the first of the open
    points at least.  A task remembers kept points, which lie `km` apart, and boxes around
    undecided ones, a bounded number for each square.  Rows without a place are left out."""
    p = points.select("top", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.coalesce(F.col("height").cast("double"), F.lit(-inf)).alias("height")).dropna(subset=["top", "x", "y"])
    open_, kept, turn = _written(p), [], 0
    n, wide = open_.count(), _extent(open_)
    side = max(8 * km, wide / sqrt(max(n / region, 1.0)) * 1.001)
    kind = dict(open_.dtypes)["top"]
    while n:
        alone = n <= region
        shift = side / 2 * (turn % 2)
        cell = (lambda x, y: F.lit("all")) if alone else lambda x, y: F.concat_ws(",", F.floor((x + shift) / side).cast("string"), F.floor((y + shift) / side).cast("string"))  # noqa: E731, B023
        spots = [cell(F.col("x") + i * km, F.col("y") + j * km) for i in (0, -1, 1) for j in (0, -1, 1)]
        dealt = open_.withColumn("__own", spots[0]).withColumn("r", F.explode(F.array_distinct(F.array(*spots)))).select("r", (F.col("r") == F.col("__own")).alias("own"), "top", "x", "y", "height")
        ordered = dealt.repartition("r").sortWithinPartitions("r", F.desc("height"), "top")
        got = _written(ordered.select("r", "own", "top", "x", "y").mapInArrow(_decide(km), f"top {kind}, s int"))
        new = _written(open_.join(got.filter("s = 1").select("top"), "top", "left_semi").select("top", F.col("x").alias("rx"), F.col("y").alias("ry")))
        kept.append(new.select("top"))
        rest = open_.join(got.select("top"), "top", "left_anti")
        near = within(rest, new.withColumnRenamed("top", "__k"), km).filter(F.col("km") < km).select("top").distinct()
        open_ = _written(rest.join(near, "top", "left_anti"))
        n, turn = open_.count(), turn + 1
    if not kept:
        return points.limit(0)
    chosen = kept[0]
    for k in kept[1:]:
        chosen = chosen.unionByName(k)
    return points.join(chosen, "top", "left_semi")


def candidates(tops: DataFrame, villages: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """Persons near each top, its nearest village and cost; the k best."""
    v = villages.groupBy(F.col("x").alias("rx"), F.col("y").alias("ry")).agg(F.sum("population").alias("population"))
    near = within(tops.select("x", "y").distinct(), v, SCORE_KM).groupBy("x", "y").agg(F.sum("population").alias("persons"), F.min("km").alias("nearest_km"))
    rows = tops.join(near, ["x", "y"]).withColumn("cost", build_cost(F.col("nearest_km")))
    return rows.orderBy(F.desc("persons"), "top").limit(k).select("top", "persons", F.round("nearest_km", 3).alias("nearest_km"), "cost")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their number in an order, from 1.  Ranges of the order are numbered apart,
    and the sizes of the ranges before are added: one row for each range is put in one task."""
    ranges = _written(df.repartitionByRange(*order).withColumn("__r", F.spark_partition_id()))
    sizes = ranges.groupBy("__r").agg(F.count("*").alias("__n"))
    before = sizes.select("__r", F.coalesce(F.sum("__n").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy("__r").orderBy(*order))
    return ranges.withColumn("__i", number).join(before, "__r").withColumn(name, (F.col("__before") + F.col("__i")).cast("int")).drop("__r", "__i", "__before")


def greedy_cover(coverage: DataFrame) -> DataFrame:
    """Sites chosen one by one, each covering most villages that are still open (ties:
    lower site), until none is left: (step, site, newly).  A row may stand for `n` villages
    that the same sites cover, and a site for all with its villages if it is the lowest.

    A site that comes before every site with which it shares an open village loses none of
    its villages before its turn, so a round chooses all such sites at once.  In order of
    newly and site they are the steps, since what a choice covers never grows."""
    weight = F.col("n") if "n" in coverage.columns else F.lit(1)
    rest = _written(coverage.select("site", "village", weight.cast("long").alias("n")).dropna().dropDuplicates(["site", "village"]))
    chosen = rest.select("site", F.lit(0).cast("long").alias("newly")).limit(0)
    while rest.limit(1).count():
        ranked = rest.join(rest.groupBy("site").agg(F.sum("n").alias("all")), "site")
        first = ranked.groupBy("village").agg(F.min(F.struct((-F.col("all")).alias("m"), "site"))["site"].alias("first"))
        won = rest.join(first, "village").groupBy("site").agg(F.sum("n").alias("newly"), F.min(F.col("site") == F.col("first")).alias("all"))
        picked = _written(won.filter("all").select("site", "newly"))
        gone = rest.join(picked.select("site"), "site").select("village").distinct()
        rest, chosen = _written(rest.join(gone, "village", "left_anti").select("site", "village", "n")), chosen.unionByName(picked)
    return numbered(chosen, [F.desc("newly"), F.col("site")], "step").select("step", "site", "newly")


def allowed_options(opts: DataFrame, *, fiber: bool = True, grid_only: bool = False, most_capex: int | None = None) -> DataFrame:
    rows = opts.filter("available")
    if not fiber:
        rows = rows.filter("kind <> 'fiber'")
    if grid_only:
        rows = rows.filter("kind <> 'solar_power'")
    return rows if most_capex is None else rows.filter(F.col("capex") <= most_capex)


def must_cover(villages: DataFrame, least_population: int, schools: bool) -> DataFrame:
    rule = F.col("population") >= least_population
    return villages.filter(rule | (F.col("schools") > 0) if schools else rule).select("village")


def uncoverable(must: DataFrame, coverage: DataFrame) -> DataFrame:
    return must.join(coverage.select("village").distinct(), "village", "left_anti")


def score_plans(plan_sites: DataFrame, coverage: DataFrame, villages: DataFrame, site_costs: DataFrame, budget: int) -> DataFrame:
    """By plan: villages and persons covered, sites, cost, and by how much it exceeds the
    budget.

    plan_sites: plan, site, its place (rx, ry); coverage: pairs of a site's and a village's
    place (rx, ry, x, y)."""
    at = villages.groupBy("x", "y").agg(F.count("*").alias("n"), F.sum("population").alias("population"))
    met = plan_sites.select("plan", "rx", "ry").distinct().join(coverage.select("rx", "ry", "x", "y").distinct(), ["rx", "ry"]).select("plan", "x", "y").distinct()
    got = met.join(at, ["x", "y"]).groupBy("plan").agg(F.sum("n").alias("villages"), F.sum("population").alias("persons"))
    cost = plan_sites.join(site_costs, "site").groupBy("plan").agg(F.count("*").alias("sites"), F.sum("cost").alias("cost"))
    return cost.join(got, "plan", "left").select("plan", "sites", "cost", F.coalesce("villages", F.lit(0)).alias("villages"), F.coalesce("persons", F.lit(0)).alias("persons"), F.greatest(F.col("cost") - budget, F.lit(0)).alias("over_budget"))


def largest_villages(villages: DataFrame, coverage: DataFrame, box: tuple[float, float, float, float], k: int) -> DataFrame:
    x0, y0, x1, y1 = box
    inside = villages.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))
    return inside.join(coverage.select("village").distinct(), "village", "left_semi").orderBy(F.desc("population"), "village").limit(k)
