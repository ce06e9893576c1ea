"""Statistics over tables: shapes, ranks, percentiles, spreads and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hourly_shape(df: DataFrame, time: str, value: str, by: str) -> DataFrame:
    """Mean by hour of day over the mean of the hourly means, for each group."""
    hour = df.groupBy(by, F.hour(time).alias("hour")).agg(F.avg(value).alias("mean"))
    return hour.withColumn("shape", F.col("mean") / F.avg("mean").over(Window.partitionBy(by)))


def best_shift(a: DataFrame, b: DataFrame, value: str = "shape") -> DataFrame:
    """Circular shift of b (hours) with the highest Pearson correlation, first on ties."""
    shifted = b.select(F.col("hour").alias("h"), F.col(value).alias("y"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("shift")).withColumn("hour", F.pmod(F.col("h") + F.col("shift"), F.lit(24)))
    per = a.select("hour", F.col(value).alias("x")).join(F.broadcast(shifted), "hour").groupBy("shift").agg(F.corr("x", "y").alias("r"))
    return per.orderBy(F.round("r", 9).desc(), "shift").limit(1)


GRID = 256  # cuts of a range in one pass
FEW_GROUPS = 10_000  # groups whose brackets go to every task, so that rows are not dealt by group


def percentile_columns(df: DataFrame, wanted: dict[str, tuple[Column, float]], by: list[str] = (), passes: int = 3) -> DataFrame:
    """Exact percentiles (nulls left out; linear interpolation): one row for each group, a
    column for each (value, q) of `wanted`.

    Distributed selection: each pass brackets every wanted rank between two cuts of its
    range, by an approximate summary of bounded size, and counts what lies below and inside,
    so a bracket that should not hold its rank is not used.  A bracket keeps about a
    hundredth of its range; after the passes only the distinct values inside the brackets,
    with their counts, are put in order.  No task holds the values of a group: brackets of few
    groups go to the rows, and of many groups Spark chooses the join."""
    values = {n: v.cast("double") for n, (v, _) in wanted.items()}
    q = {n: x for n, (_, x) in wanted.items()}
    rows = df.select(*by, *[v.alias(f"__v_{n}") for n, v in values.items()])
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    v, at = (lambda n: F.col(f"__v_{n}")), (lambda n, what: F.col(f"__{what}_{n}"))

    few = not by or rows.select(*by).distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS

    def joined(state: DataFrame) -> DataFrame:
        if not by:
            return rows.crossJoin(F.broadcast(state))  # one row
        if few:
            state = F.broadcast(state)
        same = F.lit(True)
        for c in by:
            same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
        return rows.alias("r").join(state.alias("s"), same).select("r.*", *[f"s.{c}" for c in state.columns if c not in by])

    def bracket(n: str, cuts: Column, low: Column, below: Column, inside: Column) -> tuple[Column, Column]:
        """Cuts around the wanted ranks, from their place in the range."""
        place = lambda k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (k - below) / F.greatest(inside - 1, F.lit(1)))) * GRID
        a = F.greatest(F.floor(place(low)).cast("int") - 1, F.lit(0)) + 1
        b = F.least(F.ceil(place(low + 1)).cast("int") + 1, F.lit(GRID)) + 1
        return F.get(cuts, a - 1), F.get(cuts, b - 1)

    # first pass: the whole range
    first = rows.groupBy(*by).agg(*[F.count(v(n)).alias(f"__n_{n}") for n in q], *[F.percentile_approx(v(n), grid, F.lit(10_000)).alias(f"__cuts_{n}") for n in q])
    state = first.select(*by, *[x.alias(name) for n in q for name, x in (
        (f"__n_{n}", F.col(f"__n_{n}")), (f"__low_{n}", F.floor((F.col(f"__n_{n}") - 1) * q[n])), (f"__below_{n}", F.lit(0).cast("long")), (f"__lo_{n}", F.lit(None).cast("double")), (f"__hi_{n}", F.lit(None).cast("double")),
        (f"__a_{n}", bracket(n, F.col(f"__cuts_{n}"), F.floor((F.col(f"__n_{n}") - 1) * q[n]), F.lit(0), F.col(f"__n_{n}"))[0]), (f"__b_{n}", bracket(n, F.col(f"__cuts_{n}"), F.floor((F.col(f"__n_{n}") - 1) * q[n]), F.lit(0), F.col(f"__n_{n}"))[1]),
    )])
    kept = [f"__{w}_{n}" for n in q for w in ("n", "low", "below", "lo", "hi", "a", "b")]
    for _ in range(passes - 1):
        seen = joined(state).groupBy(*by).agg(
            *[F.first(c).alias(c) for c in kept], *[F.count_if(v(n) < at(n, "a")).alias(f"__under_{n}") for n in q], *[F.count_if(v(n).between(at(n, "a"), at(n, "b"))).alias(f"__in_{n}") for n in q],
            *[F.percentile_approx(F.when(v(n).between(at(n, "a"), at(n, "b")), v(n)), grid, F.lit(10_000)).alias(f"__cuts_{n}") for n in q],
        )
        out = []
        for n in q:
            holds = (at(n, "under") <= at(n, "low")) & (F.least(at(n, "low") + 1, at(n, "n") - 1) < at(n, "under") + at(n, "in"))
            a, b = bracket(n, at(n, "cuts"), at(n, "low"), at(n, "under"), at(n, "in"))
            for name, x in (("n", at(n, "n")), ("low", at(n, "low")), ("below", F.when(holds, at(n, "under")).otherwise(at(n, "below"))), ("lo", F.when(holds, at(n, "a")).otherwise(at(n, "lo"))), ("hi", F.when(holds, at(n, "b")).otherwise(at(n, "hi"))), ("a", F.when(holds, a).otherwise(at(n, "a"))), ("b", F.when(holds, b).otherwise(at(n, "b")))):
                out.append(x.alias(f"__{name}_{n}"))
        state = seen.select(*by, *out)
    # the distinct values inside the brackets, with their counts
    inside = lambda n: v(n).isNotNull() & F.coalesce(v(n).between(at(n, "lo"), at(n, "hi")), at(n, "lo").isNull())
    picks = F.array_compact(F.array(*[F.when(inside(n), F.struct(F.lit(n).alias("name"), v(n).alias("v"), at(n, "below").alias("below"), at(n, "low").alias("low"), at(n, "n").alias("n"))) for n in q]))
    left = joined(state).select(*by, F.explode(picks).alias("x")).groupBy(*by, "x.name", "x.v").agg(F.count("*").alias("m"), F.first("x.below").alias("below"), F.first("x.low").alias("low"), F.first("x.n").alias("n"))
    upto = F.col("below") + F.sum("m").over(Window.partitionBy(*by, "name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    has = lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("m"))
    ranked = left.withColumn("upto", upto)
    high = F.least(F.col("low") + 1, F.col("n") - 1)
    found = ranked.groupBy(*by, "name").agg(F.max(F.when(has(F.col("low")), F.col("v"))).alias("x"), F.max(F.when(has(high), F.col("v"))).alias("y"), F.first("low").alias("low"), F.first("n").alias("n"))
    share = lambda x: (F.col("n") - 1) * x - F.col("low")
    value = lambda n: F.max(F.when(F.col("name") == n, F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(F.col("x") + (F.col("y") - F.col("x")) * share(F.lit(q[n])))))
    # groups without a value keep a row
    per = found.groupBy(*by).agg(*[value(n).alias(n) for n in q])
    if not by:
        return per
    groups = df.select(*by).distinct()
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"g.{c}").eqNullSafe(F.col(f"p.{c}"))
    return groups.alias("g").join(per.alias("p"), same, "left").select(*[f"g.{c}" for c in by], *[f"p.{n}" for n in q])


def beside(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Two tables with one row for each group, side by side."""
    if not by:
        return a.crossJoin(F.broadcast(b))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.alias("a").join(b.alias("b"), same).select("a.*", *[f"b.{c}" for c in b.columns if c not in by])


def binned_medians(df: DataFrame, by: str, value: str, bins: int = 10, top: float = 100.0) -> DataFrame:
    """Median of a value in equal bins of another, over its overall median; the last bin
    is closed."""
    bin_ = F.least(F.floor(F.col(by) / (top / bins)), F.lit(bins - 1)).cast("int")
    rows = df.filter(F.col(by).between(0, top) & F.col(value).isNotNull()).select(bin_.alias("bin"), F.col(value).cast("double").alias("v"))
    counts = rows.groupBy("bin").agg(F.count("*").alias("n"))
    per = beside(counts, percentile_columns(rows, {"median": (F.col("v"), 0.5)}, ["bin"]), ["bin"])
    return per.crossJoin(F.broadcast(percentile_columns(rows, {"overall": (F.col("v"), 0.5)}))).select("bin", "n", (F.col("median") / F.nullif(F.col("overall"), F.lit(0.0))).alias("relative"))


def percentiles(df: DataFrame, value: str, at: list[float], by: list[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation, one row for each."""
    p = percentile_columns(df, {f"p{i}": (F.col(value), q) for i, q in enumerate(at)}, list(by))
    pairs = F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"p{i}").alias("value")) for i, q in enumerate(at)])
    return p.select(*by, F.explode(pairs).alias("x")).select(*by, "x.q", "x.value")


def mean_rank(value: str, by: list[str] = ()) -> Column:
    """Rank with ties at their mean."""
    tied = Window.partitionBy(*by, value)
    return F.rank().over(Window.partitionBy(*by).orderBy(value)) + (F.count("*").over(tied) - 1) / 2


def spearman(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Rank correlation with mean ranks for ties.

    Ranks come from counts of distinct values, so that no task orders all rows."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    for c in (x, y):
        n = rows.groupBy(*by, c).agg(F.count("*").alias("n"))
        before = Window.partitionBy(*by).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
        ranks = n.select(*by, c, (F.coalesce(F.sum("n").over(before), F.lit(0)) + (F.col("n") + 1) / 2).alias(f"rank_{c}"))
        rows = rows.join(ranks, [*by, c])
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.corr(f"rank_{x}", f"rank_{y}").alias("rho"))


def spearman_ordinal(df: DataFrame, x: str, y: str, by: list[str], tie: str) -> DataFrame:
    """Rank correlation with ordinal ranks within groups; ties by `tie`."""
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, x, y, tie)
    for c in (x, y):
        rows = _ordinal(rows, c, by, tie, f"rank_{c}")
    return rows.groupBy(*by).agg(F.corr(f"rank_{x}", f"rank_{y}").alias("rho"))


def _ordinal(rows: DataFrame, c: str, by: list[str], tie: str, name: str, pieces: int = 256) -> DataFrame:
    """rows with their place in order of (c, tie) within a group.  Values are cut at
    quantiles, and the ties of one value at the quantiles of the tie; places are counted
    inside these pieces, and what lies before a piece is added."""
    at = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    cuts = rows.groupBy(*by).agg(F.percentile_approx(c, at, F.lit(10_000)).alias("__c"), F.percentile_approx(tie, at, F.lit(10_000)).alias("__t"))
    below = lambda edges, v: F.size(F.filter(edges, lambda e: e < v))
    # 2k: values between two cuts; 2k + 1: those equal to a cut, dealt further by the tie
    is_cut = F.array_contains("__c", F.col(c))
    piece = (2 * below(F.col("__c"), F.col(c)) + is_cut.cast("int")).alias("__p")
    placed = rows.join(cuts, by).select(*rows.columns, piece, F.when(is_cut, below(F.col("__t"), F.col(tie))).otherwise(0).alias("__q"))
    sizes = placed.groupBy(*by, "__p", "__q").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__p", "__q").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.row_number().over(Window.partitionBy(*by, "__p", "__q").orderBy(c, tie))
    return placed.withColumn("__i", number).join(sizes, [*by, "__p", "__q"]).select(*rows.columns, (F.col("__before") + F.col("__i")).alias(name))


def rate_proxy(df: DataFrame, volume: str, users: str, least: float) -> DataFrame:
    """Volume for each user where there are enough users."""
    return df.filter(F.col(users) >= least).withColumn("rate", F.col(volume) / F.col(users))


def hashed_sample(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows, the same ones each time."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def sizes(df: DataFrame, ids: list[str], time: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*ids)).alias("objects"), F.min(time).alias("first"), F.max(time).alias("last"))


def first_last(df: DataFrame, bin_: str, n: str) -> DataFrame:
    there = df.filter(F.col(n) > 0)
    return there.agg(F.min(bin_).alias("first"), F.max(bin_).alias("last"), F.min_by(n, bin_).alias("first_n"), F.max_by(n, bin_).alias("last_n"))


def peak_slot(df: DataFrame, group: str, time: str, load: str, high: float = 80.0) -> DataFrame:
    """Busiest slot of the week by mean load for each group, share of values above `high`
    in it, and the largest value anywhere."""
    slot = (F.pmod(F.dayofweek(time) + 5, F.lit(7)) * 24 + F.hour(time)).alias("slot")
    per = df.groupBy(group, slot).agg(F.avg(load).alias("mean"), F.avg((F.col(load) > high).cast("double")).alias("share_high"), F.max(load).alias("top"))
    best = F.max_by(F.struct("slot", "mean", "share_high"), F.struct(F.round("mean", 9), -F.col("slot"))).alias("x")
    return per.groupBy(group).agg(best, F.max("top").alias("top")).select(group, "x.slot", "x.mean", "x.share_high", "top")


def run_totals(wide: DataFrame, ratios: dict[str, tuple[str, str]], sums: list[str]) -> DataFrame:
    out = [(F.sum(a) / F.nullif(F.sum(b), F.lit(0.0))).alias(k) for k, (a, b) in ratios.items()] + [F.sum(c).alias(f"total_{c}") for c in sums]
    return wide.agg(F.count("*").alias("rows"), F.count_distinct("cell_name").alias("cells"), F.min("period_start").alias("first"), F.max("period_start").alias("last"), *out)


def relationship_checks(df: DataFrame, load: str, bad: str, tries: str, group: str, order: list[str], value: str) -> DataFrame:
    """(check, figure, passed): failures rise with load, medians rise along the groups."""
    half = df.filter(F.col(load).isNotNull()).crossJoin(F.broadcast(percentile_columns(df, {"__m": (F.col(load), 0.5)})))
    rate = lambda c: F.sum(F.when(c, F.col(bad))) / F.nullif(F.sum(F.when(c, F.col(tries))), F.lit(0.0))
    high = F.col(load) > F.col("__m")
    one = half.agg((rate(high) - rate(~high)).alias("figure")).select(F.lit("failures rise with load").alias("check"), "figure", (F.col("figure") > 0).alias("passed"))
    med = percentile_columns(df, {"m": (F.col(value), 0.5)}, [group])
    place = F.array_position(F.array(*map(F.lit, order)), F.col(group))
    step = med.withColumn("i", place).withColumn("d", F.col("m") - F.lag("m").over(Window.orderBy("i")))
    two = step.agg(F.min("d").alias("figure")).select(F.lit("medians rise along the groups").alias("check"), "figure", F.coalesce(F.col("figure") >= 0, F.lit(True)).alias("passed"))
    return one.unionByName(two)


def spread(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    v, by = F.col(value).cast("double"), list(by)
    rows = df.filter(v.isNotNull())
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.max(F.abs(v)).alias("abs_most"))
    exact = percentile_columns(rows, {"median": (v, 0.5), "abs_p90": (F.abs(v), 0.9), "abs_p99": (F.abs(v), 0.99)}, by)
    return beside(sums, exact, by).select(*by, "n", "least", "median", "most", "abs_p90", "abs_p99", "abs_most")


def change_rows(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Absolute and relative change (per cent; null if there was nothing before)."""
    rows = before.select(*keys, F.col(value).alias("before")).join(after.select(*keys, F.col(value).alias("after")), keys, "full")
    return rows.withColumn("change", F.col("after") - F.col("before")).withColumn("relative", 100 * F.col("change") / F.nullif(F.col("before"), F.lit(0.0)))


def change_summary(changes: DataFrame, by: list[str], moved: float = 10.0) -> DataFrame:
    counts = changes.groupBy(*by).agg(F.count("relative").alias("n"), F.avg((F.abs("relative") > moved).cast("double")).alias("share_moved"))
    exact = percentile_columns(changes, {"median": (F.col("relative"), 0.5), "abs_p90": (F.abs("relative"), 0.9)}, list(by))
    return beside(counts, exact, list(by)).select(*by, "n", "median", "abs_p90", "share_moved")


def touched(before: DataFrame, after: DataFrame, key: str, shares: dict[str, float], changed: DataFrame) -> DataFrame:
    """Keys whose figures moved by more than their limits, and those changed themselves."""
    both = before.join(after, key)
    far = F.lit(False)
    for c, limit in shares.items():
        far = far | (F.abs(after[c] - before[c]) > limit)
    return both.filter(far).select(key).union(changed.select(key)).distinct()


def set_kpis(counters: DataFrame, sets: DataFrame, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """KPIs of any sets of cells in one pass; a cell may be in several sets; 'total' is all."""
    joined = counters.join(sets, "cell_name", "left").withColumn("set_name", F.coalesce("set_name", F.lit("-")))
    agg = [(F.sum(a) / F.nullif(F.sum(b), F.lit(0.0))).alias(k) for k, (a, b) in ratios.items()]
    per = joined.filter("set_name <> '-'").groupBy("set_name").agg(*agg)
    return per.unionByName(counters.agg(*agg).select(F.lit("total").alias("set_name"), *ratios))


def reach(clean: DataFrame, faulty: DataFrame, key: str, value: str, weight: str, limit: float = 1.0) -> DataFrame:
    """Keys whose value moved by more than the limit (or appeared or vanished), and the
    share of the weight that they carry."""
    both = clean.select(key, F.col(value).alias("a"), F.col(weight).alias("w")).join(faulty.select(key, F.col(value).alias("b")), key)
    moved = F.coalesce(F.abs(F.col("b") - F.col("a")) > limit, ~F.col("a").eqNullSafe(F.col("b")))
    return both.agg(F.count("*").alias("cells"), F.count_if(moved).alias("moved"), (F.sum(F.when(moved, F.col("w")).otherwise(0.0)) / F.nullif(F.sum("w"), F.lit(0.0))).alias("share"))


def recovery(clean: DataFrame, faulty: DataFrame, fixed: DataFrame, keys: list[str], least: float = 1e-9) -> DataFrame:
    """(fixed - faulty) / (clean - faulty); null where nothing was damaged."""
    side = lambda d, n: d.select(*keys, F.col("value").alias(n))
    rows = side(clean, "c").join(side(faulty, "f"), keys).join(side(fixed, "x"), keys)
    damage = F.col("c") - F.col("f")
    return rows.select(*keys, F.when(F.abs(damage) >= least, (F.col("x") - F.col("f")) / damage).alias("recovery"))


LEVELS = 31


def dyadic_nodes(lo: Column, hi: Column) -> Column:
    """Array of (level, node): the fewest aligned stretches of 2**level ticks that make up
    the ticks lo to hi, at most two for each level."""
    end = hi + 1

    def at(k: Column) -> Column:
        a, b = F.call_function("shiftright", lo + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k), F.call_function("shiftright", end, k)
        open_ = a < b
        last = k == LEVELS  # the highest level takes all that is left
        odd = lambda x: x % 2 != 0
        left = F.when(open_ & ~last & odd(a), F.array(a)).otherwise(F.array().cast("array<bigint>"))
        right = F.when(open_ & ~last & odd(b) & ((b - 1 != a) | ~odd(a)), F.array(b - 1)).otherwise(F.array().cast("array<bigint>"))
        rest = F.when(last & open_, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.concat(left, right, rest), lambda n: F.struct(k.alias("level"), n.alias("node")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def overlaps(intervals: DataFrame, by: str, bucket_seconds: int) -> DataFrame:
    """Pairs of intervals of a group that overlap (id_a < id_b).

    Two intervals overlap if one begins inside the other.  Time is cut into ticks; an
    interval is posted at the aligned stretches that it is made of (two for each level at
    most), and looks for hosts at the stretches that hold its first tick, one for each
    level in use.  Each pair meets once, however long the intervals are."""
    tick = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / F.lit(bucket_seconds)).cast("long")
    rows = intervals.select(by, "id", "start", "end", tick("start").alias("__lo"), tick("end").alias("__hi"))
    hosts = rows.select(by, *[F.col(c).alias(f"{c}_a") for c in ("id", "start", "end")], F.explode(dyadic_nodes(F.col("__lo"), F.col("__hi"))).alias("__n")).select("*", "__n.level", "__n.node").drop("__n")
    used = hosts.select("level").distinct()  # at most one row for each level
    guests = rows.crossJoin(F.broadcast(used)).select(by, *[F.col(c).alias(f"{c}_b") for c in ("id", "start", "end")], "level", F.call_function("shiftright", F.col("__lo"), F.col("level")).alias("node"))
    both = hosts.join(guests, [by, "level", "node"])
    first = (F.col("start_a") < F.col("start_b")) | ((F.col("start_a") == F.col("start_b")) & (F.col("id_a") < F.col("id_b")))
    both = both.filter(first & (F.col("start_a") < F.col("end_b")) & (F.col("start_b") < F.col("end_a")))
    return both.select(by, F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def schedule(events: DataFrame, time: str, lo, hi) -> DataFrame:
    """Events of each week of [lo, hi], weeks without any included."""
    weeks = events.sparkSession.range(1).select(F.explode(F.sequence(F.date_trunc("week", F.lit(lo)).cast("date"), F.lit(hi).cast("date"), F.expr("interval 7 days"))).alias("week"))
    per = events.groupBy(F.date_trunc("week", time).cast("date").alias("week")).agg(F.count("*").alias("events"))
    return weeks.join(per, "week", "left").withColumn("events", F.coalesce("events", F.lit(0))).withColumn("quiet", F.col("events") == 0)


def tail_share(hist: DataFrame, by: str, bin_: str, n: str, edge: int) -> DataFrame:
    return hist.groupBy(by).agg((F.sum(F.when(F.col(bin_) >= edge, F.col(n)).otherwise(0.0)) / F.nullif(F.sum(n), F.lit(0.0))).alias("tail"))


def arrival_wait(files: DataFrame, cutoffs: DataFrame, at: list[float]) -> DataFrame:
    """Minutes from a file's arrival to the cutoff of its day; percentiles by index, the
    half-even rounding of q * (n - 1).  Waits are whole seconds within a day, so their
    counts, which one task puts in order, are no more than a day has."""
    rows = files.join(F.broadcast(cutoffs), "day").select((F.timestamp_diff("SECOND", "arrival_time", "cutoff") / 60.0).alias("wait"))
    n = rows.agg(F.count("*").alias("n"))
    values = rows.groupBy("wait").agg(F.count("*").alias("m"))
    upto = Window.orderBy("wait").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("upto", F.sum("m").over(upto)).crossJoin(F.broadcast(n))
    want = ranked.withColumn("q", F.explode(F.array(*map(F.lit, at)))).withColumn("i", F.rint(F.col("q") * (F.col("n") - 1)))
    return want.filter((F.col("i") < F.col("upto")) & (F.col("i") >= F.col("upto") - F.col("m"))).select("q", "wait")


def rates(loads: DataFrame, by: str, rows: str, seconds: str, size: str) -> DataFrame:
    return loads.groupBy(by).agg((F.sum(rows) / F.nullif(F.sum(seconds), F.lit(0.0))).alias("rows_per_s"), (F.sum(size) / F.nullif(F.sum(rows), F.lit(0))).alias("bytes_per_row"), F.count("*").alias("loads"))


def power_law(points: DataFrame, x: str, y: str, at: float) -> DataFrame:
    """Power through the points of least and greatest x, and the value at `at`."""
    p = points.agg(F.min(F.struct(x, y)).alias("a"), F.max(F.struct(x, y)).alias("b"))
    e = F.ln(F.col(f"b.{y}") / F.col(f"a.{y}")) / F.ln(F.col(f"b.{x}") / F.col(f"a.{x}"))
    return p.select(e.alias("exponent"), (F.col(f"b.{y}") * F.pow(F.lit(at) / F.col(f"b.{x}"), e)).alias("value"))


def inventory(cells: DataFrame, by: list[str]) -> DataFrame:
    n = cells.groupBy(*by).agg(F.count("*").alias("cells"), F.count_distinct("site").alias("sites"))
    return n.withColumn("share", F.col("cells") / F.sum("cells").over(Window.partitionBy()))


def fingerprint(df: DataFrame) -> DataFrame:
    """Numbers that depend on the rows, not on their order: 48 bits of a digest of each
    row's values as text, in order of column names, summed and by exclusive or."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e")) for c in sorted(df.columns)])
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return df.agg(F.count("*").alias("rows"), F.bit_xor(bits).alias("xor"), F.sum(bits.cast("decimal(38,0)")).alias("total"))
