"""Deliveries, versions, late and missing data, load checks and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE = ["ems", "file_name"]
DELIVERY = [*FILE, "file_hash"]


def new_files(arrivals: DataFrame, ledger: DataFrame) -> DataFrame:
    """First delivery of each (ems, name, hash) that the ledger has not loaded."""
    order = Window.partitionBy(*DELIVERY).orderBy("arrival_time")
    seen = ledger.filter("loaded").select(*DELIVERY).distinct()
    return arrivals.join(seen, DELIVERY, "left_anti").withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def file_states(arrivals: DataFrame, cutoff=None) -> DataFrame:
    """State of each file at a cutoff: first arrival, deliveries, loaded versions, and the
    hash of the latest loaded one."""
    rows = arrivals if cutoff is None else arrivals.filter(F.col("arrival_time") <= F.lit(cutoff))
    loaded = F.col("loaded")
    return rows.groupBy(*FILE).agg(
        F.min("period_start").alias("period_start"), F.min("arrival_time").alias("first_arrival"), F.count("*").alias("deliveries"),
        F.count_distinct(F.when(loaded, F.col("file_hash"))).alias("versions"),
        F.max(F.when(loaded, F.struct("arrival_time", "file_hash")))["file_hash"].alias("latest_hash"),
    )


def mark_late(states: DataFrame) -> DataFrame:
    """late: a file of a later period of the same system arrived first.

    The smallest first arrival of all later periods comes from one row for each period,
    so a system's files are never ordered in one task: periods are."""
    per = states.groupBy("ems", "period_start").agg(F.min("first_arrival").alias("first"))
    after = Window.partitionBy("ems").orderBy("period_start").rowsBetween(1, Window.unboundedFollowing)
    later = per.select("ems", "period_start", F.min("first").over(after).alias("__later"))
    return states.join(later, ["ems", "period_start"]).withColumn("late", F.coalesce(F.col("first_arrival") > F.col("__later"), F.lit(False))).drop("__later")


def latest_version(values: DataFrame, states: DataFrame) -> DataFrame:
    """The latest version of a file counts as a whole file."""
    s = states.select(*FILE, F.col("latest_hash").alias("file_hash"), "late", "versions")
    return values.join(s, DELIVERY)


def conflicts(values: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose value in the latest version differs (nulls count) from an older version."""
    s = states.filter("versions > 1").select(*FILE, "latest_hash")
    rows = _versions(values, s, keys)
    return rows.groupBy(*FILE, *keys).agg(_differing().alias("__c")).filter("__c").select(*FILE, *keys)


def _versions(values: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """Values beside their file's state, told apart by whether theirs is the latest version."""
    rows = values.join(states, FILE).withColumn("__new", F.col("file_hash") == F.col("latest_hash"))
    for k in ("__new", *keys):
        rows = rows.filter(F.col(k).isNotNull())
    return rows


def _differing() -> Column:
    """Of a key's values: there is a new and an old one, and not all are alike."""
    unlike = ~F.min("value").eqNullSafe(F.max("value")) | ((F.count("value") > 0) & (F.count("value") < F.count(F.lit(1))))
    return (F.count_if("__new") > 0) & (F.count_if(~F.col("__new")) > 0) & unlike


def with_conflict(latest: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return latest.join(found.withColumn("__c", F.lit(True)), [*FILE, *keys], "left").withColumn("conflict", F.coalesce("__c", F.lit(False))).drop("__c")


def latest_with_conflict(values: DataFrame, states: DataFrame, keys: list[str]) -> DataFrame:
    """`with_conflict` of `latest_version` and `conflicts`, for values with one row for each
    version and key: a key's versions become one row, so that values are read once."""
    s = states.select(*FILE, "latest_hash", "late", "versions")
    rows = values.join(s, FILE).withColumn("__new", F.col("file_hash") == F.col("latest_hash")).filter(F.col("__new").isNotNull())
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    latest = [F.max(F.when(F.col("__new"), F.col(c))).alias(c if c != "value" else "__value") for c in ("file_hash", "value", "late", "versions")]
    one = rows.groupBy(*FILE, *keys).agg(*latest, (_differing() & (F.first("versions") > 1)).alias("conflict"), F.count_if("__new").alias("__n")).filter("__n > 0")
    return one.select(*FILE, "file_hash", *keys, F.col("__value").alias("value"), "late", "versions", (F.col("conflict") & known).alias("conflict"))


def unrecorded(values: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with values that the ledger does not know."""
    return values.select(*DELIVERY).distinct().join(ledger.select(*DELIVERY), DELIVERY, "left_anti")


def check_load(staged: DataFrame, keys: list[str]) -> DataFrame:
    """Violations of a staged load: (rule, rows), rules with none included."""
    level = ~F.endswith("measurement", F.lit("dBm"))
    share = F.startswith("measurement", F.lit("RRU.Prb"))
    dup = staged.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("rows")).select(F.lit("duplicate_key").alias("rule"), "rows")
    rules = {
        "negative_value": level & (F.col("value") < 0), "share_outside_0_100": share & ~F.col("value").between(0, 100), "granularity": ~F.col("granularity_min").isin(15, 60),
    }
    one = staged.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    return dup.unionByName(one.unpivot([], list(rules), "rule", "rows"))


def detect_gaps(staged: DataFrame, lo, hi, granularity_min: int, *, expected: DataFrame | None = None) -> DataFrame:
    """(ems, managed_element, period_start) that an element seen on a UTC day lacks, within
    [lo, hi).  expected: an inventory (ems, managed_element) to use on every day instead."""
    rows = staged.filter((F.col("granularity_min") == granularity_min) & (F.col("period_start") >= F.lit(lo)) & (F.col("period_start") < F.lit(hi)))
    there = rows.select("ems", "managed_element", "period_start").distinct()
    day = F.date_trunc("day", "period_start")
    step = F.make_dt_interval(mins=F.lit(granularity_min))
    if expected is None:
        seen = there.select("ems", "managed_element", day.alias("day")).distinct()
    else:
        days = there.select(F.explode(F.sequence(F.date_trunc("day", F.lit(lo)), F.lit(hi) - step, F.expr("interval 1 day"))).alias("day")).distinct()
        seen = expected.select("ems", "managed_element").crossJoin(days)
    grid = seen.withColumn("period_start", F.explode(F.sequence("day", F.col("day") + F.expr("interval 1 day") - step, step))).drop("day")
    grid = grid.filter((F.col("period_start") >= F.lit(lo)) & (F.col("period_start") < F.lit(hi)))
    return grid.join(there, ["ems", "managed_element", "period_start"], "left_anti")


def newest(rows: DataFrame, keys: list[str], version: Sequence[str] = ()) -> DataFrame:
    """One row for each key: that of the greatest version (ties: the greatest other values)."""
    rest = [c for c in rows.columns if c not in (*keys, *version)]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("__r")) if rest or version else rows.select(*keys).distinct()
    return best.select(*[F.col(c) if c in keys else F.col(f"__r.`{c}`") for c in rows.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], window: Column | None = None) -> DataFrame:
    """The target after rows of the source replaced those with equal keys.  With a window
    (a condition on the target's columns) the source replaces that whole part of it, so a
    row that a corrected version dropped does not survive.  A key that the source repeats
    comes in once, with its greatest values."""
    source = newest(source, keys)
    kept = target.filter(~F.coalesce(window, F.lit(False))) if window is not None else target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(source)


def merge_window(states: DataFrame, minutes: int = 15) -> DataFrame:
    """What a late file may change: its period, or its whole hour if it ends on the hour."""
    end = F.col("period_start") + F.make_dt_interval(mins=F.lit(minutes))
    return states.withColumn("window_end", end).withColumn("window_start", F.when(F.minute("window_end") == 0, F.col("window_end") - F.expr("interval 1 hour")).otherwise(F.col("period_start")))


def catch_up(states: DataFrame, built: DataFrame, watermark, cutoff) -> DataFrame:
    """Files that arrived in (watermark, cutoff] and whose day is built already."""
    fresh = states.filter((F.col("first_arrival") > F.lit(watermark)) & (F.col("first_arrival") <= F.lit(cutoff))).withColumn("day", F.col("period_start").cast("date"))
    return fresh.join(built.select("ems", "day").distinct(), ["ems", "day"], "left_semi")


def repair_gaps(gaps: DataFrame, staged: DataFrame, lo, hi, granularity_min: int) -> DataFrame:
    """The gaps after those of a window were found anew."""
    outside = gaps.filter((F.col("period_start") < F.lit(lo)) | (F.col("period_start") >= F.lit(hi)))
    return outside.unionByName(detect_gaps(staged, lo, hi, granularity_min).select(*gaps.columns))


def pending_partitions(states: DataFrame, loads: DataFrame, now, grace_minutes: int = 30) -> DataFrame:
    """(day, ems) of files whose day is over for at least the grace time and not built."""
    days = states.select(F.col("period_start").cast("date").alias("day"), "ems").distinct()
    over = (F.date_add("day", 1).cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(grace_minutes))) <= F.lit(now)
    return days.filter(over).join(loads.select("day", "ems").distinct(), ["day", "ems"], "left_anti")


def pending_gold(silver_loads: DataFrame, gold_loads: DataFrame, systems: int) -> DataFrame:
    """Days with silver loads that no gold load has answered, once all systems have built
    the day.  A load is answered by its id, so a second catch-up counts."""
    full = silver_loads.groupBy("day").agg(F.count_distinct("ems").alias("n")).filter(F.col("n") == systems).select("day")
    return silver_loads.join(gold_loads.select("load_id").distinct(), "load_id", "left_anti").select("day").distinct().join(full, "day", "left_semi")


def load_record(staged: DataFrame, gaps: DataFrame) -> DataFrame:
    flags = staged.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"{c}_rows") for c in ("derived", "suspect", "conflict", "late")])
    return flags.crossJoin(F.broadcast(gaps.agg(F.count("*").alias("gaps"))))


def evaluate(planted: DataFrame, found: DataFrame, keys: list[str], kind: str = "kind") -> DataFrame:
    """Planted and found cases and those in both, for each kind."""
    p = planted.select(kind, *keys).distinct().withColumn("__p", F.lit(True))
    f = found.select(kind, *keys).distinct().withColumn("__f", F.lit(True))
    both = p.join(f, [kind, *keys], "full")
    return both.groupBy(kind).agg(F.count("__p").alias("planted"), F.count("__f").alias("found"), F.count_if(F.col("__p") & F.col("__f")).alias("matched"))


def missing_files(values: DataFrame, gaps: DataFrame) -> DataFrame:
    """Periods in which every element that a system had that day is missing."""
    day = F.col("period_start").cast("date")
    expected = values.select("ems", "managed_element", day.alias("day")).distinct().groupBy("ems", "day").agg(F.count("*").alias("expected"))
    gone = gaps.groupBy("ems", "period_start", day.alias("day")).agg(F.count_distinct("managed_element").alias("missing"))
    return gone.join(expected, ["ems", "day"]).filter("missing = expected").select("ems", "period_start", "missing")


def continuous_across(values: DataFrame, measurement: str) -> DataFrame:
    """Elements with two releases or more that report the measurement in every period in
    which they report anything."""
    has = F.count_distinct(F.when(F.col("measurement") == measurement, F.col("period_start")))
    return (
        values.groupBy("managed_element")
        .agg(F.count_distinct("release").alias("releases"), F.count_distinct("period_start").alias("periods"), has.alias("with_measurement"))
        .filter("releases >= 2 and periods = with_measurement")
    )


def quality_events(gaps: DataFrame, states: DataFrame, lo, hi) -> DataFrame:
    """One feed of what went wrong in [lo, hi), with a readable detail."""
    inside = (F.col("period_start") >= F.lit(lo)) & (F.col("period_start") < F.lit(hi))
    clock = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    missing = gaps.filter(inside).select(F.lit("missing_period").alias("kind"), "ems", "period_start", F.concat(F.lit("no values of "), "managed_element").alias("detail"))
    f = states.filter(inside)
    late = f.filter("late").select(F.lit("late_file").alias("kind"), "ems", "period_start", F.concat("file_name", F.lit(" arrived "), clock("first_arrival")).alias("detail"))
    again = f.filter("deliveries > 1").select(
        F.when(F.col("versions") > 1, "changed_redelivery").otherwise("duplicate_delivery").alias("kind"), "ems", "period_start",
        F.concat("file_name", F.lit(" delivered "), F.col("deliveries").cast("string"), F.lit(" times")).alias("detail"),
    )
    return missing.unionByName(late).unionByName(again)


def case_counts(gaps: DataFrame, states: DataFrame, staged: DataFrame) -> DataFrame:
    """(case, rows) of the kinds of faulty data."""
    f = states.agg(F.count_if("late").alias("late_files"), F.count_if((F.col("deliveries") > 1) & (F.col("versions") <= 1)).alias("duplicate_deliveries"), F.count_if(F.col("versions") > 1).alias("changed_files"))
    v = staged.agg(F.count_if("suspect").alias("suspect_values"), F.count_if("conflict").alias("conflict_values"), F.count_if(F.col("value").isNull()).alias("null_values"))
    out = None
    for part in (f, v, gaps.agg(F.count("*").alias("gaps"))):
        rows = part.unpivot([], part.columns, "case", "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def flag_counts(staged: DataFrame, by: list[str]) -> DataFrame:
    return staged.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if("suspect").alias("suspect"), F.count_if("late").alias("late"), F.count_if("conflict").alias("conflict"), F.count_if(F.col("value").isNull()).alias("empty"))


def complete_days(loads: DataFrame, systems: int) -> DataFrame:
    """Reporting days whose two UTC days are built by all systems."""
    built = loads.groupBy("day").agg(F.count_distinct("ems").alias("n")).filter(F.col("n") == systems).select("day")
    return built.join(built.select(F.date_sub("day", 1).alias("day")), "day", "left_semi")


def invariants(wide: DataFrame, pairs: list[tuple[str, str]], shares: list[str]) -> DataFrame:
    """(rule, rows) that break: successes above attempts, shares outside 0 to 100."""
    rules = {f"{s} <= {a}": F.col(s) > F.col(a) for s, a in pairs} | {f"{c} in 0 to 100": ~F.col(c).between(0, 100) for c in shares}
    return wide.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()]).unpivot([], list(rules), "rule", "rows")


def consistency(records: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of records by keys against the counts that they should have."""
    have = records.groupBy(*keys).agg(F.count("*").alias("exported"))
    return have.join(expected, keys, "full").select(*keys, F.coalesce("exported", F.lit(0)).alias("exported"), F.coalesce("expected", F.lit(0)).alias("expected")).withColumn("agrees", F.col("exported") == F.col("expected"))


def leaks(export: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of an export that give away an answer; must be none."""
    return export.join(answers.select(*keys).distinct(), keys, "left_semi")
