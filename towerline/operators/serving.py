"""Lookups: as-of reads, lineage, time travel and series, as DataFrames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import check_range
from ..functions.names import ancestors, relation_source, relation_target

SERIES_CAP = 20_000


def cells_latest(cm: DataFrame, at=None) -> DataFrame:
    """One row for each (ems, dn): its latest snapshot (at or before a time)."""
    rows = cm if at is None else cm.filter(F.col("time") <= F.lit(at))
    last = rows.groupBy("ems", "dn").agg(F.max_by(F.struct(*[c for c in cm.columns if c not in ("ems", "dn")]), F.struct("time", *[c for c in cm.columns if c not in ("ems", "dn", "time")])).alias("x"))
    return last.select("ems", "dn", "x.*")


def filter_cells(cells: DataFrame, **wanted) -> DataFrame:
    out = cells
    for column, value in wanted.items():
        if value is not None:
            out = out.filter(F.col(column) == value)
    return out


def relations(cm: DataFrame) -> DataFrame:
    """Edges of each system's latest snapshot, from labels 'a->b'."""
    last = cm.groupBy("ems").agg(F.max("time").alias("time"))
    return cm.join(F.broadcast(last), ["ems", "time"]).filter(F.contains("label", F.lit("->"))).select(relation_source(F.col("label")).alias("source"), relation_target(F.col("label")).alias("target")).distinct()


def topology(cells: DataFrame) -> DataFrame:
    return cells.groupBy("site").agg(F.array_sort(F.collect_list("cell_name")).alias("cells"), F.count("*").alias("n"))


def kpi_series(kpis: DataFrame, cell: str, kpi_id: str, version: int, lo: datetime, hi: datetime, cap: int = SERIES_CAP) -> DataFrame:
    """Values of one cell and KPI in [lo, hi); more rows than the cap fail the query."""
    check_range(lo, hi)
    rows = kpis.filter((F.col("cell_name") == cell) & (F.col("kpi_id") == kpi_id) & (F.col("formula_version") == version) & (F.col("period") >= F.lit(lo)) & (F.col("period") < F.lit(hi)))
    numbered = rows.orderBy("period").limit(cap + 1).withColumn("__n", F.count("*").over(Window.partitionBy("cell_name")))
    return numbered.withColumn("value", F.when(F.col("__n") > cap, F.raise_error(F.lit(f"more than {cap} rows")).cast("double")).otherwise(F.col("value"))).drop("__n")


def worst_list(worst: DataFrame, week, kpi_id: str, version: int = 1) -> DataFrame:
    return worst.filter((F.col("week_start") == F.lit(week)) & (F.col("kpi_id") == kpi_id) & (F.col("formula_version") == version)).orderBy("rank")


def snapshot_as_of(history: DataFrame, keys: list[str], time: str, at) -> DataFrame:
    """For each key the row of its latest time at or before `at`."""
    rest = [c for c in history.columns if c not in keys]
    last = history.filter(F.col(time) <= F.lit(at)).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(time, *[c for c in rest if c != time])).alias("x"))
    return last.select(*keys, "x.*")


def _ticks(df: DataFrame, column: str) -> Column:
    """A time or number as a double, for cutting into buckets."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    return F.unix_micros(c.cast("timestamp")).cast("double") if kind in ("timestamp", "timestamp_ntz", "date") else c.cast("double")


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, buckets: int = 512) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    The time span is cut into buckets.  Inside a bucket of a key both sides are merged in
    time order and the last right row is carried forward; what a bucket begins with is the
    last right row of the buckets before it, carried over one row for each bucket.  So no
    pair of rows is built, and a key with most of the rows is spread over its buckets."""
    cols = [c for c in right.columns if c not in keys]
    theirs, ours = (d.select(F.struct(*c)).schema[0].dataType for d, c in ((right, cols), (left, left.columns)))
    a = left.select(*keys, F.col(left_time).alias("__t"), _ticks(left, left_time).alias("__x"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(theirs).alias("__r"))
    b = right.select(*keys, F.col(right_time).alias("__t"), _ticks(right, right_time).alias("__x"), F.lit(0).alias("__side"), F.lit(None).cast(ours).alias("__l"), F.struct(*cols).alias("__r"))
    span = a.select("__x").unionByName(b.select("__x")).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    width = F.greatest((F.col("__hi") - F.col("__lo")) / buckets, F.lit(1e-9))
    bucket = F.coalesce(F.least(F.floor((F.col("__x") - F.col("__lo")) / width), F.lit(buckets - 1)), F.lit(-1)).cast("int").alias("__b")
    cut = lambda side: side.crossJoin(F.broadcast(span)).select(*keys, bucket, "__t", "__side", "__l", "__r")  # noqa: E731  one row
    a, b = cut(a), cut(b)

    order = Window.partitionBy(*keys, "__b").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    inside = a.unionByName(b).withColumn("__r", F.last("__r", ignorenulls=True).over(order)).filter("__side = 1")

    # at most two rows for each bucket of a key
    ends = b.filter("__b >= 0").groupBy(*keys, "__b").agg(F.max_by("__r", "__t").alias("__r"))
    asked = a.select(*keys, "__b").distinct().withColumn("__r", F.lit(None).cast(theirs)).withColumn("__asks", F.lit(0))
    before = Window.partitionBy(*keys).orderBy("__b", "__asks").rowsBetween(Window.unboundedPreceding, 0)
    carried = ends.withColumn("__asks", F.lit(1)).unionByName(asked).withColumn("__c", F.last("__r", ignorenulls=True).over(before)).filter("__asks = 0")
    same = F.lit(True)
    for k in [*keys, "__b"]:
        same = same & F.col(f"i.{k}").eqNullSafe(F.col(f"c.{k}"))
    both = inside.alias("i").join(carried.select(*keys, "__b", "__c").alias("c"), same, "left").select("i.__l", F.coalesce("i.__r", F.when(F.col("i.__t").isNotNull(), F.col("c.__c"))).alias("__r"))
    return both.select("__l.*", *[F.col(f"__r.{c}").alias(c if c not in left.columns else f"right_{c}") for c in cols])


def under(children: DataFrame, parents: DataFrame, child_dn: str = "dn", parent_dn: str = "dn", on: tuple[str, ...] = ("ems",)) -> DataFrame:
    """Children with the parents that they are or lie below (of the same `on`); the
    columns of the parents come last, without their name and `on`."""
    keep = [c for c in parents.columns if c not in (*on, parent_dn)]
    p = parents.select(*on, F.col(parent_dn).alias("__above"), *keep)
    return children.withColumn("__above", F.explode(ancestors(F.col(child_dn)))).join(p, [*on, "__above"]).select(*[f"`{c}`" for c in children.columns], *[f"`{c}`" for c in keep])


def cell_snapshot(cm: DataFrame, cells: DataFrame, at, cell: str | None = None) -> DataFrame:
    """The records of each cell (or one) and of what lies below it, such as its relations,
    in the latest snapshot at or before a time that has any of them."""
    wanted = cells.select("ems", "dn", "cell_name") if cell is None else cells.filter(F.col("cell_name") == cell).select("ems", "dn", "cell_name")
    rows = under(cm.filter(F.col("time") <= F.lit(at)), wanted)
    last = rows.groupBy("cell_name").agg(F.max("time").alias("time"))
    return rows.join(last, ["cell_name", "time"]).distinct()


def cm_changes(log: DataFrame, cells: DataFrame, lo, hi, cell: str | None = None) -> DataFrame:
    """Changes in [lo, hi) of cells and of what lies below them, with the cell's name."""
    wanted = cells.select("ems", "dn", "cell_name") if cell is None else cells.filter(F.col("cell_name") == cell).select("ems", "dn", "cell_name")
    return under(log.filter((F.col("time") >= F.lit(lo)) & (F.col("time") < F.lit(hi))), wanted).distinct()


def alarms(fm: DataFrame, cells: DataFrame, lo, hi) -> DataFrame:
    """Alarms raised in [lo, hi), with the cell if the object is one."""
    rows = fm.filter((F.col("raised") >= F.lit(lo)) & (F.col("raised") < F.lit(hi)))
    return rows.join(cells.select("dn", "cell_name"), "dn", "left").distinct()


def alarm_notifications(fm: DataFrame) -> DataFrame:
    """An alarm is a notification when raised and one when cleared; counted by day."""
    both = F.array(F.struct(F.lit("new").alias("kind"), F.col("raised").alias("time")), F.struct(F.lit("cleared").alias("kind"), F.col("cleared").alias("time")))
    return fm.select(F.explode(both).alias("x")).filter("x.time is not null").groupBy(F.col("x.time").cast("date").alias("day"), F.col("x.kind").alias("kind")).agg(F.count("*").alias("n"))


def config_at(base: DataFrame, changes: DataFrame, at) -> DataFrame:
    """Base attributes (dn, attribute, value) under the changes active at a time: the last
    one with start <= at < end (no end: still active) wins."""
    active = changes.filter((F.col("start") <= F.lit(at)) & (F.col("end").isNull() | (F.col("end") > F.lit(at))))
    last = active.groupBy("dn", "attribute").agg(F.max_by("value", F.struct("start", "value")).alias("changed"))
    return base.join(last, ["dn", "attribute"], "left").select("dn", "attribute", F.coalesce("changed", "value").alias("value"), F.col("changed").isNotNull().alias("is_changed"))


def change_log(changes: DataFrame) -> DataFrame:
    """Each change as an entry when made and one when restored."""
    pair = F.array(F.struct(F.col("start").alias("time"), F.lit("made").alias("entry")), F.struct(F.col("end").alias("time"), F.lit("restored").alias("entry")))
    return changes.select("dn", "attribute", "value", F.explode(pair).alias("x")).filter("x.time is not null").select("dn", "attribute", "value", "x.time", "x.entry")


def lineage(silver: DataFrame, inputs: DataFrame, bronze: DataFrame, ledger: DataFrame, kpi_id: str, version: int, window: Column) -> DataFrame:
    """From a KPI to the files under it: its measurements, their silver rows, the vendor
    counters of each (a derived row names several), bronze rows, deliveries.  The window is
    put on both sides, so both are pruned."""
    names = F.broadcast(inputs.filter((F.col("kpi_id") == kpi_id) & (F.col("formula_version") == version)).select("measurement"))
    rows = silver.filter(window).join(names, "measurement", "left_semi").withColumn("counter", F.explode(F.split("vendor_counter", " / ")))
    raw = bronze.filter(window).select("ems", "cell_name", "period_start", "counter", "file_name", "file_hash", F.col("value").alias("raw_value"))
    found = rows.select("ems", "cell_name", "period_start", "measurement", "counter", "value", "file_name", "file_hash").join(raw, ["ems", "cell_name", "period_start", "counter", "file_name", "file_hash"], "left")
    return found.join(ledger.filter("loaded").select("ems", "file_name", "file_hash", "arrival_time"), ["ems", "file_name", "file_hash"], "left")


def lineage_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_distinct(F.struct("cell_name", "period_start", "measurement")).alias("silver_rows"), F.count_if(F.col("raw_value").isNotNull()).alias("bronze_rows"),
        F.count_distinct("file_name").alias("files"), F.count_distinct("counter").alias("counters"),
    )


def history_as_of(history: DataFrame, keys: list[str], committed: str, at) -> DataFrame:
    """A table as it was at a commit time, from a history stamped with commit times."""
    return snapshot_as_of(history, keys, committed, at)


def before_after(history: DataFrame, keys: list[str], committed: str, first, second) -> DataFrame:
    a = history_as_of(history, keys, committed, first).select(*keys, F.col("value").alias("before"))
    b = history_as_of(history, keys, committed, second).select(*keys, F.col("value").alias("after"))
    return a.join(b, keys, "full").filter(~F.col("before").eqNullSafe(F.col("after")))


def file_status(ledger: DataFrame) -> DataFrame:
    """By system and kind: files, those of the last day, not loaded, latest arrival."""
    now = ledger.agg(F.max("arrival_time").alias("__now"))
    rows = ledger.crossJoin(F.broadcast(now))
    return rows.groupBy("ems", "kind").agg(F.count("*").alias("files"), F.count_if(F.col("arrival_time") > F.col("__now") - F.expr("interval 1 day")).alias("last_day"), F.count_if(~F.col("loaded")).alias("not_loaded"), F.max("arrival_time").alias("latest"))


def lake_clock(ledger: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    a, b, c = ledger.agg(F.max("arrival_time").alias("newest_arrival")), silver.agg(F.max("period_start").alias("silver_end")), gold.agg(F.max("day").alias("gold_day"))
    return a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, t in tables.items():
        row = t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def first_rich_window(events: DataFrame, time: str, kind: str, days: int = 14, step: int = 7, kinds: int = 3) -> DataFrame:
    """The first window of `days` days, starting on Mondays, with at least `kinds` kinds of
    events, and the earliest event of each kind in it."""
    monday = F.date_trunc("week", time).cast("date")
    starts = F.transform(F.sequence(F.lit(0), F.lit(days // step - 1)), lambda i: F.date_sub(monday, i * step))
    rows = events.withColumn("window_start", F.explode(starts))
    rich = rows.groupBy("window_start").agg(F.count_distinct(kind).alias("kinds")).filter(F.col("kinds") >= kinds).agg(F.min("window_start").alias("window_start"))
    return rows.join(F.broadcast(rich), "window_start").groupBy("window_start", kind).agg(F.min(time).alias("first"))


def sample_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    n = nodes.select("node").distinct()
    return edges.join(n.withColumnRenamed("node", "source"), "source", "left_semi").join(n.withColumnRenamed("node", "target"), "target", "left_semi")
