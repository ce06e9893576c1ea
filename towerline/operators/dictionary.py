"""Counter dictionaries: from vendor counters to standard measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_COLUMNS = ("vendor", "release", "meas_group", "counter", "rule", "measurement", "bin", "factor", "attestation")


def counter_map(entries: DataFrame) -> DataFrame:
    """Dictionary entries (vendor, release, meas_group, counter, rule, target, other, bin,
    scale, attestation) -> the map (MAP_COLUMNS).

    copy divides by the scale; sum adds several counters up into one named measurement;
    difference takes the second counter off with factor -1; bin carries its bin number;
    other rules name the helper measurement that a derivation uses."""
    rule = F.col("rule")
    measurement = (
        F.when(rule == "prb_used", "prb.used")
        .when(rule == "prb_avail", "prb.available")
        .when(rule == "availability_samples", "availability.up")
        .when(rule == "samples_total", "availability.all")
        .when(rule == "sum", F.concat_ws(" + ", "target", "other"))
        .otherwise(F.col("target"))
    )
    factor = F.when(rule == "copy", 1.0 / F.col("scale")).when(rule == "difference", -1.0).otherwise(1.0)
    return entries.select(
        "vendor", "release", "meas_group", "counter", "rule", measurement.alias("measurement"),
        F.when(rule == "bin", F.col("bin")).otherwise(-1).cast("int").alias("bin"), factor.alias("factor"), "attestation",
    )


def rename_release(old: DataFrame, renames: DataFrame, release: str) -> DataFrame:
    """The map of a later release: counters in `renames` (counter, new_counter) get their
    new names.  A rename of a counter that the old map lacks fails the query."""
    known = old.select("counter").distinct().withColumn("known", F.lit(True))
    checked = renames.join(known, "counter", "left").select(
        F.col("counter"),
        F.when(F.col("known").isNull(), F.raise_error(F.concat(F.lit("rename of an unknown counter: "), F.col("counter"))).cast("string")).otherwise(F.col("new_counter")).alias("new_counter"),
    )
    return old.join(F.broadcast(checked), "counter", "left").select(
        *[F.coalesce("new_counter", "counter").alias(c) if c == "counter" else F.lit(release).alias(c) if c == "release" else F.col(c) for c in old.columns]
    )


def with_release(values: DataFrame, ems: DataFrame) -> DataFrame:
    """A missing dictionary release is the base release of the sending system."""
    base = F.broadcast(ems.select("ems", "base_release"))
    return values.join(base, "ems", "left").withColumn("release", F.coalesce("release", "base_release")).drop("base_release")


def map_counters(values: DataFrame, counters: DataFrame, *, strict: bool = True) -> DataFrame:
    """values (release, meas_group, counter, value, ...) -> with measurement, bin and scaled
    value.  strict: the first counter that the map lacks fails the query."""
    known = counters.select("release", "meas_group", "counter", F.col("measurement").alias("__m"), "bin", "factor")
    joined = values.join(F.broadcast(known), ["release", "meas_group", "counter"], "left")
    name = F.col("__m")
    if strict:
        name = F.when(name.isNull(), F.raise_error(F.concat(F.lit("unmapped counter: "), F.col("counter"))).cast("string")).otherwise(name)
    return joined.withColumn("measurement", name).withColumn("value", F.col("value") * F.col("factor")).drop("__m", "factor")


def unmapped(values: DataFrame, counters: DataFrame) -> DataFrame:
    keys = ["release", "meas_group", "counter"]
    return values.select(*keys).distinct().join(F.broadcast(counters.select(*keys)), keys, "left_anti")


def derive(staged: DataFrame, keys: list[str]) -> DataFrame:
    """Measurements worked out of helper measurements of the same object and period:
    resource use in per cent, and unavailable seconds from availability samples.

    Flags are or-ed, versions and arrival maxed, the counters' names joined in order."""

    def pick(name: str):
        return F.max(F.when(F.col("measurement") == name, F.col("value")))

    helpers = ["prb.used", "prb.available", "availability.up", "availability.all"]
    wide = (
        staged.filter(F.col("measurement").isin(helpers))
        .groupBy(*keys)
        .agg(
            pick(helpers[0]).alias("used"), pick(helpers[1]).alias("available"), pick(helpers[2]).alias("up"), pick(helpers[3]).alias("of"),
            F.bool_or("suspect").alias("suspect"), F.bool_or("late").alias("late"), F.max("versions").alias("versions"),
            F.array_join(F.array_sort(F.collect_set("counter")), " / ").alias("counter"),
        )
    )
    rows = F.array(
        F.struct(F.lit("RRU.PrbTotDl").alias("measurement"), F.round(100 * F.col("used") / F.nullif(F.col("available"), F.lit(0.0))).alias("value"), (F.col("used").isNotNull() & F.col("available").isNotNull()).alias("has")),
        F.struct(F.lit("RRU.CellUnavailableTime.sum").alias("measurement"), (60 * F.col("granularity_min") * (1 - F.col("up") / F.nullif(F.col("of"), F.lit(0.0)))).alias("value"), (F.col("up").isNotNull() & F.col("of").isNotNull()).alias("has")),
    )
    return (
        wide.withColumn("x", F.explode(rows)).filter("x.has")
        .select(*keys, "x.measurement", "x.value", F.lit(True).alias("derived"), "suspect", "late", "versions", "counter")
    )


def dictionary_summary(counters: DataFrame) -> DataFrame:
    return counters.groupBy("vendor", "release", "attestation").agg(F.count("*").alias("counters"), F.countDistinct("meas_group").alias("groups"))


def renamed_counters(counters: DataFrame) -> DataFrame:
    """Measurements that more than one counter of a vendor stands for."""
    return counters.groupBy("vendor", "measurement", "bin").agg(F.countDistinct("counter").alias("counters")).filter("counters > 1")
