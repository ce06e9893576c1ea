"""Network-level aggregates, comparisons of KPI tables, and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import report_day

KEY = ["cell_name", "period", "kpi_id", "formula_version"]


def network_day(counters: DataFrame, pairs: dict[str, tuple[str, str]], weight: str | None = None, share: str | None = None) -> DataFrame:
    """Ratio of sums of all cells for each reporting day, and a weighted mean share."""
    out = [(F.sum(a) / F.nullif(F.sum(b), F.lit(0.0))).alias(k) for k, (a, b) in pairs.items()]
    if share:
        there = F.col(share).isNotNull()
        out.append((F.sum(F.when(there, F.col(share) * F.col(weight))) / F.nullif(F.sum(F.when(there, F.col(weight))), F.lit(0.0))).alias(f"{share}_weighted"))
    return counters.groupBy(report_day(F.col("period_start")).alias("day")).agg(*out)


def traffic_mix(counters: DataFrame, cells: DataFrame) -> DataFrame:
    """Weekday and weekend by area class: volume, its share, throughput, weighted load."""
    weekend = F.dayofweek(report_day(F.col("period_start"))).isin(1, 7)
    rows = counters.join(cells.select("cell_name", "area", "n_rb"), "cell_name").withColumn("day_kind", F.when(weekend, "weekend").otherwise("weekday"))
    out = rows.groupBy("day_kind", "area").agg(
        F.sum("ip_vol_kbit").alias("volume"),
        (F.sum("ip_vol_kbit") / F.nullif(F.sum("ip_time_ms"), F.lit(0.0))).alias("throughput"),
        (F.sum(F.col("prb_pct") * F.col("n_rb")) / F.nullif(F.sum(F.when(F.col("prb_pct").isNotNull(), F.col("n_rb"))), F.lit(0))).alias("load"),
    )
    return out.withColumn("share", F.col("volume") / F.nullif(F.sum("volume").over(Window.partitionBy("day_kind")), F.lit(0.0)))


def network_throughput(mix: DataFrame) -> DataFrame:
    """Volume-weighted harmonic mean of the classes' throughputs."""
    return mix.filter("throughput > 0").groupBy("day_kind").agg((F.sum("share") / F.nullif(F.sum(F.col("share") / F.col("throughput")), F.lit(0.0))).alias("throughput"))


def mix_cells(counters: DataFrame) -> DataFrame:
    """Cells busier on weekends than on weekdays, by mean volume of a reported period."""
    weekend = F.dayofweek(report_day(F.col("period_start"))).isin(1, 7)
    per = counters.groupBy("cell_name").agg(F.avg(F.when(weekend, F.col("ip_vol_kbit"))).alias("we"), F.avg(F.when(~weekend, F.col("ip_vol_kbit"))).alias("wd"))
    return per.agg(F.count("*").alias("cells"), F.count_if(F.col("we") > F.col("wd")).alias("busier_on_weekends"), F.count_if(F.col("we") <= F.col("wd")).alias("not_busier"))


def coverage_summary(days: DataFrame) -> DataFrame:
    cell_day = days.groupBy("cell_name", "period").agg(F.min("coverage").alias("coverage"), F.max("suspect_share").alias("suspect_share"))
    return cell_day.agg(F.count("*").alias("cell_days"), F.count_if(F.col("coverage") < 1).alias("below_full"), F.count_if(F.col("suspect_share") > 0).alias("with_suspect"))


def worst_summary(worst: DataFrame) -> DataFrame:
    week = worst.groupBy("week_start").agg(F.count("*").alias("n"))
    return week.agg(F.count("*").alias("weeks"), F.sum("n").alias("cell_weeks"), F.max("n").alias("most_in_a_week"))


def busiest_list(worst: DataFrame, k: int = 10) -> DataFrame:
    """The k first cells of the (KPI, week) with most cells."""
    per = worst.groupBy("kpi_id", "formula_version", "week_start").agg(F.count("*").alias("n"))
    top = per.orderBy(F.desc("n"), "kpi_id", "formula_version", "week_start").limit(1)
    return worst.join(F.broadcast(top), ["kpi_id", "formula_version", "week_start"]).filter(F.col("rank") <= k)


def compare(gold: DataFrame, reference: DataFrame, *, skip: DataFrame | None = None, tolerance: float = 1e-6) -> DataFrame:
    """For each KPI: values compared, agreeing within the tolerance (absolute or relative),
    largest difference, and reference values that gold lacks."""
    ref = reference if skip is None else reference.join(skip.select("cell_name", "period").distinct(), ["cell_name", "period"], "left_anti")
    rows = ref.select(*KEY, F.col("value").alias("want")).join(gold.select(*KEY, F.col("value").alias("have"), F.lit(True).alias("there")), KEY, "left")
    gap = F.abs(F.col("have") - F.col("want"))
    near = (F.col("have").isNull() & F.col("want").isNull()) | (gap <= tolerance * F.greatest(F.lit(1.0), F.abs("want")))
    return rows.groupBy("kpi_id", "formula_version").agg(
        F.count("there").alias("compared"), F.count_if(F.col("there") & F.coalesce(near, F.lit(False))).alias("agreeing"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("largest_gap"), F.count_if(F.col("there").isNull()).alias("missing"),
    )


def ratio_of_sums_check(fine: DataFrame, coarse: DataFrame, to_coarse) -> DataFrame:
    """Coarse values against re-added numerators and denominators, and against the mean of
    the fine ratios (which should differ somewhere)."""
    again = fine.filter("denominator is not null").groupBy("cell_name", to_coarse.alias("period"), "kpi_id", "formula_version").agg(
        F.sum("numerator").alias("n"), F.sum("denominator").alias("d"), F.avg(F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0.0))).alias("mean_ratio")
    )
    both = coarse.filter("denominator is not null").join(again, KEY)
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0.0))
    exact = F.coalesce(F.abs(ratio("numerator", "denominator") - ratio("n", "d")) < 1e-9, F.col("denominator") == 0)
    return both.groupBy("kpi_id", "formula_version").agg(F.count("*").alias("compared"), F.count_if(exact).alias("equal"), F.count_if(F.abs(ratio("numerator", "denominator") - F.col("mean_ratio")) > 1e-9).alias("unlike_mean"))


def version_diff(rows: DataFrame, kpi_id: str, old: int = 1, new: int = 2) -> DataFrame:
    """How two versions of a formula compare, key by key."""
    k = ["cell_name", "period"]
    side = lambda v, name: rows.filter((F.col("kpi_id") == kpi_id) & (F.col("formula_version") == v)).select(*k, F.col("value").alias(name))
    both = side(old, "a").join(side(new, "b"), k)
    return both.agg(F.count("*").alias("pairs"), F.count_if(F.col("b") > F.col("a")).alias("new_above_old"), F.count_if(F.col("b") < F.col("a")).alias("new_below_old"))
