"""KPI specifications as data, and their evaluation in one pass over window sums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clock import bucket, periods_expected


@dataclass(frozen=True)
class Kpi:
    """Expressions over the sums of a window.  A row is emitted only where `needs` holds;
    `factors`: the value is their product times `scale` (each a numerator / denominator)."""

    kpi_id: str
    version: int
    technology: str
    scale: float
    factors: tuple[tuple[str, str], ...]
    needs: tuple[str, ...]
    better: str
    breach: float | None = None
    parts: tuple[str, str] | None = None
    unit: str = "%"
    name: str = ""

    def value(self) -> Column:
        out = F.lit(self.scale)
        for top, bottom in self.factors:
            out = out * (F.expr(top).cast("double") / F.nullif(F.expr(bottom).cast("double"), F.lit(0.0)))
        return out

    def emitted(self) -> Column:
        out = F.lit(True)
        for x in self.needs:
            out = out & (F.expr(x) if ">" in x else F.col(x).isNotNull())
        return out


#: The formulas of the catalog (ratio of sums over a window).
CATALOG: tuple[Kpi, ...] = (
    Kpi("LTE_ERAB_ACC", 1, "LTE", 100.0, (("rrc_succ", "rrc_att"), ("s1_succ", "s1_att"), ("erab_succ", "erab_att")), ("rrc_att", "s1_att", "erab_att"), "higher", 95.0, name="E-RAB accessibility"),
    Kpi("LTE_ERAB_RET", 1, "LTE", 3600.0, (("erab_rel", "session_s"),), ("erab_rel", "session_s"), "lower", None, ("erab_rel", "session_s / 3600"), "1/h", "E-RAB retainability"),
    Kpi("LTE_IP_THP_DL", 1, "LTE", 1000.0, (("ip_vol_kbit", "ip_time_ms"),), ("ip_vol_kbit", "ip_time_ms"), "higher", None, ("ip_vol_kbit", "ip_time_ms / 1000"), "kbit/s", "IP throughput downlink"),
    Kpi("LTE_AVAIL", 1, "LTE", 100.0, (("900 * unavail_n - unavail_s", "900 * unavail_n"),), ("unavail_n > 0",), "higher", 99.0, ("900 * unavail_n - unavail_s", "900 * unavail_n"), name="Cell availability"),
    Kpi("LTE_MOB_HOSR", 1, "LTE", 100.0, (("ho_succ", "ho_att"),), ("ho_att",), "higher", 95.0, ("ho_succ", "ho_att"), name="Handover success"),
    Kpi("LTE_RRC_SSR", 1, "LTE", 100.0, (("rrc_succ", "rrc_att"),), ("rrc_att",), "higher", 97.0, ("rrc_succ", "rrc_att"), name="RRC setup success"),
    Kpi("LTE_RRC_SSR", 2, "LTE", 100.0, (("rrc_succ", "rrc_att"), ("s1_succ", "s1_att")), ("rrc_att", "s1_att"), "higher", 97.0, name="RRC and S1 setup success"),
    Kpi("LTE_ERAB_DROP", 1, "LTE", 100.0, (("erab_rel", "erab_succ"),), ("erab_rel", "erab_succ"), "lower", 2.0, ("erab_rel", "erab_succ"), name="E-RAB drop"),
    Kpi("LTE_PRB_UTIL", 1, "LTE", 1.0, (("prb_sum", "prb_n"),), ("prb_n > 0",), "lower", 80.0, ("prb_sum", "prb_n"), name="Resource block use"),
    Kpi("LTE_CQI_MEAN", 1, "LTE_CQI", 1.0, (("cqi_weighted", "cqi_samples"),), ("cqi_samples",), "higher", None, ("cqi_weighted", "cqi_samples"), "index", "Mean CQI"),
    Kpi("GSM_SAS", 1, "GSM", 100.0, (("tch_succ", "tch_req - tch_blocked"), ("ia_succ", "ia_att")), ("tch_req", "tch_blocked", "ia_att"), "higher", 95.0, name="Service access success"),
    Kpi("GSM_ABN_REL", 1, "GSM", 100.0, (("tch_lost + ho_unsucc", "tch_succ + ho_in"),), ("tch_lost", "ho_unsucc", "ho_in"), "lower", 2.0, ("tch_lost + ho_unsucc", "tch_succ + ho_in"), name="Abnormal release"),
    Kpi("GSM_HOSR", 1, "GSM", 100.0, (("ho_succ", "ho_att"),), ("ho_att",), "higher", 95.0, ("ho_succ", "ho_att"), name="Handover success"),
    Kpi("GSM_CSSR", 1, "GSM", 100.0, (("ia_att - sdcch_blocked", "ia_att"), ("tch_succ", "tch_req")), ("sdcch_blocked", "ia_att", "tch_req"), "higher", 95.0, name="Call setup success"),
    Kpi("GSM_TCH_BLOCK", 1, "GSM", 100.0, (("tch_blocked", "tch_req"),), ("tch_blocked", "tch_req"), "lower", 2.0, ("tch_blocked", "tch_req"), name="TCH blocking"),
    Kpi("GSM_SDCCH_BLOCK", 1, "GSM", 100.0, (("sdcch_blocked", "ia_att"),), ("sdcch_blocked", "ia_att"), "lower", 2.0, ("sdcch_blocked", "ia_att"), name="SDCCH blocking"),
    Kpi("GSM_SDCCH_DROP", 1, "GSM", 100.0, (("sdcch_lost", "ia_succ"),), ("sdcch_lost", "ia_succ"), "lower", 2.0, ("sdcch_lost", "ia_succ"), name="SDCCH drop"),
)

#: Wide counter columns and the standard measurements that they hold.
LTE_COUNTERS = {
    "rrc_att": "RRC.ConnEstabAtt.sum", "rrc_succ": "RRC.ConnEstabSucc.sum", "s1_att": "S1SIG.ConnEstabAtt", "s1_succ": "S1SIG.ConnEstabSucc",
    "erab_att": "ERAB.EstabInitAttNbr.sum", "erab_succ": "ERAB.EstabInitSuccNbr.sum", "erab_rel": "ERAB.RelActNbr.sum", "session_s": "ERAB.SessionTimeUE",
    "ip_vol_kbit": "DRB.IPVolDl.sum", "ip_time_ms": "DRB.IPTimeDl.sum", "prb_pct": "RRU.PrbTotDl", "unavail_s": "RRU.CellUnavailableTime.sum",
    "ho_att": "HO.OutAttTarget.sum", "ho_succ": "HO.OutSuccTarget.sum",
}
GSM_COUNTERS = {
    "tch_req": "attTCHSeizures + attTCHSeizuresMeetingTCHBlockedState", "tch_blocked": "attTCHSeizuresMeetingTCHBlockedState", "tch_succ": "succTCHSeizures",
    "ia_att": "attImmediateAssingProcs", "ia_succ": "succImmediateAssingProcs", "sdcch_blocked": "attSDCCHSeizuresMeetingSDCCHBlockedState",
    "sdcch_lost": "nbrOfLostRadioLinksSDCCH", "tch_lost": "nbrOfLostRadioLinksTCH", "ho_att": "attOutgoingInternalInterCellHDOs",
    "ho_succ": "succOutgoingInternalInterCellHDOs", "ho_unsucc": "unsuccHDOsWithReconnection + unsuccHDOsWithLossOfConnection", "ho_in": "succIncomingInternalInterCellHDOs",
}
COUNTERS = {"LTE": LTE_COUNTERS, "GSM": GSM_COUNTERS}


def silver_rows(measurements: DataFrame, granularity_min: int, names: list[str], lo, hi) -> DataFrame:
    """One granularity and some measurements of a half-open time range."""
    return measurements.filter((F.col("granularity_min") == granularity_min) & F.col("measurement").isin(names) & (F.col("period_start") >= F.lit(lo)) & (F.col("period_start") < F.lit(hi)))


def _ranked(rows: DataFrame, column: str) -> tuple[DataFrame, Column]:
    """A text of few distinct values as its rank among them, and the text of the rank that a
    column of that name holds: the least of numbers lets Spark hash sums instead of sorting."""
    values = rows.agg(F.array_sort(F.collect_set(column))).scalar()
    return rows.withColumn(column, F.array_position(values, F.col(column))), F.element_at(values, F.col(column).cast("int")).alias(column)


def cell_counters(rows: DataFrame, cells: DataFrame, technology: str) -> DataFrame:
    """Long to wide: sums of each counter for a cell and period; reported: any value is
    there; suspect: any value is flagged.

    Rows are summed by their own keys, which leaves one of all measurements, before they meet
    the inventory.  Only cells of several entries in it are then summed again."""
    names = list(COUNTERS[technology])
    wanted = cells.filter(F.col("technology") == technology).select("ems", "dn", "cell_name", (F.count("*").over(Window.partitionBy("cell_name")) == 1).alias("__alone"))
    rows, vendor = _ranked(rows, "vendor")
    least = lambda: [F.min("vendor").alias("vendor"), F.bool_or("suspect").alias("suspect")]
    sums = [F.sum(F.when(F.col("measurement") == m, F.col("value"))).alias(c) for c, m in COUNTERS[technology].items()]
    per = rows.groupBy(F.col("ems").alias("__ems"), F.col("cell_dn").alias("__dn"), "period_start").agg(*least(), *sums, F.count("value").alias("__n"))
    met = per.join(wanted, (F.col("__ems") == F.col("ems")) & (F.col("__dn") == F.col("dn")))
    out = ["cell_name", "period_start", "vendor", *names, "suspect", "__n"]
    again = met.filter(~F.col("__alone")).groupBy("cell_name", "period_start").agg(*least(), *[F.sum(c).alias(c) for c in names], F.sum("__n").alias("__n"))
    return met.filter("__alone").select(*out).unionByName(again).select("cell_name", "period_start", vendor, *names, (F.col("__n") > 0).alias("reported"), "suspect")


def distribution_moments(rows: DataFrame, measurement: str) -> DataFrame:
    """Weighted and plain totals of a binned measurement, by cell and hour."""
    return (
        rows.filter((F.col("measurement") == measurement) & (F.col("bin") >= 0))
        .groupBy("cell_name", "period_start")
        .agg(F.min("vendor").alias("vendor"), F.sum(F.col("value") * F.col("bin")).alias("cqi_weighted"), F.sum("value").alias("cqi_samples"), (F.count("value") > 0).alias("reported"), F.bool_or("suspect").alias("suspect"))
    )


def window_sums(counters: DataFrame, technology: str, granularity: str) -> DataFrame:
    """Sums of the wide counters by cell and window, with periods reported and suspect."""
    names = ["cqi_weighted", "cqi_samples"] if technology == "LTE_CQI" else list(COUNTERS[technology])
    have = [c for c in names if c in counters.columns]
    sums = [F.sum(c).alias(c) for c in have if c not in ("prb_pct", "unavail_s")]
    if "prb_pct" in have:
        sums += [F.sum("prb_pct").alias("prb_sum"), F.count("prb_pct").alias("prb_n")]
    if "unavail_s" in have:
        sums += [F.sum("unavail_s").alias("unavail_s"), F.count("unavail_s").alias("unavail_n")]
    counters, vendor = _ranked(counters, "vendor")
    out = (
        counters.groupBy("cell_name", bucket(F.col("period_start"), granularity).alias("period"))
        .agg(F.min("vendor").alias("vendor"), *sums, F.count_if("reported").alias("periods_reported"), F.count_if(F.col("reported") & F.col("suspect")).alias("periods_suspect"))
    )
    return out.select(*[vendor if c == "vendor" else c for c in out.columns])


def week_sums(days: DataFrame) -> DataFrame:
    """Sums by week out of those by day, so that raw counters are read once for both."""
    sums = [F.sum(c).alias(c) for c in days.columns if c not in ("cell_name", "period", "vendor")]
    return days.groupBy("cell_name", F.date_trunc("week", "period").cast("date").alias("period")).agg(F.min("vendor").alias("vendor"), *sums)


def wanted(technology: str, versions: dict[str, list[int]] | None = None, only: str | None = None) -> list[Kpi]:
    """The specs that a run computes: version 1 unless `versions` lists others."""
    return [k for k in CATALOG if k.technology == technology and k.version in (versions or {}).get(k.kpi_id, [1]) and only in (None, k.kpi_id)]


def kpi_rows(sums: DataFrame, specs: list[Kpi], expected: int, digits: int | None = None) -> DataFrame:
    """One row for each window and KPI whose counters are there, all specs in one pass.
    Shares of periods are worked out (and with digits rounded) once for each window."""
    row = [
        F.when(
            k.emitted(),
            F.struct(
                F.lit(k.kpi_id).alias("kpi_id"), F.lit(k.version).alias("formula_version"), k.value().alias("value"),
                (F.expr(k.parts[0]) if k.parts else F.lit(None)).cast("double").alias("numerator"),
                (F.expr(k.parts[1]) if k.parts else F.lit(None)).cast("double").alias("denominator"),
            ),
        )
        for k in specs
    ]
    share = lambda c: c if digits is None else F.round(c, digits)
    windows = sums.select(
        "cell_name", "period", "vendor", "periods_reported", share(F.col("periods_reported") / F.lit(expected)).alias("coverage"),
        share(F.col("periods_suspect") / F.nullif(F.col("periods_reported"), F.lit(0))).alias("suspect_share"), F.array(*row).alias("x"),
    )
    out = windows.withColumn("x", F.explode("x")).filter("x is not null")
    return out.select("cell_name", "period", "vendor", "x.*", F.lit(expected).alias("periods_expected"), "periods_reported", "coverage", "suspect_share")


def kpi_table(counters: DataFrame, technology: str, granularity: str, *, versions: dict[str, list[int]] | None = None, only: str | None = None, minutes: int = 15, specs: list[Kpi] | None = None, digits: int | None = None) -> DataFrame:
    specs = specs if specs is not None else wanted(technology, versions, only)
    return kpi_rows(window_sums(counters, technology, granularity), specs, periods_expected(granularity, minutes), digits)


def kpi_catalog(spark: SparkSession, specs: tuple[Kpi, ...] = CATALOG, revised_from: str | None = None) -> DataFrame:
    rows = [
        (k.kpi_id, k.version, k.name, k.technology.split("_")[0], " * ".join([f"{k.scale:g}", *(f"({a}) / ({b})" for a, b in k.factors)]), k.unit, k.better, k.breach, revised_from if k.version > 1 else None)
        for k in specs
    ]
    return spark.createDataFrame(rows, "kpi_id string, formula_version int, name string, technology string, formula string, unit string, better string, breach_threshold double, effective_from string")


def kpi_inputs(spark: SparkSession, specs: tuple[Kpi, ...] = CATALOG) -> DataFrame:
    """(kpi_id, formula_version, measurement): what a KPI reads."""
    rows = []
    for k in specs:
        text = " ".join([*(x for f in k.factors for x in f), *k.needs]).replace("prb_sum", "prb_pct").replace("unavail_n", "unavail_s")
        names = COUNTERS.get(k.technology, {})
        rows += [(k.kpi_id, k.version, m) for c, m in names.items() if c in text.replace("(", " ").split()]
        if k.technology == "LTE_CQI":
            rows.append((k.kpi_id, k.version, "CARR.WBCQIDist"))
    return spark.createDataFrame(rows, "kpi_id string, formula_version int, measurement string")


def worst_cells_week(days: DataFrame, weeks: DataFrame, catalog: DataFrame, *, persistence_n: int = 3, persistence_m: int = 7, min_coverage: float = 0.8) -> DataFrame:
    """Cells that breach a KPI's threshold on enough judged days of a week, ranked by the
    days of breach, then by how far the week's value is beyond the threshold."""
    limits = F.broadcast(catalog.filter("breach_threshold is not null").select("kpi_id", "formula_version", "better", "breach_threshold"))
    keys = ["kpi_id", "formula_version"]

    judged = days.filter((F.col("coverage") >= min_coverage) & F.col("value").isNotNull()).join(limits, keys)
    counted = judged.groupBy(F.date_trunc("week", "day").cast("date").alias("week_start"), *keys, "cell_name", "better", "breach_threshold").agg(
        F.count("*").alias("days_judged"), F.count_if(_beyond(F.col("value")) > 0).alias("breach_days")
    )
    weekly = weeks.select("week_start", *keys, "cell_name", F.col("value").alias("week_value"))
    rows = counted.filter(F.col("breach_days") >= persistence_n).join(weekly, ["week_start", *keys, "cell_name"], "left")
    return _by_rank(rows, persistence_n, persistence_m)


def _beyond(value: Column) -> Column:
    """How far a value is beyond the threshold of its row."""
    gap = F.col("breach_threshold") - value
    return F.when(F.col("better") == "higher", gap).otherwise(-gap)


def _by_rank(rows: DataFrame, persistence_n: int, persistence_m: int) -> DataFrame:
    keys = ["kpi_id", "formula_version"]
    order = Window.partitionBy("week_start", *keys).orderBy(F.desc("breach_days"), F.col("margin").desc_nulls_last(), "cell_name")
    return (
        rows.withColumn("margin", _beyond(F.col("week_value")))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .select("week_start", *keys, "cell_name", "days_judged", "breach_days", F.lit(persistence_n).alias("persistence_n"), F.lit(persistence_m).alias("persistence_m"), "week_value", "breach_threshold", "better", "rank")
    )


def worst_cells_of_sums(days: DataFrame, specs: list[Kpi], *, minutes: int = 15, persistence_n: int = 3, persistence_m: int = 7, min_coverage: float = 0.8, digits: int | None = None) -> DataFrame:
    """`worst_cells_week` out of the sums of days: a cell's week is one row, with its sums and
    the days judged and breached for each KPI, so no day has a row for each KPI and nothing
    is joined.  digits: those of a day's value."""
    judged = [k for k in specs if k.breach is not None]
    covered = F.col("periods_reported") / F.lit(periods_expected("day", minutes)) >= min_coverage
    counts = []
    for i, k in enumerate(judged):
        value = k.value() if digits is None else F.round(k.value(), digits)
        gap = F.lit(k.breach) - value if k.better == "higher" else value - F.lit(k.breach)
        counts += [(f"__gap{i}", F.when(covered & k.emitted(), gap))]
    sums = [F.sum(c).alias(c) for c in days.columns if c not in ("cell_name", "period", "vendor")]
    per_day = days.select(*[c for c in days.columns if c != "vendor"], *[c.alias(n) for n, c in counts])
    weeks = per_day.groupBy("cell_name", F.date_trunc("week", "period").cast("date").alias("week_start")).agg(
        *sums, *[F.count(n).alias(n) for n, _ in counts], *[F.count_if(F.col(n) > 0).alias(n.replace("gap", "beyond")) for n, _ in counts]
    )
    row = [
        F.when(F.col(f"__beyond{i}") >= persistence_n, F.struct(
            F.lit(k.kpi_id).alias("kpi_id"), F.lit(k.version).alias("formula_version"), F.lit(k.better).alias("better"), F.lit(k.breach).alias("breach_threshold"),
            F.col(f"__gap{i}").alias("days_judged"), F.col(f"__beyond{i}").alias("breach_days"), F.when(k.emitted(), k.value()).alias("week_value"),
        ))
        for i, k in enumerate(judged)
    ]
    rows = weeks.select("cell_name", "week_start", F.explode(F.array(*row)).alias("x")).filter("x is not null and x.days_judged > 0").select("cell_name", "week_start", "x.*")
    return _by_rank(rows, persistence_n, persistence_m)
