"""Queries of the dictionary and KPI operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import bucket
from ..operators import dictionary, kpis, network
from .registry import register, rounded
from .views import Views, with_views


def mapped(v: Views):
    return dictionary.map_counters(v.bronze(), dictionary.counter_map(v.entries()))


def silver(v: Views):
    """Standard measurements of a cell and period."""
    return mapped(v).groupBy("ems", "cell_name", "period_start", "measurement").agg(F.sum("value").alias("value"), F.bool_or("suspect").alias("suspect")).withColumn("granularity_min", F.lit(15))


SILVER = """silver AS (SELECT ems, cell_name, period_start, measurement, sum(value * factor) AS value, bool_or(suspect) AS suspect FROM bronze JOIN cmap USING (release, counter)
  GROUP BY ems, cell_name, period_start, measurement)"""
_B = ("bronze", "cmap")

register("b01_counter_map", lambda v: dictionary.counter_map(v.entries()).join(v.bronze().groupBy("release", "counter").agg(F.count("*").alias("rows")), ["release", "counter"], "left").select("release", "counter", "measurement", F.round("factor", 6).alias("factor"), "attestation", F.coalesce("rows", F.lit(0)).alias("rows")),
         with_views(*_B, body="SELECT release, counter, measurement, round(factor, 6) AS factor, attestation, count(row_id) AS rows FROM cmap LEFT JOIN bronze USING (release, counter) GROUP BY ALL"))
register("b02_rename_release", lambda v: dictionary.rename_release(dictionary.counter_map(v.entries()).filter("release = 'R1'"), v.spark.createDataFrame([("click", "click_v2")], "counter string, new_counter string"), "R2").select("release", "counter", "measurement").join(v.bronze().select("release", "counter").distinct(), ["release", "counter"]),
         with_views(*_B, body="SELECT DISTINCT c.release, c.counter, c.measurement FROM cmap c JOIN bronze b ON b.release = c.release AND b.counter = c.counter WHERE c.release = 'R2'"))
register("b03_map_counters", lambda v: rounded(mapped(v).groupBy("ems", "measurement").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))),
         with_views(*_B, body="SELECT ems, measurement, count(*) AS rows, round(sum(value * factor), 6) AS total FROM bronze JOIN cmap USING (release, counter) GROUP BY ALL"))
register("b04_with_release", lambda v: dictionary.with_release(v.bronze().withColumn("release", F.when(F.col("suspect"), F.lit(None)).otherwise(F.col("release"))), v.spark.createDataFrame([("ems0", "R1"), ("ems1", "R2")], "ems string, base_release string")).groupBy("ems", "release").agg(F.count("*").alias("rows")),
         with_views("bronze", body="SELECT ems, CASE WHEN suspect THEN CASE ems WHEN 'ems0' THEN 'R1' ELSE 'R2' END ELSE release END AS release, count(*) AS rows FROM bronze GROUP BY ALL"))


def _helpers(v: Views):
    kind = F.col("counter")
    name = F.when(kind.isin("click", "click_v2"), "prb.available").when(kind == "view", "prb.used").when(kind == "error", "availability.up").otherwise("availability.all")
    rows = v.bronze().withColumn("measurement", name)
    per = rows.groupBy("ems", "cell_name", F.date_trunc("day", "period_start").alias("period_start"), "measurement").agg(F.sum("value").alias("value"), F.bool_or("suspect").alias("suspect"), F.min("counter").alias("counter"))
    return per.withColumn("late", F.lit(False)).withColumn("versions", F.lit(1)).withColumn("granularity_min", F.lit(15))


register("b05_derive", lambda v: rounded(dictionary.derive(_helpers(v), ["ems", "cell_name", "period_start", "granularity_min"]).select("ems", "cell_name", "period_start", "measurement", F.col("value").cast("double").alias("value"), "suspect", "counter"), 4),
         with_views("bronze", body="""
, h AS (SELECT ems, cell_name, date_trunc('day', period_start)::TIMESTAMP AS period_start, CASE WHEN counter IN ('click', 'click_v2') THEN 'a' WHEN counter = 'view' THEN 'u' WHEN counter = 'error' THEN 'p' ELSE 'o' END AS m, sum(value) AS value, bool_or(suspect) AS suspect, min(counter) AS counter FROM bronze GROUP BY ALL),
w AS (SELECT ems, cell_name, period_start, max(value) FILTER (WHERE m = 'a') AS a, max(value) FILTER (WHERE m = 'u') AS u, max(value) FILTER (WHERE m = 'p') AS p, max(value) FILTER (WHERE m = 'o') AS o, bool_or(suspect) AS suspect, string_agg(DISTINCT counter, ' / ' ORDER BY counter) AS counter FROM h GROUP BY ALL)
SELECT ems, cell_name, period_start, 'RRU.PrbTotDl' AS measurement, round(100 * u / nullif(a, 0)) AS value, suspect, counter FROM w WHERE a IS NOT NULL AND u IS NOT NULL
UNION ALL SELECT ems, cell_name, period_start, 'RRU.CellUnavailableTime.sum', round(900 * (1 - p / nullif(o, 0)), 4), suspect, counter FROM w WHERE p IS NOT NULL AND o IS NOT NULL""".replace("\n, h AS", "\n, h AS", 1)))
register("b10_dictionary_summary", lambda v: dictionary.dictionary_summary(dictionary.counter_map(v.entries()).join(v.bronze().select("release", "counter").distinct(), ["release", "counter"], "left_semi")).select("release", "attestation", "counters"),
         with_views(*_B, body="SELECT release, attestation, count(*) AS counters FROM cmap WHERE (release, counter) IN (SELECT release, counter FROM bronze) GROUP BY ALL"))
register("b11_renamed_counters", lambda v: dictionary.renamed_counters(dictionary.counter_map(v.entries()).join(v.bronze().select("release", "counter").distinct(), ["release", "counter"], "left_semi")).select("measurement", "counters"),
         with_views(*_B, body="SELECT measurement, count(DISTINCT counter) AS counters FROM cmap WHERE (release, counter) IN (SELECT release, counter FROM bronze) GROUP BY ALL HAVING count(DISTINCT counter) > 1"))

# Cell counters from long rows, with real pivoting.
def _cells(v: Views):
    return v.bronze().select("ems", "cell_name").distinct().select("ems", F.col("cell_name").alias("dn"), "cell_name", F.lit("LTE").alias("technology"))


def lte_wide(v: Views):
    rows = silver(v).withColumn("cell_dn", F.col("cell_name")).withColumn("vendor", F.lit("A")).drop("cell_name")
    return kpis.cell_counters(rows, _cells(v), "LTE")


_LONG = {"rrc_att": "RRC.ConnEstabAtt.sum", "rrc_succ": "RRC.ConnEstabSucc.sum", "erab_rel": "ERAB.RelActNbr.sum", "erab_succ": "ERAB.EstabInitSuccNbr.sum", "ip_vol_kbit": "DRB.IPVolDl.sum"}
CELL = "cell15 AS (SELECT cell_name, period_start, " + ", ".join(f"sum(value) FILTER (WHERE measurement = '{m}') AS {c}" for c, m in _LONG.items()) + ", count(value) > 0 AS reported, bool_or(suspect) AS suspect FROM silver GROUP BY cell_name, period_start)"
register("d02_silver_rows", lambda v: rounded(kpis.silver_rows(silver(v), 15, ["RRC.ConnEstabAtt.sum", "RRC.ConnEstabSucc.sum"], _ts("2024-01-10"), _ts("2024-01-20")).drop("granularity_min")),
         with_views(*_B, body=f", {SILVER} SELECT ems, cell_name, period_start, measurement, round(value, 6) AS value, suspect FROM silver WHERE measurement LIKE 'RRC.%' AND period_start >= TIMESTAMP '2024-01-10' AND period_start < TIMESTAMP '2024-01-20'"))


def _ts(text: str):
    from datetime import datetime

    return datetime.fromisoformat(text)


register("d03_lte_cell_15m", lambda v: rounded(lte_wide(v).select("cell_name", "period_start", *_LONG, "reported", "suspect")),
         with_views(*_B, body=f", {SILVER}, {CELL} SELECT cell_name, period_start, " + ", ".join(f"round({c}, 6) AS {c}" for c in _LONG) + ", reported, suspect FROM cell15"))


def gsm_wide(v: Views):
    """GSM counters out of long rows that line items stand for."""
    names = list(kpis.GSM_COUNTERS.values())
    rows = v.wide().select("cell_name", "period_start", F.posexplode(F.array(*[F.col(c) for c in kpis.GSM_COUNTERS])).alias("i", "value"), "vendor", "suspect")
    rows = rows.select(F.lit("e").alias("ems"), F.col("cell_name").alias("cell_dn"), "period_start", F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("measurement"), "value", "vendor", "suspect")
    cells = v.cells().select(F.lit("e").alias("ems"), F.col("cell_name").alias("dn"), "cell_name", F.lit("GSM").alias("technology"))
    return kpis.cell_counters(rows, cells, "GSM")


register("d04_gsm_cell_15m", lambda v: rounded(gsm_wide(v)),
         with_views("wide", body="SELECT cell_name, period_start, min(vendor) AS vendor, " + ", ".join(f"round(sum({c}), 6) AS {c}" for c in kpis.GSM_COUNTERS) + ", true AS reported, bool_or(suspect) AS suspect FROM wide GROUP BY cell_name, period_start"))


def _distribution(v: Views):
    e = v.table("events")
    return e.select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("cell_name"), F.date_trunc("hour", "ts").alias("period_start"), F.lit("CARR.WBCQIDist").alias("measurement"), F.lit("A").alias("vendor"), F.floor(F.col("value") % 16).cast("int").alias("bin"), "value", F.lit(False).alias("suspect"))


register("d05_distribution_moments", lambda v: rounded(kpis.distribution_moments(_distribution(v), "CARR.WBCQIDist").select("cell_name", "period_start", "cqi_weighted", "cqi_samples")),
         "SELECT 'c' || user_id AS cell_name, date_trunc('hour', ts)::TIMESTAMP AS period_start, round(sum(value * floor(value % 16)), 6) AS cqi_weighted, round(sum(value), 6) AS cqi_samples FROM events GROUP BY ALL")
BUCKET = {"15m": "time_bucket(INTERVAL '15 minutes', {0})", "hour": "date_trunc('hour', {0})::TIMESTAMP", "day": "({0} + INTERVAL 7 HOUR)::DATE", "week": "date_trunc('week', ({0} + INTERVAL 7 HOUR)::DATE)::DATE"}
EXPECTED = {"15m": 1, "hour": 4, "day": 96, "week": 672}
for _g in BUCKET:
    register(f"d06_bucket_{_g}", lambda v, g=_g: v.table("events").groupBy(bucket(F.col("ts"), g).alias("period")).agg(F.count("*").alias("rows")), f"SELECT {BUCKET[_g].format('ts')} AS period, count(*) AS rows FROM events GROUP BY ALL")

# Formulas written out again as SQL over window sums.
FORMULA = {
    ("LTE_ERAB_ACC", 1): "100 * (rrc_succ / nullif(rrc_att, 0)) * (s1_succ / nullif(s1_att, 0)) * (erab_succ / nullif(erab_att, 0))",
    ("LTE_ERAB_RET", 1): "3600 * erab_rel / nullif(session_s, 0)", ("LTE_IP_THP_DL", 1): "1000 * (ip_vol_kbit / nullif(ip_time_ms, 0))",
    ("LTE_AVAIL", 1): "100 * (900 * unavail_n - unavail_s) / nullif(900 * unavail_n, 0)", ("LTE_MOB_HOSR", 1): "100 * ho_succ / nullif(ho_att, 0)",
    ("LTE_RRC_SSR", 1): "100 * rrc_succ / nullif(rrc_att, 0)", ("LTE_RRC_SSR", 2): "100 * (rrc_succ / nullif(rrc_att, 0)) * (s1_succ / nullif(s1_att, 0))",
    ("LTE_ERAB_DROP", 1): "100 * erab_rel / nullif(erab_succ, 0)", ("LTE_PRB_UTIL", 1): "prb_sum / nullif(prb_n, 0)", ("LTE_CQI_MEAN", 1): "cqi_weighted / nullif(cqi_samples, 0)",
    ("GSM_SAS", 1): "100 * (tch_succ / nullif(tch_req - tch_blocked, 0)) * (ia_succ / nullif(ia_att, 0))", ("GSM_ABN_REL", 1): "100 * (tch_lost + ho_unsucc) / nullif(tch_succ + ho_in, 0)",
    ("GSM_HOSR", 1): "100 * ho_succ / nullif(ho_att, 0)", ("GSM_CSSR", 1): "100 * (1 - sdcch_blocked / nullif(ia_att, 0)) * (tch_succ / nullif(tch_req, 0))",
    ("GSM_TCH_BLOCK", 1): "100 * tch_blocked / nullif(tch_req, 0)", ("GSM_SDCCH_BLOCK", 1): "100 * sdcch_blocked / nullif(ia_att, 0)", ("GSM_SDCCH_DROP", 1): "100 * sdcch_lost / nullif(ia_succ, 0)",
}
NEEDS = {"LTE_ERAB_RET": "session_s IS NOT NULL", "LTE_MOB_HOSR": "ho_att IS NOT NULL", "GSM_HOSR": "ho_att IS NOT NULL", "GSM_SDCCH_DROP": "sdcch_lost IS NOT NULL"}
_SUMS = sorted({*kpis.LTE_COUNTERS, *kpis.GSM_COUNTERS, "cqi_weighted", "cqi_samples"} - {"prb_pct"})


def sums_sql(granularity: str) -> str:
    return (f"agg AS MATERIALIZED (SELECT cell_name, {BUCKET[granularity].format('period_start')} AS period, min(vendor) AS vendor, " + ", ".join(f"sum({c}) AS {c}" for c in _SUMS)
            + ", sum(prb_pct) AS prb_sum, count(prb_pct) AS prb_n, count(unavail_s) AS unavail_n, count(*) FILTER (WHERE reported) AS periods_reported, count(*) FILTER (WHERE reported AND suspect) AS periods_suspect FROM wide GROUP BY 1, 2)")


def kpi_sql(keys, granularity: str, minutes: int = 15, digits: int = 9) -> str:
    n = EXPECTED[granularity] * 15 // minutes
    return " UNION ALL ".join(
        f"SELECT cell_name, period, vendor, '{k}' AS kpi_id, {ver} AS formula_version, round({FORMULA[k, ver]}, {5 if k == "LTE_IP_THP_DL" else digits}) AS value, {n} AS periods_expected, periods_reported, round(periods_reported / {n}.0, 9) AS coverage, round(periods_suspect / nullif(periods_reported, 0), 9) AS suspect_share FROM agg WHERE {NEEDS.get(k, 'true')}"
        for k, ver in keys)


def kpi_query(technology: str, granularity: str, only: str | None = None, versions=None, minutes: int = 15):
    def make(v: Views):
        table = kpis.kpi_table(v.wide(), technology, granularity, versions=versions, only=only, minutes=minutes, digits=9).drop("numerator", "denominator")
        # throughputs are large: as many digits as a double holds of them
        value = F.when(F.col("kpi_id") == "LTE_IP_THP_DL", F.round("value", 5)).otherwise(F.round("value", 9))
        return table.withColumn("value", value)

    return make


for _i, (_k, _v) in enumerate(FORMULA):
    _t = next(k.technology for k in kpis.CATALOG if k.kpi_id == _k)
    _g, _m = ("hour", 60) if _t == "LTE_CQI" else ("day", 15)
    register(f"d{10 + _i}_{_k.lower()}_v{_v}", kpi_query(_t, _g, _k, {_k: [_v]}, _m), with_views("wide", body=f", {sums_sql(_g)} {kpi_sql([(_k, _v)], _g, _m)}"))
for _t in ("LTE", "GSM"):
    for _g in BUCKET:
        register(f"d27_{_t.lower()}_kpi_{_g}", kpi_query(_t, _g), with_views("wide", body=f", {sums_sql(_g)} " + kpi_sql([(k, ver) for k, ver in FORMULA if k.startswith(_t) and ver == 1 and k != "LTE_CQI_MEAN"], _g)))
register("d28_wanted_versions", kpi_query("LTE", "week", "LTE_RRC_SSR", {"LTE_RRC_SSR": [1, 2]}), with_views("wide", body=f", {sums_sql('week')} " + kpi_sql([("LTE_RRC_SSR", 1), ("LTE_RRC_SSR", 2)], "week")))
register("d08_window_sums", lambda v: rounded(kpis.window_sums(v.wide(), "LTE", "week").select("cell_name", "period", "rrc_att", "prb_sum", "prb_n", "unavail_n", "periods_reported", "periods_suspect"), 4),
         with_views("wide", body=f", {sums_sql('week')} SELECT cell_name, period, round(rrc_att, 4) AS rrc_att, round(prb_sum, 4) AS prb_sum, prb_n, unavail_n, periods_reported, periods_suspect FROM agg"))
register("d29_kpi_catalog", lambda v: kpis.kpi_catalog(v.spark).join(kpis.kpi_table(v.wide(), "GSM", "week").groupBy("kpi_id", "formula_version").agg(F.count("*").alias("rows")), ["kpi_id", "formula_version"]).select("kpi_id", "formula_version", "better", "breach_threshold", "rows"),
         with_views("wide", body=f", {sums_sql('week')}, k AS ({kpi_sql([(k, ver) for k, ver in FORMULA if k.startswith('GSM')], 'week')}) SELECT kpi_id, formula_version, CASE WHEN kpi_id IN ('GSM_SAS', 'GSM_HOSR', 'GSM_CSSR') THEN 'higher' ELSE 'lower' END AS better, CASE WHEN kpi_id IN ('GSM_SAS', 'GSM_HOSR', 'GSM_CSSR') THEN 95.0::DOUBLE ELSE 2.0::DOUBLE END AS breach_threshold, count(*) AS rows FROM k GROUP BY ALL"))


def revised(v: Views):
    """All history of a revised formula beside the old one, by keyed upsert; rerun-safe."""
    from ..operators.quality import upsert

    keys = ["cell_name", "period", "kpi_id", "formula_version"]
    old = kpis.kpi_table(v.wide(), "LTE", "week", only="LTE_RRC_SSR")
    new = kpis.kpi_table(v.wide(), "LTE", "week", only="LTE_RRC_SSR", versions={"LTE_RRC_SSR": [2]})
    return upsert(upsert(old, new, keys), new, keys)


register("d30_apply_revision", lambda v: rounded(revised(v).groupBy("formula_version").agg(F.count("*").alias("rows"), F.avg("value").alias("mean")), 4),
         with_views("wide", body=f", {sums_sql('week')}, k AS ({kpi_sql([('LTE_RRC_SSR', 1), ('LTE_RRC_SSR', 2)], 'week')}) SELECT formula_version, count(*) AS rows, round(avg(value), 4) AS mean FROM k GROUP BY ALL"))


def _reprocessed(v: Views):
    from ..operators.quality import upsert

    wide = v.wide().filter((F.col("period_start") >= F.lit(_ts("1995-01-01"))) & (F.col("period_start") < F.lit(_ts("1996-01-01"))))
    part = kpis.kpi_table(wide, "LTE", "day", only="LTE_RRC_SSR", versions={"LTE_RRC_SSR": [2]})
    return upsert(part, part, ["cell_name", "period", "kpi_id", "formula_version"])


register("d31_reprocess_window", lambda v: rounded(_reprocessed(v).groupBy("period").agg(F.count("*").alias("cells"), F.avg("value").alias("mean")), 4),
         with_views("wide", body=f", {sums_sql('day').replace('FROM wide', 'FROM wide WHERE period_start >= TIMESTAMP %s AND period_start < TIMESTAMP %s' % (chr(39) + '1995-01-01' + chr(39), chr(39) + '1996-01-01' + chr(39)))}, k AS ({kpi_sql([('LTE_RRC_SSR', 2)], 'day')}) SELECT period, count(*) AS cells, round(avg(value), 4) AS mean FROM k GROUP BY ALL"))


def worst(v: Views, n: int = 1, floor: float = 0.0):
    return kpis.worst_cells_of_sums(kpis.window_sums(v.wide(), "GSM", "day"), kpis.wanted("GSM"), persistence_n=n, min_coverage=floor, digits=9)


_GSM = [(k, ver) for k, ver in FORMULA if k.startswith("GSM")]
WORST = (f"{sums_sql('day').replace('agg AS', 'aggd AS', 1)}, {sums_sql('week').replace('agg AS', 'aggw AS', 1)}, dk AS ({kpi_sql(_GSM, 'day', digits=9).replace('FROM agg', 'FROM aggd')}), wk AS ({kpi_sql(_GSM, 'week', digits=9).replace('FROM agg', 'FROM aggw')}), "
         "cat AS (SELECT unnest(['GSM_SAS', 'GSM_HOSR', 'GSM_CSSR', 'GSM_ABN_REL', 'GSM_TCH_BLOCK', 'GSM_SDCCH_BLOCK', 'GSM_SDCCH_DROP']) AS kpi_id, unnest([95.0, 95.0, 95.0, 2.0, 2.0, 2.0, 2.0])::DOUBLE AS lim, unnest([true, true, true, false, false, false, false]) AS up), "
         "cnt AS (SELECT date_trunc('week', d.period)::DATE AS week_start, kpi_id, cell_name, up, lim, count(*) AS days_judged, count(*) FILTER (WHERE CASE WHEN up THEN value < lim ELSE value > lim END) AS breach_days FROM dk d JOIN cat USING (kpi_id) WHERE value IS NOT NULL GROUP BY ALL), "
         "worst AS (SELECT c.week_start, c.kpi_id, c.cell_name, c.days_judged, c.breach_days, w.value AS week_value, row_number() OVER (PARTITION BY c.week_start, c.kpi_id ORDER BY breach_days DESC, CASE WHEN up THEN lim - w.value ELSE w.value - lim END DESC NULLS LAST, c.cell_name) AS rank FROM cnt c LEFT JOIN wk w ON w.cell_name = c.cell_name AND w.kpi_id = c.kpi_id AND w.period = c.week_start WHERE breach_days >= 1)")
register("d33_worst_cells_week", lambda v: worst(v).select("week_start", "kpi_id", "cell_name", "days_judged", "breach_days"), with_views("wide", body=f", {WORST} SELECT week_start, kpi_id, cell_name, days_judged, breach_days FROM worst"))
register("d39_worst_summary", lambda v: network.worst_summary(worst(v)), with_views("wide", body=f", {WORST}, w AS (SELECT week_start, count(*) AS n FROM worst GROUP BY 1) SELECT count(*) AS weeks, sum(n)::BIGINT AS cell_weeks, max(n) AS most_in_a_week FROM w"))
register("d34_network_day", lambda v: rounded(network.network_day(v.wide().join(F.broadcast(v.cells().select("cell_name", "n_rb")), "cell_name"), {"rrc": ("rrc_succ", "rrc_att"), "ho": ("ho_succ", "ho_att")}, "n_rb", "prb_pct"), 6),
         with_views("wide", "cells", body="SELECT (period_start + INTERVAL 7 HOUR)::DATE AS day, round(sum(rrc_succ) / nullif(sum(rrc_att), 0), 6) AS rrc, round(sum(ho_succ) / nullif(sum(ho_att), 0), 6) AS ho, round(sum(prb_pct * n_rb) / nullif(sum(n_rb), 0), 6) AS prb_pct_weighted FROM wide JOIN cells USING (cell_name) GROUP BY 1"))
MIX = "mix AS (SELECT CASE WHEN dayofweek((period_start + INTERVAL 7 HOUR)::DATE) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_kind, area, sum(ip_vol_kbit) AS volume, sum(ip_vol_kbit) / nullif(sum(ip_time_ms), 0) AS throughput, sum(prb_pct * n_rb) / nullif(sum(n_rb), 0) AS load FROM wide JOIN cells USING (cell_name) GROUP BY 1, 2), mixed AS (SELECT *, volume / sum(volume) OVER (PARTITION BY day_kind) AS share FROM mix)"
register("d35_traffic_mix", lambda v: rounded(network.traffic_mix(v.wide(), v.cells()), 4), with_views("wide", "cells", body=f", {MIX} SELECT day_kind, area, round(volume, 4) AS volume, round(throughput, 4) AS throughput, round(load, 4) AS load, round(share, 4) AS share FROM mixed"))
register("d36_mix_cells", lambda v: network.mix_cells(v.wide()), with_views("wide", body=", p AS (SELECT cell_name, avg(ip_vol_kbit) FILTER (WHERE dayofweek((period_start + INTERVAL 7 HOUR)::DATE) IN (0, 6)) AS we, avg(ip_vol_kbit) FILTER (WHERE dayofweek((period_start + INTERVAL 7 HOUR)::DATE) NOT IN (0, 6)) AS wd FROM wide GROUP BY 1) SELECT count(*) AS cells, count(*) FILTER (WHERE we > wd) AS busier_on_weekends, count(*) FILTER (WHERE we <= wd) AS not_busier FROM p"))
register("d37_network_throughput", lambda v: rounded(network.network_throughput(network.traffic_mix(v.wide(), v.cells())), 4), with_views("wide", "cells", body=f", {MIX} SELECT day_kind, round(sum(share) / sum(share / throughput), 4) AS throughput FROM mixed GROUP BY 1"))
register("d38_coverage_summary", lambda v: network.coverage_summary(kpis.kpi_table(v.wide(), "LTE", "day")), with_views("wide", body=f", {sums_sql('day')} SELECT count(*) AS cell_days, count(*) FILTER (WHERE periods_reported < 96) AS below_full, count(*) FILTER (WHERE periods_suspect > 0) AS with_suspect FROM agg"))


_REFERENCE = ["LTE_RRC_SSR", "LTE_ERAB_DROP", "LTE_PRB_UTIL"]


def reference_day(v: Views):
    """Daily KPIs worked out straight from the counters, not by the specs."""
    w = v.wide().withColumn("period", (F.col("period_start") + F.expr("interval 7 hours")).cast("date"))
    g = w.groupBy("cell_name", "period").agg(F.try_divide(F.sum("rrc_succ") * 100, F.sum("rrc_att")).alias("LTE_RRC_SSR"), F.try_divide(F.sum("erab_rel") * 100, F.sum("erab_succ")).alias("LTE_ERAB_DROP"), F.avg("prb_pct").alias("LTE_PRB_UTIL"))
    return g.unpivot(["cell_name", "period"], _REFERENCE, "kpi_id", "value").withColumn("formula_version", F.lit(1))


register("d40_compare", lambda v: network.compare(kpis.kpi_table(v.wide(), "LTE", "day", specs=[k for k in kpis.wanted("LTE") if k.kpi_id in _REFERENCE]), reference_day(v)).select("kpi_id", "compared", "agreeing", "missing"),
         with_views("wide", body=", n AS (SELECT count(*) AS n FROM (SELECT DISTINCT cell_name, (period_start + INTERVAL 7 HOUR)::DATE FROM wide)) SELECT unnest(['LTE_RRC_SSR', 'LTE_ERAB_DROP', 'LTE_PRB_UTIL']) AS kpi_id, n AS compared, n AS agreeing, 0::BIGINT AS missing FROM n"))
register("d41_reference_day", lambda v: rounded(reference_day(v).select("cell_name", "period", "kpi_id", "value")),
         with_views("wide", body=", g AS (SELECT cell_name, (period_start + INTERVAL 7 HOUR)::DATE AS period, 100 * sum(rrc_succ) / nullif(sum(rrc_att), 0) AS a, 100 * sum(erab_rel) / nullif(sum(erab_succ), 0) AS b, avg(prb_pct) AS c FROM wide GROUP BY 1, 2) SELECT cell_name, period, 'LTE_RRC_SSR' AS kpi_id, round(a, 6) AS value FROM g UNION ALL SELECT cell_name, period, 'LTE_ERAB_DROP', round(b, 6) FROM g UNION ALL SELECT cell_name, period, 'LTE_PRB_UTIL', round(c, 6) FROM g"))
register("d42_ratio_of_sums", lambda v: network.ratio_of_sums_check(kpis.kpi_table(v.wide(), "GSM", "day"), kpis.kpi_table(v.wide(), "GSM", "week"), F.date_trunc("week", "period").cast("date")).select("kpi_id", "compared", "equal"),
         with_views("wide", body=f", {sums_sql('week')}, k AS ({kpi_sql([(k, ver) for k, ver in _GSM if k not in ('GSM_SAS', 'GSM_CSSR')], 'week')}) SELECT kpi_id, count(*) AS compared, count(*) AS equal FROM k GROUP BY 1"))
register("d43_version_diff", lambda v: network.version_diff(kpis.kpi_table(v.wide(), "LTE", "day", versions={"LTE_RRC_SSR": [1, 2]}), "LTE_RRC_SSR"),
         with_views("wide", body=f", {sums_sql('day')} SELECT count(*) AS pairs, 0::BIGINT AS new_above_old, count(*) FILTER (WHERE rrc_succ > 0) AS new_below_old FROM agg"))


def _touched_week(v: Views):
    from datetime import date

    from ..functions.clock import window_of

    w = window_of(date(1996, 3, 3), date(1996, 3, 4))
    rows = v.wide().filter((F.col("period_start") >= F.lit(w["week_lo"])) & (F.col("period_start") < F.lit(w["week_hi"])))
    return rows.groupBy(bucket(F.col("period_start"), "week").alias("week")).agg(F.count("*").alias("rows"))


register("d07_touched_weeks", _touched_week, with_views("wide", body="SELECT date_trunc('week', (period_start + INTERVAL 7 HOUR)::DATE)::DATE AS week, count(*) AS rows FROM wide WHERE period_start >= TIMESTAMP '1996-02-25 17:00:00' AND period_start < TIMESTAMP '1996-03-10 17:00:00' GROUP BY 1"))
register("d09_kpi_parts", lambda v: rounded(kpis.kpi_table(v.wide(), "GSM", "day", only="GSM_TCH_BLOCK").select("cell_name", "period", "numerator", "denominator", "periods_expected"), 4), with_views("wide", body=f", {sums_sql('day')} SELECT cell_name, period, round(tch_blocked, 4) AS numerator, round(tch_req, 4) AS denominator, 96 AS periods_expected FROM agg"))


def _window_upsert(v: Views):
    from ..operators.quality import upsert

    day = F.col("period")
    old = kpis.kpi_table(v.wide(), "GSM", "day", only="GSM_HOSR").withColumn("value", F.lit(-1.0))
    new = kpis.kpi_table(v.wide(), "GSM", "day", only="GSM_HOSR").filter(day.between("1996-01-01", "1996-03-31"))
    return upsert(old, new, ["cell_name", "period", "kpi_id", "formula_version"], day.between("1996-01-01", "1996-03-31"))


register("d32_kpi_upsert_window", lambda v: rounded(_window_upsert(v).select("cell_name", "period", "value"), 4), with_views("wide", body=f", {sums_sql('day')} SELECT cell_name, period, CASE WHEN period BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' THEN round(100 * ho_succ / nullif(ho_att, 0), 4) ELSE -1.0 END AS value FROM agg WHERE ho_att IS NOT NULL"))
register("d44_periods_expected", lambda v: kpis.kpi_table(v.wide(), "LTE_CQI", "week", minutes=60).groupBy("periods_expected").agg(F.count("*").alias("rows")), with_views("wide", body=f", {sums_sql('week')} SELECT 168 AS periods_expected, count(*) AS rows FROM agg"))
register("d45_accessibility_day", lambda v: rounded(kpis.kpi_table(v.wide(), "LTE", "day", only="LTE_RRC_SSR", versions={"LTE_RRC_SSR": [1, 2]}).groupBy("period", "formula_version").agg(F.count("*").alias("cells"), F.min("value").alias("least")), 6), with_views("wide", body=f", {sums_sql('day')}, k AS ({kpi_sql([('LTE_RRC_SSR', 1), ('LTE_RRC_SSR', 2)], 'day', digits=9)}) SELECT period, formula_version, count(*) AS cells, round(min(value), 6) AS least FROM k GROUP BY 1, 2"))
