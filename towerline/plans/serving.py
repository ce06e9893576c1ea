"""Queries of lookups, as-of reads, lineage and time travel."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import names
from ..functions.clock import to_utc
from ..operators import kpis, quality, serving, space
from .gold import SILVER, mapped, silver, sums_sql, worst, WORST
from .quality import GAPS, STAGED, gaps, states
from .registry import register, rounded
from .views import Views, place_sql, with_views

AT = datetime(1996, 6, 1)
AT_SQL = "TIMESTAMP '1996-06-01'"

register("b06_cell_of_relation", lambda v: v.table("nation").select("n_nationkey", names.cell_name_of(F.concat(F.lit("EMS/e1/c"), F.col("n_nationkey").cast("string"), F.lit("/EutranRelation-"), F.col("n_name"))).alias("cell")), "SELECT n_nationkey, 'EMS/e1/c' || n_nationkey AS cell FROM nation")
register("b07_dn_under", lambda v: v.table("customer").select(F.concat(F.lit("a"), (F.col("c_custkey") % 100).cast("string"), F.lit("/"), F.col("c_name")).alias("dn")).filter(names.dn_under(F.col("dn"), F.lit("a7"))), "SELECT dn FROM (SELECT 'a' || (c_custkey % 100) || '/' || c_name AS dn FROM customer) WHERE dn = 'a7' OR dn LIKE 'a7,%' OR dn LIKE 'a7/%'")
register("b08_managed_element", lambda v: v.table("customer").select("c_custkey", F.concat(F.lit("net/"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name")).alias("dn")).select("c_custkey", names.managed_element(F.col("dn")).alias("element"), names.relative_name(F.col("dn"), F.concat(F.lit("net/"), F.split_part("dn", F.lit("/"), F.lit(2)))).alias("relative")), "SELECT c_custkey, 'net/' || c_mktsegment AS element, c_name AS relative FROM customer")
register("b09_resource_blocks", lambda v: v.table("part").select("p_partkey", names.n_rb(F.element_at(F.array(*map(F.lit, (1.4, 3.0, 5.0, 10.0, 15.0, 20.0, 7.0))), (F.col("p_size") % 7 + 1).cast("int"))).alias("n_rb")), "SELECT p_partkey, [6, 15, 25, 50, 75, 100, NULL][p_size % 7 + 1]::INT AS n_rb FROM part")
register("b12_to_utc", lambda v: v.table("orders").select("o_orderkey", to_utc(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:15:00+07:00:00"))).cast("timestamp_ntz").alias("t")), "SELECT o_orderkey, o_orderdate::DATE + INTERVAL 15 MINUTE - INTERVAL 7 HOUR AS t FROM orders")
register("b13_sites_and_relations", lambda v: v.table("orders").select("o_orderkey", names.site_of(F.concat(F.col("o_orderpriority"), F.lit("_x"))).alias("site"), names.relation_source(F.concat(F.col("o_orderstatus"), F.lit("->"), F.col("o_orderpriority"))).alias("source"), names.relation_target(F.concat(F.col("o_orderstatus"), F.lit("->"), F.col("o_orderpriority"))).alias("target")), "SELECT o_orderkey, o_orderpriority AS site, o_orderstatus AS source, o_orderpriority AS target FROM orders")
_LATEST = "latest AS (SELECT * FROM cm QUALIFY row_number() OVER (PARTITION BY ems, dn ORDER BY time DESC, id DESC) = 1)"
register("d01_cells", lambda v: serving.cells_latest(v.cm(), AT), with_views("cm", body=f", c AS (SELECT * FROM cm WHERE time <= {AT_SQL}) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY ems, dn ORDER BY time DESC, id DESC) = 1"))
register("e01_cells_view", lambda v: serving.cells_latest(v.cm()), with_views("cm", body=f", {_LATEST} SELECT * FROM latest"))
register("e02_filter_cells", lambda v: serving.filter_cells(v.cells(), technology="LTE", area="urban", site=None), with_views("cells", body="SELECT * FROM cells WHERE technology = 'LTE' AND area = 'urban'"))


def _edges(v: Views):
    c = v.cm()
    return c.withColumn("time", F.date_trunc("year", "time")).withColumn("label", F.concat("dn", F.lit("->"), "status"))


register("e03_relations", lambda v: serving.relations(_edges(v)), with_views("cm", body="SELECT DISTINCT dn AS source, status AS target FROM cm JOIN (SELECT ems, max(date_trunc('year', time)) AS m FROM cm GROUP BY ems) USING (ems) WHERE date_trunc('year', time) = m"))
register("e04_topology", lambda v: serving.topology(v.cells()).select("site", F.array_join("cells", ",").alias("cells"), "n"), with_views("cells", body="SELECT site, string_agg(cell_name, ',' ORDER BY cell_name) AS cells, count(*) AS n FROM cells GROUP BY site"))
register("e05_kpi_series", lambda v: rounded(serving.kpi_series(kpis.kpi_table(v.wide(), "LTE", "hour", only="LTE_RRC_SSR"), "s1", "LTE_RRC_SSR", 1, datetime(1996, 3, 1), datetime(1996, 4, 1)).select("period", "value"), 4), with_views("wide", body=f", {sums_sql('hour')} SELECT period, round(100 * rrc_succ / nullif(rrc_att, 0), 4) AS value FROM agg WHERE cell_name = 's1' AND period >= TIMESTAMP '1996-03-01' AND period < TIMESTAMP '1996-04-01'"))
register("e06_worst_list", lambda v: serving.worst_list(worst(v), date(1996, 3, 4), "GSM_TCH_BLOCK").select("cell_name", "days_judged", "breach_days"), with_views("wide", body=f", {WORST} SELECT cell_name, days_judged, breach_days FROM worst WHERE week_start = DATE '1996-03-04' AND kpi_id = 'GSM_TCH_BLOCK'"))
register("e07_snapshot_as_of", lambda v: serving.snapshot_as_of(v.cm(), ["dn"], "time", AT).select("dn", "time", "id", "status"), with_views("cm", body=f"SELECT dn, time, id, status FROM cm WHERE time <= {AT_SQL} QUALIFY row_number() OVER (PARTITION BY dn ORDER BY time DESC, ems DESC, id DESC) = 1"))
register("e07_as_of_join", lambda v: serving.as_of_join(v.table("lineitem").select((F.col("l_suppkey") % 50).alias("k"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("at")), v.table("orders").groupBy((F.col("o_custkey") % 50).alias("k"), F.col("o_orderdate").alias("t")).agg(F.max("o_totalprice").alias("price")), ["k"], "at", "t").select("l_orderkey", "l_linenumber", "t", "price"),
         "WITH l AS (SELECT l_suppkey % 50 AS k, l_orderkey, l_linenumber, l_shipdate AS at FROM lineitem), r AS (SELECT o_custkey % 50 AS k, o_orderdate AS t, max(o_totalprice) AS price FROM orders GROUP BY 1, 2) SELECT l_orderkey, l_linenumber, t, price FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.at >= r.t")


def _tree(v: Views):
    """Configuration records of cells and of relations below them, under both separators:
    a number may begin another one (net/c1, net/c12), so names are told apart by level."""
    o, c = v.table("orders"), F.col("o_custkey") % 150
    below = F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("/EutranRelation-"), (F.col("o_orderkey") % 4).cast("string"))).when(F.col("o_orderkey") % 3 == 2, F.concat(F.lit(",Sector="), (F.col("o_orderkey") % 5).cast("string"))).otherwise("")
    return o.select(F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.concat(F.lit("net/c"), c.cast("string"), below).alias("dn"), F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("time"), F.col("o_orderstatus").alias("attribute"), F.col("o_orderpriority").alias("value"))


def _tree_cells(v: Views):
    k = F.col("c_custkey")
    return v.table("customer").select(F.concat(F.lit("ems"), (k % 2).cast("string")).alias("ems"), F.concat(F.lit("net/c"), (k % 150).cast("string")).alias("dn"), F.concat(F.lit("cell_"), (k % 150).cast("string")).alias("cell_name")).distinct()


_TREE = """tree AS (SELECT 'ems' || (o_custkey % 2) AS ems, 'net/c' || (o_custkey % 150) || CASE o_orderkey % 3 WHEN 1 THEN '/EutranRelation-' || (o_orderkey % 4) WHEN 2 THEN ',Sector=' || (o_orderkey % 5) ELSE '' END AS dn,
 date_trunc('month', o_orderdate)::TIMESTAMP AS time, o_orderstatus AS attribute, o_orderpriority AS value FROM orders),
tc AS (SELECT DISTINCT 'ems' || (c_custkey % 2) AS ems, 'net/c' || (c_custkey % 150) AS cdn, 'cell_' || (c_custkey % 150) AS cell_name FROM customer),
found AS (SELECT tree.*, cell_name FROM tree JOIN tc ON tree.ems = tc.ems AND (dn = cdn OR starts_with(dn, cdn || ',') OR starts_with(dn, cdn || '/')))"""
register("b07_under_join", lambda v: serving.under(_tree(v), _tree_cells(v)).groupBy("cell_name").agg(F.count("*").alias("records"), F.count_distinct("dn").alias("names")), f"WITH {_TREE} SELECT cell_name, count(*) AS records, count(DISTINCT dn) AS names FROM found GROUP BY 1")
register("e07_cell_snapshot", lambda v: serving.cell_snapshot(_tree(v), _tree_cells(v), AT), f"WITH {_TREE}, l AS (SELECT cell_name, max(time) AS time FROM found WHERE time <= {AT_SQL} GROUP BY 1) SELECT DISTINCT found.* FROM found JOIN l USING (cell_name, time)")
register("e07_snapshot_of_cell", lambda v: serving.cell_snapshot(_tree(v), _tree_cells(v), AT, "cell_7"), f"WITH {_TREE}, l AS (SELECT max(time) AS time FROM found WHERE time <= {AT_SQL} AND cell_name = 'cell_7') SELECT DISTINCT found.* FROM found JOIN l USING (time) WHERE cell_name = 'cell_7'")
register("e08_cm_changes", lambda v: serving.cm_changes(_tree(v), _tree_cells(v), datetime(1996, 1, 1), datetime(1996, 6, 1)), f"WITH {_TREE} SELECT DISTINCT * FROM found WHERE time >= TIMESTAMP '1996-01-01' AND time < TIMESTAMP '1996-06-01'")


def _alarms(v: Views):
    from pyspark.sql import Window

    e = v.table("events")
    nxt = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.withColumn("cleared", nxt).filter("event_type = 'error'").select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("dn"), F.col("ts").alias("raised"), "cleared", F.col("event_id").alias("alarm"))


_FM = "fm AS (SELECT 's' || user_id AS dn, ts AS raised, cleared, event_id AS alarm FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cleared FROM events) WHERE event_type = 'error')"
register("e09_alarms", lambda v: serving.alarms(_alarms(v), v.cells().select(F.col("cell_name").alias("dn"), "cell_name"), datetime(2024, 1, 3), datetime(2024, 1, 9)), with_views("cells", body=f", {_FM} SELECT DISTINCT fm.*, c.cell_name FROM fm LEFT JOIN cells c ON c.cell_name = fm.dn WHERE raised >= TIMESTAMP '2024-01-03' AND raised < TIMESTAMP '2024-01-09'"))
register("e10_alarm_notifications", lambda v: serving.alarm_notifications(_alarms(v)), f"WITH {_FM} SELECT raised::DATE AS day, 'new' AS kind, count(*) AS n FROM fm GROUP BY 1 UNION ALL SELECT cleared::DATE, 'cleared', count(*) FROM fm WHERE cleared IS NOT NULL GROUP BY 1")


def _changes(v: Views):
    o = v.table("orders")
    return o.select(F.concat(F.lit("dn"), F.col("o_custkey").cast("string")).alias("dn"), F.col("o_orderstatus").alias("attribute"), F.col("o_orderpriority").alias("value"), F.col("o_orderdate").alias("start"), F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderdate") + F.expr("interval 90 days")).alias("end"))


_CH = "ch AS (SELECT 'dn' || o_custkey AS dn, o_orderstatus AS attribute, o_orderpriority AS value, o_orderdate AS start, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL 90 DAY END AS stop FROM orders)"
register("e11_config_at", lambda v: serving.config_at(v.table("customer").select(F.concat(F.lit("dn"), F.col("c_custkey").cast("string")).alias("dn"), F.lit("F").alias("attribute"), F.col("c_mktsegment").alias("value")), _changes(v), AT),
         f"WITH {_CH}, a AS (SELECT dn, attribute, max({{'s': start, 'v': value}}).v AS changed FROM ch WHERE start <= {AT_SQL} AND (stop IS NULL OR stop > {AT_SQL}) GROUP BY 1, 2) SELECT b.dn, b.attribute, coalesce(changed, b.value) AS value, changed IS NOT NULL AS is_changed FROM (SELECT 'dn' || c_custkey AS dn, 'F' AS attribute, c_mktsegment AS value FROM customer) b LEFT JOIN a USING (dn, attribute)")
register("e11_change_log", lambda v: serving.change_log(_changes(v)).groupBy("entry", F.year("time").alias("year")).agg(F.count("*").alias("n")), f"WITH {_CH} SELECT 'made' AS entry, year(start)::INT AS year, count(*) AS n FROM ch GROUP BY ALL UNION ALL SELECT 'restored', year(stop)::INT, count(*) FROM ch WHERE stop IS NOT NULL GROUP BY ALL")


def _lineage(v: Views):
    window = (F.col("period_start") >= F.lit(datetime(2024, 1, 10))) & (F.col("period_start") < F.lit(datetime(2024, 1, 12)))
    b = v.bronze().withColumn("file_hash", F.lit("h"))
    s = mapped(v).groupBy("ems", "cell_name", "period_start", "measurement", "file_name").agg(F.sum("value").alias("value"), F.array_join(F.array_sort(F.collect_set("counter")), " / ").alias("vendor_counter")).withColumn("file_hash", F.lit("h"))
    led = b.groupBy("ems", "file_name", "file_hash").agg(F.max("ts").alias("arrival_time")).withColumn("loaded", F.lit(True))
    return serving.lineage(s, kpis.kpi_inputs(v.spark), b, led, "LTE_RRC_SSR", 1, window)


_LIN = """lin AS (SELECT b.ems, b.cell_name, b.period_start, m.measurement, b.counter, b.file_name, b.value AS raw_value FROM bronze b JOIN cmap m USING (release, counter)
 WHERE m.measurement IN ('RRC.ConnEstabAtt.sum', 'RRC.ConnEstabSucc.sum') AND period_start >= TIMESTAMP '2024-01-10' AND period_start < TIMESTAMP '2024-01-12')"""
register("e12_lineage", lambda v: rounded(_lineage(v).select("ems", "cell_name", "period_start", "measurement", "counter", "file_name", "raw_value")), with_views("bronze", "cmap", body=f", {_LIN} SELECT * REPLACE (round(raw_value, 6) AS raw_value) FROM lin"))
register("e13_kpi_inputs", lambda v: kpis.kpi_inputs(v.spark).filter("kpi_id = 'LTE_RRC_SSR'").join(silver(v).groupBy("measurement").agg(F.count("*").alias("rows")), "measurement").select("formula_version", "measurement", "rows"), with_views("bronze", "cmap", body=f", {SILVER}, r AS (SELECT measurement, count(*) AS rows FROM silver WHERE measurement IN ('RRC.ConnEstabAtt.sum', 'RRC.ConnEstabSucc.sum') GROUP BY 1) SELECT formula_version::INT AS formula_version, measurement, rows FROM r, (SELECT unnest([1, 2]) AS formula_version)"))
register("e14_lineage_summary", lambda v: serving.lineage_summary(_lineage(v)), with_views("bronze", "cmap", body=f", {_LIN} SELECT count(DISTINCT (cell_name, period_start, measurement)) AS silver_rows, count(raw_value) AS bronze_rows, count(DISTINCT file_name) AS files, count(DISTINCT counter) AS counters FROM lin"))
_H = "h AS (SELECT o_custkey AS k, o_orderdate AS committed, max(o_totalprice) AS value FROM orders GROUP BY 1, 2)"
history = lambda v: v.table("orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("committed")).agg(F.max("o_totalprice").alias("value"))
register("e15_history_as_of", lambda v: serving.history_as_of(history(v), ["k"], "committed", AT), f"WITH {_H} SELECT * FROM h WHERE committed <= {AT_SQL} QUALIFY row_number() OVER (PARTITION BY k ORDER BY committed DESC) = 1")
register("e15_before_after", lambda v: serving.before_after(history(v), ["k"], "committed", AT, datetime(1997, 6, 1)), f"WITH {_H}, a AS (SELECT k, arg_max(value, committed) AS before FROM h WHERE committed <= {AT_SQL} GROUP BY k), b AS (SELECT k, arg_max(value, committed) AS after FROM h WHERE committed <= TIMESTAMP '1997-06-01' GROUP BY k) SELECT k, before, after FROM a FULL JOIN b USING (k) WHERE before IS DISTINCT FROM after")
register("e16_lake_clock", lambda v: serving.lake_clock(v.deliveries(), v.bronze(), v.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))), with_views("deliveries", "bronze", body="SELECT (SELECT max(arrival_time) FROM deliveries) AS newest_arrival, (SELECT max(period_start) FROM bronze) AS silver_end, (SELECT max(o_orderdate)::DATE FROM orders) AS gold_day"))
register("e17_file_status", lambda v: serving.file_status(v.deliveries().withColumn("kind", F.lit("PM"))), with_views("deliveries", body=", n AS (SELECT max(arrival_time) AS n FROM deliveries) SELECT ems, 'PM' AS kind, count(*) AS files, count(*) FILTER (WHERE arrival_time > n - INTERVAL 1 DAY) AS last_day, count(*) FILTER (WHERE NOT loaded) AS not_loaded, max(arrival_time) AS latest FROM deliveries, n GROUP BY ems"))
register("e18_layer_counts", lambda v: serving.layer_counts({"bronze": v.bronze(), "deliveries": v.deliveries(), "files": states(v)}), with_views("bronze", "deliveries", "states", body="SELECT 'bronze' AS layer, count(*) AS rows FROM bronze UNION ALL SELECT 'deliveries', count(*) FROM deliveries UNION ALL SELECT 'files', count(*) FROM states"))
register("e18_latest_events", lambda v: quality.quality_events(gaps(v), states(v), datetime(1990, 1, 1), datetime(2030, 1, 1)).orderBy(F.desc("period_start"), "kind", "ems", "detail").limit(20).select("kind", "ems", "period_start"),
         with_views("bronze", "deliveries", "states", body=f", {STAGED}, {GAPS}, later AS (SELECT ems, period_start, min(min(first_arrival)) OVER (PARTITION BY ems ORDER BY period_start ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM states GROUP BY ems, period_start), m AS (SELECT s.*, coalesce(first_arrival > nxt, false) AS late FROM states s JOIN later USING (ems, period_start)), e AS (SELECT 'late_file' AS kind, ems, period_start, file_name || ' a' AS detail FROM m WHERE late UNION ALL SELECT CASE WHEN versions > 1 THEN 'changed_redelivery' ELSE 'duplicate_delivery' END, ems, period_start, file_name || ' d' FROM m WHERE deliveries > 1 UNION ALL SELECT 'missing_period', ems, period_start, 'no values of ' || managed_element FROM gaps) SELECT kind, ems, period_start FROM e ORDER BY period_start DESC, kind, ems, detail LIMIT 20"))
register("e19_planning_table", lambda v: v.place("part", "p_partkey", "village").select("village", "x", "y").orderBy("village"), f"SELECT village, x::DOUBLE AS x, y::DOUBLE AS y FROM {place_sql('part', 'p_partkey', 'village')}")
register("e20_range_read", lambda v: rounded(serving.kpi_series(kpis.kpi_table(v.wide(), "GSM", "hour", only="GSM_HOSR"), "s2", "GSM_HOSR", 1, datetime(1996, 3, 1), datetime(1996, 4, 1), cap=5000).select("period", "value"), 4), with_views("wide", body=f", {sums_sql('hour')} SELECT period, round(100 * ho_succ / nullif(ho_att, 0), 4) AS value FROM agg WHERE cell_name = 's2' AND ho_att IS NOT NULL AND period >= TIMESTAMP '1996-03-01' AND period < TIMESTAMP '1996-04-01'"))
register("e21_first_rich_window", lambda v: serving.first_rich_window(v.table("events"), "ts", "event_type").select("window_start", "event_type", "first"), "WITH r AS (SELECT *, unnest([date_trunc('week', ts)::DATE, date_trunc('week', ts)::DATE - 7]) AS window_start FROM events), f AS (SELECT window_start FROM r GROUP BY 1 HAVING count(DISTINCT event_type) >= 3 ORDER BY 1 LIMIT 1) SELECT window_start, event_type, min(ts) AS first FROM r JOIN f USING (window_start) GROUP BY 1, 2")
register("e22_k_nearest", lambda v: rounded(space.k_nearest(v.place("customer", "c_custkey", "id").select("id", "x", "y"), v.place("supplier", "s_suppkey", "seed").filter("seed < 5").select("seed", "x", "y"), 5), 4), f"WITH p AS {place_sql('customer', 'c_custkey', 'id')}, s AS (SELECT * FROM {place_sql('supplier', 's_suppkey', 'seed')} WHERE seed < 5), d AS (SELECT seed, id, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS km FROM p, s), r AS (SELECT seed, id, (row_number() OVER (PARTITION BY seed ORDER BY round(km, 9), id))::INT AS rank, round(km, 4) AS km FROM d) SELECT * FROM r WHERE rank <= 5")
register("e23_sample_edges", lambda v: serving.sample_edges(v.table("lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target")), v.table("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("node"))).distinct(), "SELECT DISTINCT l_suppkey AS source, l_partkey AS target FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND l_partkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
