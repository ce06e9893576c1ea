"""Queries of the delivery, version, gap and load operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import quality as q
from .registry import register, rounded
from .views import Views, with_views

_D = ("deliveries", "states")
LATE = """later AS (SELECT ems, period_start, min(min(first_arrival)) OVER (PARTITION BY ems ORDER BY period_start ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM states GROUP BY ems, period_start),
marked AS (SELECT s.*, coalesce(first_arrival > nxt, false) AS late FROM states s JOIN later USING (ems, period_start))"""
CUT = datetime(1997, 6, 1)


def states(v: Views):
    return q.mark_late(q.file_states(v.deliveries()))


def ledger(v: Views):
    return v.deliveries().filter("l_linenumber <= 2")


register("c01_new_files", lambda v: q.new_files(v.deliveries(), ledger(v)).groupBy("ems").agg(F.count("*").alias("files")),
         with_views("deliveries", body="SELECT ems, count(*) AS files FROM (SELECT DISTINCT ems, file_name, file_hash FROM deliveries WHERE (ems, file_name, file_hash) NOT IN (SELECT ems, file_name, file_hash FROM deliveries WHERE l_linenumber <= 2 AND loaded)) GROUP BY ems"))
register("c02_file_states", lambda v: q.file_states(v.deliveries()), with_views(*_D, body="SELECT * FROM states"))
register("c02_file_states_cutoff", lambda v: q.file_states(v.deliveries(), CUT).select("ems", "file_name", "deliveries", "versions"),
         with_views("deliveries", body=f"SELECT ems, file_name, count(*) AS deliveries, count(DISTINCT file_hash) FILTER (WHERE loaded) AS versions FROM deliveries WHERE arrival_time <= TIMESTAMP '{CUT}' GROUP BY ALL"))
register("c03_mark_late", lambda v: states(v).select("ems", "file_name", "late"), with_views(*_D, body=f", {LATE} SELECT ems, file_name, late FROM marked"))
register("c04_latest_version", lambda v: q.latest_version(v.values(), states(v)).select("ems", "file_name", "file_hash", "k", "value"),
         with_views(*_D, "vals", body="SELECT v.ems, v.file_name, v.file_hash, k, value FROM vals v JOIN states s ON s.ems = v.ems AND s.file_name = v.file_name AND s.latest_hash = v.file_hash"))
CONFLICT = """conflict AS (SELECT DISTINCT n.ems, n.file_name, n.k FROM vals n JOIN states s ON s.ems = n.ems AND s.file_name = n.file_name AND s.latest_hash = n.file_hash AND s.versions > 1
 JOIN vals o ON o.ems = n.ems AND o.file_name = n.file_name AND o.k = n.k AND o.file_hash <> n.file_hash WHERE n.value IS DISTINCT FROM o.value)"""
register("c05_conflicts", lambda v: q.conflicts(v.values(), states(v), ["k"]), with_views(*_D, "vals", body=f", {CONFLICT} SELECT * FROM conflict"))
register("c05_with_conflict", lambda v: q.latest_with_conflict(v.values(), states(v), ["k"]).groupBy("ems", "conflict").agg(F.count("*").alias("rows")),
         with_views(*_D, "vals", body=f", {CONFLICT} SELECT v.ems, c.k IS NOT NULL AS conflict, count(*) AS rows FROM vals v JOIN states s ON s.ems = v.ems AND s.file_name = v.file_name AND s.latest_hash = v.file_hash LEFT JOIN conflict c ON c.ems = v.ems AND c.file_name = v.file_name AND c.k = v.k GROUP BY ALL"))
register("c06_unrecorded", lambda v: q.unrecorded(v.values(), ledger(v)), with_views("deliveries", "vals", body="SELECT DISTINCT ems, file_name, file_hash FROM vals WHERE (ems, file_name, file_hash) NOT IN (SELECT ems, file_name, file_hash FROM deliveries WHERE l_linenumber <= 2)"))


def staged(v: Views):
    """Values with flags, of 15 and 60 minute periods."""
    b = v.bronze()
    return b.select(
        "ems", F.col("cell_name").alias("managed_element"), F.date_trunc("hour", "period_start").alias("period_start"), F.col("counter").alias("measurement"),
        F.when(F.col("row_id") % 97 == 0, -F.col("value")).when(F.col("row_id") % 89 == 0, None).otherwise(F.col("value")).alias("value"), F.when(F.col("row_id") % 101 == 0, 30).otherwise(60).alias("granularity_min"),
        "suspect", (F.col("row_id") % 7 == 0).alias("derived"), (F.col("row_id") % 11 == 0).alias("late"), (F.col("row_id") % 13 == 0).alias("conflict"), "release",
    )


STAGED = """staged AS (SELECT ems, cell_name AS managed_element, date_trunc('hour', period_start)::TIMESTAMP AS period_start, counter AS measurement,
 CASE WHEN row_id % 97 = 0 THEN -value WHEN row_id % 89 = 0 THEN NULL ELSE value END AS value, CASE WHEN row_id % 101 = 0 THEN 30 ELSE 60 END AS granularity_min, suspect,
 row_id % 7 = 0 AS derived, row_id % 11 = 0 AS late, row_id % 13 = 0 AS conflict, release FROM bronze)"""
GAPS = """there AS (SELECT DISTINCT ems, managed_element, period_start FROM staged WHERE granularity_min = 60 AND period_start >= TIMESTAMP '2024-01-05' AND period_start < TIMESTAMP '2024-01-12 10:00:00'),
seen AS (SELECT DISTINCT ems, managed_element, date_trunc('day', period_start)::TIMESTAMP AS day FROM there),
grid AS (SELECT ems, managed_element, unnest(generate_series(day, day + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS period_start FROM seen),
gaps AS (SELECT g.* FROM grid g LEFT JOIN there t USING (ems, managed_element, period_start) WHERE t.ems IS NULL AND period_start < TIMESTAMP '2024-01-12 10:00:00')"""
LO, HI = datetime(2024, 1, 5), datetime(2024, 1, 12, 10)


def gaps(v: Views):
    return q.detect_gaps(staged(v), LO, HI, 60)


register("c07_check_load", lambda v: q.check_load(staged(v), ["ems", "managed_element", "measurement", "period_start", "granularity_min"]),
         with_views("bronze", body=f", {STAGED} SELECT 'duplicate_key' AS rule, coalesce(sum(n - 1), 0)::BIGINT AS rows FROM (SELECT count(*) AS n FROM staged GROUP BY ems, managed_element, measurement, period_start, granularity_min) UNION ALL SELECT 'negative_value', count(*) FILTER (WHERE value < 0) FROM staged UNION ALL SELECT 'share_outside_0_100', 0 UNION ALL SELECT 'granularity', count(*) FILTER (WHERE granularity_min NOT IN (15, 60)) FROM staged"))
register("c08_detect_gaps", lambda v: gaps(v), with_views("bronze", body=f", {STAGED}, {GAPS} SELECT ems, managed_element, period_start FROM gaps"))
register("c09_suspect_carry", lambda v: staged(v).groupBy("managed_element", F.col("period_start").cast("date").alias("day")).agg(F.bool_or("suspect").alias("suspect")),
         with_views("bronze", body=f", {STAGED} SELECT managed_element, period_start::DATE AS day, bool_or(suspect) AS suspect FROM staged GROUP BY ALL"))


def _orders(v: Views, cond: str, bump: int):
    return v.table("orders").filter(cond).select(F.col("o_custkey").alias("cust"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") + bump).alias("value")).groupBy("cust", "day").agg(F.max("value").alias("value"))


_UP = "t AS (SELECT o_custkey AS cust, o_orderdate::DATE AS day, max(o_totalprice) AS value FROM orders GROUP BY 1, 2), s AS (SELECT o_custkey AS cust, o_orderdate::DATE AS day, max(o_totalprice + 1000) AS value FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2)"
register("c10_upsert", lambda v: rounded(q.upsert(_orders(v, "true", 0), _orders(v, "o_orderstatus = 'P'", 1000), ["cust", "day"]), 2),
         f"WITH {_UP} SELECT cust, day, round(value, 2) AS value FROM s UNION ALL SELECT cust, day, round(value, 2) FROM t WHERE (cust, day) NOT IN (SELECT cust, day FROM s)")
register("c10_upsert_window", lambda v: rounded(q.upsert(_orders(v, "true", 0), _orders(v, "o_orderstatus = 'P' and o_orderdate >= timestamp'1997-01-01'", 1000), ["cust", "day"], F.col("day") >= F.lit("1997-01-01").cast("date")), 2),
         f"WITH {_UP} SELECT cust, day, round(value, 2) AS value FROM s WHERE day >= DATE '1997-01-01' UNION ALL SELECT cust, day, round(value, 2) FROM t WHERE day < DATE '1997-01-01'")
register("c11_merge_window", lambda v: q.merge_window(v.bronze().select("period_start").distinct()), with_views("bronze", body="SELECT DISTINCT period_start, period_start + INTERVAL 15 MINUTE AS window_end, CASE WHEN minute(period_start + INTERVAL 15 MINUTE) = 0 THEN period_start - INTERVAL 45 MINUTE ELSE period_start END AS window_start FROM bronze"))
register("c12_catch_up", lambda v: q.catch_up(q.file_states(v.deliveries()), v.table("orders").filter("o_orderstatus = 'F'").select(F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.col("o_orderdate").cast("date").alias("day")), datetime(1996, 1, 1), datetime(1997, 1, 1)).select("ems", "file_name"),
         with_views(*_D, body="SELECT ems, file_name FROM states WHERE first_arrival > TIMESTAMP '1996-01-01' AND first_arrival <= TIMESTAMP '1997-01-01' AND (ems, period_start::DATE) IN (SELECT 'ems' || (o_custkey % 2), o_orderdate::DATE FROM orders WHERE o_orderstatus = 'F')"))
register("c13_repair_gaps", lambda v: q.repair_gaps(gaps(v), staged(v).filter("not late"), datetime(2024, 1, 8), datetime(2024, 1, 9), 60),
         with_views("bronze", body=f", {STAGED}, {GAPS}, t2 AS (SELECT DISTINCT ems, managed_element, period_start FROM staged WHERE NOT late AND granularity_min = 60 AND period_start >= TIMESTAMP '2024-01-08' AND period_start < TIMESTAMP '2024-01-09'), g2 AS (SELECT ems, managed_element, unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-08 23:00:00', INTERVAL 1 HOUR)) AS period_start FROM (SELECT DISTINCT ems, managed_element FROM t2)) SELECT ems, managed_element, period_start FROM gaps WHERE period_start < TIMESTAMP '2024-01-08' OR period_start >= TIMESTAMP '2024-01-09' UNION ALL SELECT g2.* FROM g2 LEFT JOIN t2 USING (ems, managed_element, period_start) WHERE t2.ems IS NULL"))


def _loads(v: Views):
    o = v.table("orders")
    return o.filter("o_orderstatus <> 'O'").select(F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("load_id"))


LOADS = "loads AS (SELECT 'ems' || (o_custkey % 2) AS ems, o_orderdate::DATE AS day, o_orderkey AS load_id FROM orders WHERE o_orderstatus <> 'O')"
register("c14_pending_partitions", lambda v: q.pending_partitions(q.file_states(v.deliveries()), _loads(v), datetime(1998, 1, 1)), with_views(*_D, body=f", {LOADS} SELECT DISTINCT period_start::DATE AS day, ems FROM states WHERE period_start::DATE + INTERVAL 1 DAY + INTERVAL 30 MINUTE <= TIMESTAMP '1998-01-01' AND (period_start::DATE, ems) NOT IN (SELECT day, ems FROM loads)"))
register("c15_pending_gold", lambda v: q.pending_gold(_loads(v), _loads(v).filter("load_id % 2 = 0"), 2), f"WITH {LOADS} SELECT DISTINCT day FROM loads WHERE load_id % 2 <> 0 AND day IN (SELECT day FROM loads GROUP BY day HAVING count(DISTINCT ems) = 2)")
register("c16_load_record", lambda v: q.load_record(staged(v), gaps(v)), with_views("bronze", body=f", {STAGED}, {GAPS} SELECT count(*) AS rows, count(*) FILTER (WHERE derived) AS derived_rows, count(*) FILTER (WHERE suspect) AS suspect_rows, count(*) FILTER (WHERE conflict) AS conflict_rows, count(*) FILTER (WHERE late) AS late_rows, (SELECT count(*) FROM gaps) AS gaps FROM staged"))
register("c17_evaluate", lambda v: q.evaluate(v.table("labels").filter("toxic = 1").select(F.lit("toxic").alias("kind"), "doc_id"), v.table("documents").filter(F.col("text").contains("idiot") | F.col("text").contains("moron")).select(F.lit("toxic").alias("kind"), "doc_id"), ["doc_id"]),
         "WITH p AS (SELECT doc_id FROM labels WHERE toxic = 1), f AS (SELECT doc_id FROM documents WHERE contains(text, 'idiot') OR contains(text, 'moron')) SELECT 'toxic' AS kind, (SELECT count(*) FROM p) AS planted, (SELECT count(*) FROM f) AS found, (SELECT count(*) FROM p JOIN f USING (doc_id)) AS matched")
register("c18_missing_files", lambda v: q.missing_files(staged(v).filter((F.col("period_start") >= F.lit(LO)) & (F.col("period_start") < F.lit(HI)) & (F.col("granularity_min") == 60)), gaps(v)),
         with_views("bronze", body=f", {STAGED}, {GAPS}, e AS (SELECT ems, period_start::DATE AS day, count(DISTINCT managed_element) AS n FROM there GROUP BY 1, 2), m AS (SELECT ems, period_start, count(DISTINCT managed_element) AS missing FROM gaps GROUP BY 1, 2) SELECT m.ems, m.period_start, m.missing FROM m JOIN e ON e.ems = m.ems AND e.day = m.period_start::DATE AND e.n = m.missing"))
register("c19_continuous_across", lambda v: q.continuous_across(staged(v).withColumn("period_start", F.date_trunc("month", "period_start")), "view"),
         with_views("bronze", body=f", {STAGED} SELECT managed_element, count(DISTINCT release) AS releases, count(DISTINCT date_trunc('month', period_start)) AS periods, count(DISTINCT CASE WHEN measurement = 'view' THEN date_trunc('month', period_start) END) AS with_measurement FROM staged GROUP BY 1 HAVING count(DISTINCT release) >= 2 AND count(DISTINCT date_trunc('month', period_start)) = count(DISTINCT CASE WHEN measurement = 'view' THEN date_trunc('month', period_start) END)"))
register("c20_quality_events", lambda v: q.quality_events(gaps(v), states(v), datetime(1997, 1, 1), datetime(2024, 2, 1)),
         with_views("bronze", *_D, body=f", {LATE}, {STAGED}, {GAPS}, x AS (SELECT * FROM marked WHERE period_start >= TIMESTAMP '1997-01-01' AND period_start < TIMESTAMP '2024-02-01') SELECT 'late_file' AS kind, ems, period_start, file_name || ' arrived ' || strftime(first_arrival, '%Y-%m-%d %H:%M') AS detail FROM x WHERE late UNION ALL SELECT CASE WHEN versions > 1 THEN 'changed_redelivery' ELSE 'duplicate_delivery' END, ems, period_start, file_name || ' delivered ' || deliveries || ' times' FROM x WHERE deliveries > 1 UNION ALL SELECT 'missing_period', ems, period_start, 'no values of ' || managed_element FROM gaps"))
register("c21_case_counts", lambda v: q.case_counts(gaps(v), states(v), staged(v)), with_views("bronze", *_D, body=f", {LATE}, {STAGED}, {GAPS} SELECT 'late_files' AS \"case\", count(*) FILTER (WHERE late) AS rows FROM marked UNION ALL SELECT 'duplicate_deliveries', count(*) FILTER (WHERE deliveries > 1 AND versions <= 1) FROM marked UNION ALL SELECT 'changed_files', count(*) FILTER (WHERE versions > 1) FROM marked UNION ALL SELECT 'suspect_values', count(*) FILTER (WHERE suspect) FROM staged UNION ALL SELECT 'conflict_values', count(*) FILTER (WHERE conflict) FROM staged UNION ALL SELECT 'null_values', count(*) FILTER (WHERE value IS NULL) FROM staged UNION ALL SELECT 'gaps', count(*) FROM gaps"))
register("c22_flag_counts", lambda v: q.flag_counts(staged(v), ["ems", "release", "measurement"]), with_views("bronze", body=f", {STAGED} SELECT ems, release, measurement, count(*) AS rows, count(*) FILTER (WHERE suspect) AS suspect, count(*) FILTER (WHERE late) AS late, count(*) FILTER (WHERE conflict) AS conflict, count(*) FILTER (WHERE value IS NULL) AS empty FROM staged GROUP BY ALL"))
register("c23_complete_days", lambda v: q.complete_days(_loads(v), 2), f"WITH {LOADS}, b AS (SELECT day FROM loads GROUP BY day HAVING count(DISTINCT ems) = 2) SELECT day FROM b WHERE day + 1 IN (SELECT day FROM b)")
register("c24_invariants", lambda v: q.invariants(v.wide(), [("rrc_succ", "rrc_att"), ("tch_succ", "tch_blocked")], ["prb_pct"]), with_views("wide", body="SELECT 'rrc_succ <= rrc_att' AS rule, count(*) FILTER (WHERE rrc_succ > rrc_att) AS rows FROM wide UNION ALL SELECT 'tch_succ <= tch_blocked', count(*) FILTER (WHERE tch_succ > tch_blocked) FROM wide UNION ALL SELECT 'prb_pct in 0 to 100', count(*) FILTER (WHERE NOT prb_pct BETWEEN 0 AND 100) FROM wide"))
register("c25_consistency", lambda v: q.consistency(v.table("orders"), v.table("orders").join(v.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(F.count_distinct("o_orderkey").alias("expected")), ["o_orderpriority"]),
         "WITH h AS (SELECT o_orderpriority, count(*) AS exported FROM orders GROUP BY 1), e AS (SELECT o_orderpriority, count(DISTINCT o_orderkey) AS expected FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) SELECT o_orderpriority, coalesce(exported, 0) AS exported, coalesce(expected, 0) AS expected, coalesce(exported, 0) = coalesce(expected, 0) AS agrees FROM h FULL JOIN e USING (o_orderpriority)")
register("c26_leaks", lambda v: q.leaks(v.table("lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("date").alias("day")), v.table("orders").select((F.col("o_custkey") % 100).alias("k"), F.col("o_orderdate").cast("date").alias("day")), ["k", "day"]).groupBy("k").agg(F.count("*").alias("rows")), "SELECT l_suppkey AS k, count(*) AS rows FROM lineitem WHERE (l_suppkey, l_shipdate::DATE) IN (SELECT o_custkey % 100, o_orderdate::DATE FROM orders) GROUP BY 1")
