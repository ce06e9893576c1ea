"""Queries of the statistics and comparison operators, and of the scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import statistics as st
from .registry import register, rounded
from .views import Views, with_views

E = "events"
SHAPE = "sh AS (SELECT user_id % 2 AS g, hour(ts)::INT AS hour, avg(value) AS mean FROM events GROUP BY 1, 2), shape AS (SELECT g, hour, mean, mean / avg(mean) OVER (PARTITION BY g) AS shape FROM sh)"


def shape(v: Views):
    return st.hourly_shape(v.table(E).withColumn("g", F.col("user_id") % 2), "ts", "value", "g")


def wide_day(v: Views):
    return v.wide().groupBy("cell_name", F.col("period_start").cast("date").alias("day")).agg(F.sum("ip_vol_kbit").alias("volume"), F.sum("rrc_att").alias("tries"), F.avg("prb_pct").alias("load"))


DAY = "day AS (SELECT cell_name, period_start::DATE AS day, sum(ip_vol_kbit) AS volume, sum(rrc_att) AS tries, avg(prb_pct) AS load FROM wide GROUP BY 1, 2)"
register("g01_hourly_shape", lambda v: rounded(shape(v), 6), f"WITH {SHAPE} SELECT g, hour, round(mean, 6) AS mean, round(shape, 6) AS shape FROM shape")
register("g02_best_shift", lambda v: rounded(st.best_shift(shape(v).filter("g = 0"), shape(v).filter("g = 1")), 6), f"WITH {SHAPE}, p AS (SELECT s.s::INT AS shift, corr(a.shape, b.shape) AS r FROM shape a, shape b, range(24) s(s) WHERE a.g = 0 AND b.g = 1 AND a.hour = (b.hour + s.s) % 24 GROUP BY 1) SELECT shift, round(r, 6) AS r FROM p ORDER BY round(r, 9) DESC, shift LIMIT 1")
register("g03_binned_medians", lambda v: rounded(st.binned_medians(v.wide(), "prb_pct", "ip_vol_kbit"), 6), with_views("wide", body=", r AS (SELECT least(floor(prb_pct / 10.0), 9)::INT AS bin, ip_vol_kbit AS x FROM wide WHERE prb_pct BETWEEN 0 AND 100) SELECT bin, count(*) AS n, round(quantile_cont(x, 0.5) / (SELECT quantile_cont(x, 0.5) FROM r), 6) AS relative FROM r GROUP BY bin"))
register("g04_percentiles", lambda v: rounded(st.percentiles(v.table("lineitem"), "l_extendedprice", [0.1, 0.25, 0.5, 0.75, 0.9, 0.99], ["l_returnflag"]), 4), "SELECT l_returnflag, unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.99])::DOUBLE AS q, round(unnest(quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.75, 0.9, 0.99])), 4) AS value FROM lineitem GROUP BY 1")
register("g05_spearman", lambda v: rounded(st.spearman(v.table("lineitem"), "l_quantity", "l_discount", ["l_returnflag"]), 6), "WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2.0 AS b FROM lineitem) SELECT l_returnflag, count(*) AS n, round(corr(a, b), 6) AS rho FROM r GROUP BY 1")
register("g06_spearman_ordinal", lambda v: rounded(st.spearman_ordinal(v.table("orders"), "o_totalprice", "o_custkey", ["o_orderpriority"], "o_orderkey"), 6), "WITH r AS (SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS a, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey, o_orderkey) AS b FROM orders) SELECT o_orderpriority, round(corr(a, b), 6) AS rho FROM r GROUP BY 1")
register("g07_rate_proxy", lambda v: rounded(st.rate_proxy(v.wide(), "ip_vol_kbit", "rrc_att", 25.0).groupBy("cell_name").agg(F.count("*").alias("n"), F.avg("rate").alias("rate")), 4), with_views("wide", body="SELECT cell_name, count(*) AS n, round(avg(ip_vol_kbit / rrc_att), 4) AS rate FROM wide WHERE rrc_att >= 25 GROUP BY 1"))
register("g08_sizes", lambda v: st.sizes(v.table(E), ["user_id", "event_type"], "ts"), "SELECT count(*) AS rows, count(DISTINCT (user_id, event_type)) AS objects, min(ts) AS first, max(ts) AS last FROM events")
register("g09_first_last", lambda v: rounded(st.first_last(v.table(E).groupBy(F.floor("value").alias("bin")).agg(F.count("*").alias("n")), "bin", "n")), "WITH h AS (SELECT floor(value)::BIGINT AS bin, count(*) AS n FROM events GROUP BY 1) SELECT min(bin) AS first, max(bin) AS last, arg_min(n, bin) AS first_n, arg_max(n, bin) AS last_n FROM h")
register("g10_peak_slot", lambda v: rounded(st.peak_slot(v.table(E), "event_type", "ts", "value", 30.0).select("event_type", F.col("slot").cast("int").alias("slot"), "mean", "share_high", "top"), 6), "WITH s AS (SELECT event_type, (((dayofweek(ts) + 6) % 7) * 24 + hour(ts))::INT AS slot, avg(value) AS mean, avg(CASE WHEN value > 30 THEN 1.0 ELSE 0.0 END) AS hi, max(value) AS top FROM events GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY round(mean, 9) DESC, slot) AS n, max(top) OVER (PARTITION BY event_type) AS t FROM s) SELECT event_type, slot, round(mean, 6) AS mean, round(hi, 6) AS share_high, round(t, 6) AS top FROM b WHERE n = 1")
register("g11_run_totals", lambda v: rounded(st.run_totals(v.wide(), {"rrc": ("rrc_succ", "rrc_att"), "drop": ("erab_rel", "erab_succ")}, ["ip_vol_kbit"]), 2), with_views("wide", body="SELECT count(*) AS rows, count(DISTINCT cell_name) AS cells, min(period_start) AS first, max(period_start) AS last, round(sum(rrc_succ) / sum(rrc_att), 2) AS rrc, round(sum(erab_rel) / sum(erab_succ), 2) AS drop, round(sum(ip_vol_kbit), 2) AS total_ip_vol_kbit FROM wide"))
register("g12_relationship_checks", lambda v: rounded(st.relationship_checks(v.wide().join(v.cells().select("cell_name", "area"), "cell_name"), "prb_pct", "erab_rel", "rrc_att", "area", ["rural", "suburban", "urban"], "ip_vol_kbit"), 4),
         with_views("wide", "cells", body=", w AS (SELECT * FROM wide JOIN cells USING (cell_name)), m AS (SELECT quantile_cont(prb_pct, 0.5) AS m FROM w), o AS (SELECT sum(erab_rel) FILTER (WHERE prb_pct > m) / sum(rrc_att) FILTER (WHERE prb_pct > m) - sum(erab_rel) FILTER (WHERE prb_pct <= m) / sum(rrc_att) FILTER (WHERE prb_pct <= m) AS f FROM w, m), a AS (SELECT area, quantile_cont(ip_vol_kbit, 0.5) AS q FROM w GROUP BY 1), d AS (SELECT q - lag(q) OVER (ORDER BY area) AS d FROM a) SELECT 'failures rise with load' AS \"check\", round(f, 4) AS figure, f > 0 AS passed FROM o UNION ALL SELECT 'medians rise along the groups', round(min(d), 4), coalesce(min(d) >= 0, true) FROM d"))
register("g13_spread", lambda v: rounded(st.spread(v.table("customer"), "c_acctbal", ["c_mktsegment"]), 4), "SELECT c_mktsegment, count(*) AS n, round(min(c_acctbal), 4) AS least, round(quantile_cont(c_acctbal, 0.5), 4) AS median, round(max(c_acctbal), 4) AS most, round(quantile_cont(abs(c_acctbal), 0.9), 4) AS abs_p90, round(quantile_cont(abs(c_acctbal), 0.99), 4) AS abs_p99, round(max(abs(c_acctbal)), 4) AS abs_most FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1")


def _years(v: Views, year: int):
    return v.table("orders").filter(F.year("o_orderdate") == year).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("value"), F.count("*").cast("double").alias("weight"), F.min("o_orderpriority").alias("kind"))


_Y = ", ".join(f"y{y} AS (SELECT o_custkey, sum(o_totalprice) AS value, count(*)::DOUBLE AS weight, min(o_orderpriority) AS kind FROM orders WHERE year(o_orderdate) = {y} GROUP BY 1)" for y in (1995, 1996, 1997))
register("g14_change_rows", lambda v: rounded(st.change_rows(_years(v, 1995), _years(v, 1996), ["o_custkey"], "value"), 2), f"WITH {_Y} SELECT o_custkey, round(a.value, 2) AS before, round(b.value, 2) AS after, round(b.value - a.value, 2) AS change, round(100 * (b.value - a.value) / nullif(a.value, 0), 2) AS relative FROM y1995 a FULL JOIN y1996 b USING (o_custkey)")
register("g14_change_summary", lambda v: rounded(st.change_summary(st.change_rows(_years(v, 1995), _years(v, 1996), ["o_custkey"], "value").withColumn("k", F.col("o_custkey") % 5), ["k"]), 4), f"WITH {_Y}, c AS (SELECT o_custkey % 5 AS k, 100 * (b.value - a.value) / nullif(a.value, 0) AS r FROM y1995 a FULL JOIN y1996 b USING (o_custkey)) SELECT k, count(r) AS n, round(quantile_cont(r, 0.5), 4) AS median, round(quantile_cont(abs(r), 0.9), 4) AS abs_p90, round(avg((abs(r) > 10)::INT), 4) AS share_moved FROM c GROUP BY k")
register("g15_touched", lambda v: st.touched(_years(v, 1995).select("o_custkey", "value", "weight"), _years(v, 1996).select("o_custkey", "value", "weight"), "o_custkey", {"value": 50000.0, "weight": 2.0}, v.table("customer").filter("c_acctbal < -900").select(F.col("c_custkey").alias("o_custkey"))), f"WITH {_Y} SELECT o_custkey FROM y1995 a JOIN y1996 b USING (o_custkey) WHERE abs(b.value - a.value) > 50000 OR abs(b.weight - a.weight) > 2 UNION SELECT c_custkey FROM customer WHERE c_acctbal < -900")
register("g16_set_kpis", lambda v: rounded(st.set_kpis(v.wide(), v.cells().select("cell_name", F.col("area").alias("set_name")).unionByName(v.cells().select("cell_name", F.col("technology").alias("set_name"))), {"rrc": ("rrc_succ", "rrc_att")}), 6), with_views("wide", "cells", body=", s AS (SELECT cell_name, area AS set_name FROM cells UNION ALL SELECT cell_name, technology FROM cells) SELECT set_name, round(sum(rrc_succ) / sum(rrc_att), 6) AS rrc FROM wide JOIN s USING (cell_name) GROUP BY 1 UNION ALL SELECT 'total', round(sum(rrc_succ) / sum(rrc_att), 6) FROM wide"))
register("g17_reach", lambda v: rounded(st.reach(_years(v, 1995), _years(v, 1996), "o_custkey", "value", "weight", 50000.0), 6), f"WITH {_Y}, b AS (SELECT a.value AS a, b.value AS b, a.weight AS w, coalesce(abs(b.value - a.value) > 50000, a.value IS DISTINCT FROM b.value) AS m FROM y1995 a JOIN y1996 b USING (o_custkey)) SELECT count(*) AS cells, count(*) FILTER (WHERE m) AS moved, round(sum(CASE WHEN m THEN w ELSE 0 END) / sum(w), 6) AS share FROM b")
register("g18_recovery", lambda v: rounded(st.recovery(_years(v, 1995), _years(v, 1996), _years(v, 1997), ["o_custkey"]), 4), f"WITH {_Y} SELECT o_custkey, round(CASE WHEN abs(c.value - f.value) >= 1e-9 THEN (x.value - f.value) / (c.value - f.value) END, 4) AS recovery FROM y1995 c JOIN y1996 f USING (o_custkey) JOIN y1997 x USING (o_custkey)")
_IV = "iv AS (SELECT o_custkey % 40 AS g, o_orderkey AS id, o_orderdate AS s, o_orderdate + INTERVAL 3 DAY AS e FROM orders)"
register("g19_overlaps", lambda v: st.overlaps(v.table("orders").select((F.col("o_custkey") % 40).alias("g"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 3 days")).alias("end")), "g", 5 * 86400), f"WITH {_IV} SELECT a.g, a.id AS id_a, b.id AS id_b FROM iv a JOIN iv b ON a.g = b.g AND a.id < b.id AND a.s < b.e AND b.s < a.e")
register("g20_schedule", lambda v: st.schedule(v.table(E).filter("value > 60"), "ts", datetime(2024, 1, 1), datetime(2024, 1, 31)), "WITH w AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 7 DAY))::DATE AS week), e AS (SELECT date_trunc('week', ts)::DATE AS week, count(*) AS n FROM events WHERE value > 60 GROUP BY 1) SELECT week, coalesce(n, 0) AS events, coalesce(n, 0) = 0 AS quiet FROM w LEFT JOIN e USING (week)")
register("g21_daily_series", lambda v: rounded(v.wide().filter("cell_name in ('s1', 's2', 's3')").groupBy(F.col("period_start").cast("date").alias("day")).agg((F.sum("rrc_succ") / F.sum("rrc_att")).alias("value")), 6), with_views("wide", body="SELECT period_start::DATE AS day, round(sum(rrc_succ) / sum(rrc_att), 6) AS value FROM wide WHERE cell_name IN ('s1', 's2', 's3') GROUP BY 1"))
register("g22_tail_share", lambda v: rounded(st.tail_share(v.table("embeddings").select("label", F.posexplode("embedding").alias("bin", "w")).withColumn("w", F.abs(F.col("w").cast("double"))), "label", "bin", "w", 48), 4), "WITH h AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS bin, abs(unnest(embedding)::DOUBLE) AS w FROM embeddings) SELECT label, round(sum(CASE WHEN bin >= 48 THEN w ELSE 0 END) / sum(w), 4) AS tail FROM h GROUP BY 1")


def _wait(v: Views):
    files = v.deliveries().select(F.col("arrival_time").cast("date").alias("day"), "arrival_time")
    return files, files.select("day").distinct().select("day", (F.col("day").cast("timestamp_ntz") + F.expr("interval 1470 minutes")).alias("cutoff"))


register("g23_arrival_wait", lambda v: rounded(st.arrival_wait(*_wait(v), [0.1, 0.5, 0.9, 0.99]), 4), with_views("deliveries", body=", w AS (SELECT date_diff('second', arrival_time, arrival_time::DATE + INTERVAL 1470 MINUTE) / 60.0 AS wait FROM deliveries), r AS (SELECT wait, row_number() OVER (ORDER BY wait) - 1 AS i, count(*) OVER () AS n FROM w) SELECT q.q::DOUBLE AS q, round(wait::DOUBLE, 4) AS wait FROM r, (SELECT unnest([0.1, 0.5, 0.9, 0.99])::DOUBLE AS q) q WHERE i = round_even(q.q * (n - 1), 0)"))
register("g24_rates", lambda v: rounded(st.rates(v.table("lineitem"), "l_shipdate", "l_linenumber", "l_quantity", "l_extendedprice").select(F.col("l_shipdate").cast("date").alias("day"), "rows_per_s", "bytes_per_row", "loads"), 6), "SELECT l_shipdate::DATE AS day, round(sum(l_linenumber) / sum(l_quantity), 6) AS rows_per_s, round(sum(l_extendedprice) / sum(l_linenumber), 6) AS bytes_per_row, count(*) AS loads FROM lineitem GROUP BY 1")
register("g25_power_law", lambda v: rounded(st.power_law(v.table("orders").groupBy(F.year("o_orderdate").cast("double").alias("x")).agg(F.sum("o_totalprice").alias("y")), "x", "y", 2005.0), 2), "WITH p AS (SELECT year(o_orderdate)::DOUBLE AS x, sum(o_totalprice) AS y FROM orders GROUP BY 1), e AS (SELECT arg_min(y, x) AS y0, arg_max(y, x) AS y1, min(x) AS x0, max(x) AS x1 FROM p) SELECT round(ln(y1 / y0) / ln(x1 / x0), 2) AS exponent, round(y1 * pow(2005 / x1, ln(y1 / y0) / ln(x1 / x0)), 2) AS value FROM e")
register("g27_inventory", lambda v: rounded(st.inventory(v.cells(), ["technology", "area"]), 6), with_views("cells", body="SELECT technology, area, count(*) AS cells, count(DISTINCT site) AS sites, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM cells GROUP BY 1, 2"))
register("g28_fingerprint", lambda v: st.fingerprint(v.table("conversations")).withColumn("total", F.col("total").cast("string")), "WITH b AS (SELECT ('0x' || substr(md5(concat_ws(chr(31), coalesce(conv_id::VARCHAR, chr(30)), coalesce(role, chr(30)), coalesce(text, chr(30)), coalesce(turn::VARCHAR, chr(30)))), 1, 12))::BIGINT AS b FROM conversations) SELECT count(*) AS rows, bit_xor(b) AS xor, sum(b)::HUGEINT::VARCHAR AS total FROM b")
# Scalar functions
register("f01_json", lambda v: v.table(E).select("event_id", F.get_json_object("props", "$.k").alias("text"), F.from_json("props", "k int")["k"].alias("k"), F.expr("try_cast(get_json_object(props, '$.k') as int)").alias("tried")), "SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS text, regexp_extract(props, '(\\d+)', 1)::INT AS k, regexp_extract(props, '(\\d+)', 1)::INT AS tried FROM events")
register("f02_strings", lambda v: v.table("customer").groupBy("c_mktsegment").agg(F.array_join(F.array_sort(F.collect_set(F.split_part("c_name", F.lit("#"), F.lit(1)))), ",").alias("heads"), F.count_if(F.startswith("c_name", F.lit("Customer#0"))).alias("starts"), F.max(F.regexp_replace("c_name", "[0-9]", "")).alias("letters")), "SELECT c_mktsegment, string_agg(DISTINCT split_part(c_name, '#', 1), ',' ORDER BY split_part(c_name, '#', 1)) AS heads, count(*) FILTER (WHERE starts_with(c_name, 'Customer#0')) AS starts, max(regexp_replace(c_name, '[0-9]', '', 'g')) AS letters FROM customer GROUP BY 1")
register("f03_dates", lambda v: v.table(E).select("event_id", F.date_trunc("hour", "ts").alias("h"), F.timestamp_diff("MINUTE", F.lit(datetime(2024, 1, 1)), "ts").alias("minutes"), (F.dayofweek("ts") - 1).cast("long").alias("dow"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("text"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("epoch")), "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS h, floor(epoch(ts - TIMESTAMP '2024-01-01') / 60)::BIGINT AS minutes, dayofweek(ts) AS dow, strftime(ts, '%Y-%m-%d %H:%M') AS text, floor(epoch(ts))::BIGINT AS epoch FROM events")
register("f04_nulls", lambda v: v.table("customer").select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("a"), F.coalesce(F.nullif(F.col("c_nationkey"), F.lit(3)), F.lit(-1)).alias("b"), (~F.nullif(F.col("c_nationkey"), F.lit(3)).eqNullSafe(F.lit(None).cast("int"))).alias("c")), "SELECT c_custkey, nullif(c_nationkey, 3) AS a, coalesce(nullif(c_nationkey, 3), -1) AS b, nullif(c_nationkey, 3) IS DISTINCT FROM NULL AS c FROM customer")
register("f05_aggregates", lambda v: rounded(v.table("orders").groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("s"), F.count("*").alias("n"), F.min("o_orderdate").alias("lo"), F.avg("o_totalprice").alias("m"), F.bool_or(F.col("o_totalprice") > 400000).alias("any"), F.bool_and(F.col("o_totalprice") > 0).alias("every"), F.count_distinct("o_custkey").alias("d"), F.count_if(F.col("o_totalprice") > 1e5).alias("f")), 2), "SELECT o_orderstatus, round(sum(o_totalprice), 2) AS s, count(*) AS n, min(o_orderdate) AS lo, round(avg(o_totalprice), 2) AS m, bool_or(o_totalprice > 400000) AS any, bool_and(o_totalprice > 0) AS every, count(DISTINCT o_custkey) AS d, count(*) FILTER (WHERE o_totalprice > 1e5) AS f FROM orders GROUP BY 1")
register("f06_lists", lambda v: v.table("part").select("p_partkey", F.explode(F.sequence(F.lit(1), F.least("p_size", F.lit(5)))).alias("i"), F.array_contains(F.split("p_type", " "), F.element_at(F.split("p_type", " "), 1)).alias("has")), "SELECT p_partkey, unnest(range(1, least(p_size, 5) + 1))::INT AS i, true AS has FROM part")
register("f07_math", lambda v: rounded(v.table("customer").select("c_custkey", F.round(F.col("c_acctbal") / 7).alias("r"), F.rint(F.col("c_acctbal") / 50).alias("e"), F.log10(F.abs("c_acctbal") + 1).alias("l"), F.hypot("c_acctbal", F.lit(100.0)).alias("h"), F.atan2("c_acctbal", F.lit(100.0)).alias("a"), F.tanh(F.col("c_acctbal") / 5000).alias("t"), F.greatest(F.lit(0.0), F.least(F.lit(5000.0), "c_acctbal")).alias("c")), 6), "SELECT c_custkey, round(c_acctbal / 7) AS r, round_even(c_acctbal / 50, 0) AS e, round(log10(abs(c_acctbal) + 1), 6) AS l, round(sqrt(c_acctbal * c_acctbal + 10000), 6) AS h, round(atan2(c_acctbal, 100), 6) AS a, round(tanh(c_acctbal / 5000), 6) AS t, round(greatest(0.0, least(5000.0, c_acctbal)), 6) AS c FROM customer")
