"""Queries of readers, writers and streams: files are composed out of the shared tables,
written to the scratch folder, and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.scratch import scratch_path
from ..sources import files, sinks, structure
from ..streaming import ingest
from .registry import register, rounded
from .views import Views, with_views

_PER = ["ems", "cell_name", "hour"]


def _hours(v: Views):
    b = v.bronze().withColumn("hour", F.date_trunc("hour", "period_start"))
    per = b.groupBy(*_PER, "counter").agg(F.sum("value").alias("v"), F.bool_or("suspect").alias("s"))
    kept = F.struct("counter", F.when(F.floor("v") % 17 == 0, "NIL").otherwise(F.round("v", 3).cast("string")).alias("text"))
    return per.groupBy(*_PER).agg(F.array_sort(F.collect_list(kept)).alias("x"), F.bool_or("s").alias("suspect"))


def _pm_text(positional: bool):
    zone = F.concat(F.date_format(F.col("hour") + F.expr("interval 8 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    if positional:
        types = F.array_join(F.transform("x", lambda t, i: F.concat(F.lit('<measType p="'), (i + 1).cast("string"), F.lit('">'), t["counter"], F.lit("</measType>"))), "")
        results = F.array_join(F.transform("x", lambda t, i: F.concat(F.lit('<r p="'), (i + 1).cast("string"), F.lit('">'), t["text"], F.lit("</r>"))), "")
    else:
        types = F.concat(F.lit("<measTypes>"), F.array_join("x.counter", " "), F.lit("</measTypes>"))
        results = F.concat(F.lit("<measResults>"), F.array_join("x.text", " "), F.lit("</measResults>"))
    return F.concat(
        F.lit('<measCollecFile><fileHeader fileFormatVersion="1" dnPrefix="N=1" vendorName="A"><fileSender localDn="'), F.col("ems"), F.lit('"/><measCollec beginTime="'), zone, F.lit('"/></fileHeader><measData><managedElement localDn="ME='), F.col("cell_name"),
        F.lit('" swVersion="R1"/><measInfo measInfoId="G"><granPeriod duration="PT3600S" endTime="'), zone, F.lit('"/>'), types, F.lit('<measValue measObjLdn="Cell=1">'), results,
        F.when(F.col("suspect"), "<suspect>true</suspect>").otherwise(""), F.lit('</measValue></measInfo></measData><fileFooter><measCollec endTime="'), zone, F.lit('"/></fileFooter></measCollecFile>'),
    )


#: Collections of a composed file on average, so that files grow in number and not in size.
PER_FILE = 500


def _about(v: Views) -> int:
    """How many collections there are, about: for the number of files they need not be made."""
    hour = F.date_trunc("hour", "period_start").alias("hour")
    return v.bronze().select("ems", "cell_name", hour).agg(F.approx_count_distinct(F.struct(*_PER), 0.02)).first()[0]


def _written(v: Views, text, name: str = "pm", packed: bool = True) -> str:
    """Files of about ``PER_FILE`` collections with a root around them, with gzip or plain."""
    path = scratch_path(v.spark, name)
    hours = _hours(v)
    n = max(_about(v) // PER_FILE, 1)
    whole = F.concat(F.lit("<files>"), F.array_join(F.collect_list("t"), ""), F.lit("</files>")).alias("value")
    files_ = hours.select(F.pmod(F.xxhash64(*_PER), F.lit(n)).alias("k"), text.alias("t")).groupBy("k").agg(whole).drop("k")
    files_.write.option("maxRecordsPerFile", 1).option("compression", "gzip" if packed else "none").text(path)
    return path


def pm_files(v: Views, positional: bool = False) -> str:
    return _written(v, _pm_text(positional), packed=not positional)


#: Objects and counters of a collection of the dense form.
OBJECTS, KINDS = 60, 5


def dense_pm_files(v: Views) -> str:
    """One collection for each system and quarter of an hour, as systems write them: a list of
    counters and a value of each for every object.  Values are those of the raw rows, object
    by object; `OBJECTS` times `KINDS` values in a collection."""
    path = scratch_path(v.spark, "dense")
    zone = F.concat(F.date_format(F.col("period_start") + F.expr("interval 8 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    per = v.bronze().groupBy("ems", "period_start").agg(F.round(F.sum("value"), 2).cast("string").alias("x"))
    value = lambda i: F.concat(F.lit('<measValue measObjLdn="Cell='), i.cast("string"), F.lit('"><measResults>'), F.array_join(F.array_repeat("x", KINDS), " "), F.lit("</measResults></measValue>"))
    values = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(OBJECTS)), value), "")
    text = F.concat(
        F.lit('<measCollecFile><fileHeader fileFormatVersion="1" dnPrefix="N=1"><fileSender localDn="'), F.col("ems"), F.lit('"/><measCollec beginTime="'), zone, F.lit('"/></fileHeader><measData><managedElement localDn="ME=1"/><measInfo measInfoId="G"><granPeriod duration="PT900S" endTime="'), zone,
        F.lit('"/><measTypes>' + " ".join(f"k{i}" for i in range(KINDS)) + "</measTypes>"), values, F.lit('</measInfo></measData><fileFooter><measCollec endTime="'), zone, F.lit('"/></fileFooter></measCollecFile>'),
    )
    whole = F.concat(F.lit("<files>"), F.array_join(F.collect_list("t"), ""), F.lit("</files>")).alias("value")
    n = max(per.count() // 20, 1)
    rows = per.select(F.pmod(F.xxhash64("ems", "period_start"), F.lit(n)).alias("k"), text.alias("t")).groupBy("k").agg(whole).drop("k")
    rows.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return path


_PM = """hourly AS (SELECT ems, cell_name, date_trunc('hour', period_start)::TIMESTAMP AS hour, counter, sum(value) AS v, bool_or(suspect) AS s FROM bronze GROUP BY ALL),
pm AS (SELECT ems, 'ME=' || cell_name AS managed_element, counter, CASE WHEN floor(v) % 17 = 0 THEN NULL ELSE round(v, 3) END AS value, bool_or(s) OVER (PARTITION BY ems, cell_name, hour) AS suspect, hour AS period_start, hour + INTERVAL 1 HOUR AS period_end FROM hourly)"""
_PM_OUT = ["ems", "managed_element", "counter", "value", "suspect", "period_start", "period_end"]


def _ntz(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


for _n, _p in (("a01_read_pm_xml", False), ("a01_read_pm_xml_positional", True)):
    register(_n, lambda v, p=_p: _ntz(rounded(files.read_pm_xml(v.spark, pm_files(v, p)).select(*_PM_OUT), 3)), with_views("bronze", body=f", {_PM} SELECT ems, managed_element, counter, round(value, 3) AS value, suspect, period_start, period_end FROM pm"))


def omes_files(v: Views) -> str:
    body = F.array_join(F.transform("x", lambda t: F.concat(F.lit("<"), t["counter"], F.lit(' unit="a&amp;b">'), t["text"], F.lit("</"), t["counter"], F.lit(">"))), "")
    text = F.concat(F.lit('<OMeS><PMSetup startTime="'), F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+00:00:00" interval="60"><PMMOResult><MO><DN>PLMN-1/'), F.col("cell_name"), F.lit("/LNCEL-1</DN></MO><PMTarget measurementType=\"G\">"), body, F.lit("</PMTarget></PMMOResult></PMSetup></OMeS>"))
    return _written(v, text, "omes")


register("a02_read_omes_xml", lambda v: _ntz(rounded(files.read_omes_xml(v.spark, omes_files(v)).select("managed_element", "object_dn", "meas_group", "counter", "value", "period_start", "period_end"), 3)),
         with_views("bronze", body=f", {_PM} SELECT replace(managed_element, 'ME=', 'PLMN-1/') AS managed_element, replace(managed_element, 'ME=', 'PLMN-1/') || '/LNCEL-1' AS object_dn, 'G' AS meas_group, counter, round(value, 3) AS value, period_start, period_end FROM pm"))
register("a03_file_period", lambda v: _ntz(v.table("orders").select("o_orderkey", files.file_period(F.concat(F.lit("A"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".2345+0700-0000+0700_unit-"), F.col("o_custkey").cast("string"), F.lit(".xml.gz"))).alias("p")).select("o_orderkey", "p.start", "p.end")),
         "SELECT o_orderkey, o_orderdate::DATE + INTERVAL 1005 MINUTE AS start, o_orderdate::DATE + INTERVAL 1020 MINUTE AS \"end\" FROM orders")

register("a03_omes_names", lambda v: _ntz(v.table("orders").select("o_orderkey", F.concat(F.lit("OMeS_EMS-"), F.col("o_custkey").cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T0815Z.xml.gz")).alias("n")).select("o_orderkey", files.omes_name(F.col("n"))["ems"].alias("ems"), files.file_period(F.col("n"))["start"].alias("start"))),
         "SELECT o_orderkey, 'EMS-' || o_custkey AS ems, o_orderdate::DATE + INTERVAL 495 MINUTE AS start FROM orders")


def record_files(v: Views) -> str:
    path = scratch_path(v.spark, "records")
    o = v.table("orders")
    o.select(F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_totalprice"))).write.option("compression", "gzip").text(path)
    return path


register("a04_read_records", lambda v: rounded(files.read_records(v.spark, record_files(v)).select(F.from_json("record", "o_orderkey long, o_orderstatus string, o_totalprice double").alias("r")).groupBy("r.o_orderstatus").agg(F.count("*").alias("n"), F.sum("r.o_totalprice").alias("total")), 2), "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")


def _ledger(v: Views):
    path = pm_files(v)
    return files.file_ledger(v.spark, path, files.read_pm_xml(v.spark, path)).filter(F.col("file_name").contains(".txt"))


register("a05_file_ledger", lambda v: _ledger(v).agg(F.sum("rows").alias("rows"), F.bool_and("loaded").alias("loaded"), F.bool_and(F.length("file_hash") == 64).alias("hashed")), with_views("bronze", body=f", {_PM} SELECT count(*) AS rows, true AS loaded, true AS hashed FROM pm"))


def csv_file(v: Views) -> str:
    path = scratch_path(v.spark, "csv")
    v.table("events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Timestamp"), F.concat(F.lit("b,"), F.col("user_id").cast("string")).alias("Base station"), F.col("event_type").alias("Sector"), F.col("value").alias("4G RB utilization"), (F.col("value") * 2).alias("4G data volume DL"), F.lit(1.0).alias("4G RRC users")).write.csv(path, header=True, quoteAll=True)
    return path


register("a06_read_counters_csv", lambda v: rounded(files.read_counters_csv(v.spark, csv_file(v)).groupBy("base_station", "sector").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"), F.max("ts").cast("timestamp_ntz").alias("last")), 4), "SELECT 'b,' || user_id AS base_station, event_type AS sector, count(*) AS n, round(sum(value * 2), 4) AS volume, date_trunc('second', max(ts))::TIMESTAMP AS last FROM events GROUP BY 1, 2")
_RAW = ["ems", "cell_name", "period_start", "counter", "value", "file_name", "arrival_time", "file_hash"]


_KEYS = ["ems", "cell_name", "counter", "period_start"]


def _arrivals(v: Views, by_day: bool = True):
    """Values with an arrival; by day, each event of a day delivers the day's value anew:
    versions of one key, which arrive in another order than they are written."""
    late = F.col("ts") + F.make_dt_interval(hours=(F.col("row_id") * 7 % 50).cast("int"))
    rows = v.bronze().withColumn("period_start", F.date_trunc("day", "period_start").cast("timestamp_ntz")) if by_day else v.bronze()
    return rows.withColumn("arrival_time", late).withColumn("file_hash", F.md5(F.col("row_id").cast("string")))


_NEWEST = """arrived AS (SELECT ems, cell_name, counter, date_trunc('day', period_start)::TIMESTAMP AS period_start, value, row_id, ts + to_hours(row_id * 7 % 50) AS arrival_time, md5(row_id::VARCHAR) AS file_hash FROM bronze),
newest AS (SELECT ems, cell_name, counter, period_start, arg_max(value, {'a': arrival_time, 'h': file_hash}) AS value, max(arrival_time) AS arrival_time FROM arrived GROUP BY ALL)"""


def bronze_table(v: Views, by_day: bool = False) -> str:
    path = scratch_path(v.spark, "bronze")
    half = _arrivals(v, by_day).select(*_RAW, "row_id")
    sinks.append_bronze(half.filter("row_id % 2 = 0").drop("row_id"), path, _RAW)
    sinks.append_bronze(half.filter("row_id % 2 = 1").drop("row_id"), path, _RAW)
    return path


register("a07_append_bronze", lambda v: rounded(v.spark.read.parquet(bronze_table(v)).groupBy("ems", "counter").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4), with_views("bronze", body="SELECT ems, counter, count(*) AS n, round(sum(value), 4) AS total FROM bronze GROUP BY 1, 2"))
register("a08_day_partitions", lambda v: v.spark.read.parquet(bronze_table(v)).filter(F.col("day").between("2024-01-05", "2024-01-07")).groupBy("day").agg(F.count("*").alias("n")), with_views("bronze", body="SELECT period_start::DATE AS day, count(*) AS n FROM bronze WHERE period_start::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' GROUP BY 1"))


def _replaced(v: Views):
    path = scratch_path(v.spark, "villages")
    sinks.replace_table(v.table("part").select("p_partkey"), path)
    sinks.replace_table(v.table("part").select("p_partkey", "p_size"), path)
    return v.spark.read.parquet(path)


register("a09_replace_table", _replaced, "SELECT p_partkey, p_size FROM part")
register("a10_export_sample", lambda v: sinks.export_sample({"nation": v.table("nation"), "cells": v.cells()}, scratch_path(v.spark, "sample")).select("table", "rows", (F.length("sha256") == 64).alias("hashed")), "SELECT 'nation' AS \"table\", count(*) AS rows, true AS hashed FROM nation UNION ALL SELECT 'cells', count(*), true FROM supplier")


def _broken(v: Views):
    good = _pm_text(False)
    slow = F.replace(good, F.lit("PT3600S"), F.lit("soon"))
    more = F.replace(good, F.lit("</measTypes>"), F.lit(" more</measTypes>"))
    text = F.when(F.length("cell_name") == 2, slow).when(F.length("cell_name") == 3, more).otherwise(good)
    return files.raw_pm_xml(v.spark, _written(v, text))


def _broken_positional(v: Views):
    good = _pm_text(True)
    shifted = F.replace(good, F.lit('<r p="1">'), F.lit('<r p="99">'))
    twice = F.replace(good, F.lit('<measType p="1">'), F.lit('<measType p="1">x</measType><measType p="1">'))
    text = F.when(F.length("cell_name") == 2, shifted).when(F.length("cell_name") == 3, twice).otherwise(good)
    return files.raw_pm_xml(v.spark, _written(v, text))


register("a11_validate_positional", lambda v: files.validate_pm_files(_broken_positional(v)).groupBy("violation").agg(F.count("*").alias("files")), with_views("bronze", body=", h AS (SELECT DISTINCT ems, cell_name, date_trunc('hour', period_start) AS h FROM bronze) SELECT 'results do not match types' AS violation, count(*) AS files FROM h WHERE length(cell_name) IN (2, 3) HAVING count(*) > 0"))
register("a11_validate_pm_files", lambda v: files.validate_pm_files(_broken(v)).groupBy("violation").agg(F.count("*").alias("files")), with_views("bronze", body=", h AS (SELECT DISTINCT ems, cell_name, date_trunc('hour', period_start) AS h FROM bronze) SELECT CASE length(cell_name) WHEN 2 THEN 'bad granPeriod duration' ELSE 'results do not match types' END AS violation, count(*) AS files FROM h WHERE length(cell_name) IN (2, 3) GROUP BY 1"))


#: What each kind of cell's files break (by the cell's number modulo 12), and how.
BROKEN = {
    0: ("no fileFooter", r"<fileFooter>.*</fileFooter>", ""),
    1: ("fileFooter is not last", r"(<measData>.*</measData>)(<fileFooter>.*</fileFooter>)", "$2$1"),
    2: ("measValue without measObjLdn", ' measObjLdn="[^"]*"', ""),
    3: ("fileHeader without fileFormatVersion", ' fileFormatVersion="[^"]*"', ""),
    4: ("granPeriod without duration or endTime", '(<granPeriod [^>]*) endTime="[^"]*"', "$1"),
    5: ("measInfo is not granPeriod, types, values", r"(<measTypes>.*</measTypes>)(<measValue.*</measValue>)", "$2$1"),
    6: ("foreign element", "<measInfo ", "<note><b>x</b></note><measInfo "),
    7: ("duration is no number of seconds", "PT3600S", "PT60M"),
    8: ("measData is not managedElement, measInfo", "<managedElement [^>]*>", ""),
    9: ("element out of place or not closed", r"(<measInfo .*</measInfo>)(</measData>)", "$2$1"),
}


def _misbuilt(v: Views):
    """Whole files, each kind of cell with its own fault; 10 and 11 are sound."""
    good = _pm_text(False)
    kind = F.substring("cell_name", 2, 9).cast("int") % 12
    text = good
    for k, (_, old, new) in BROKEN.items():
        text = F.when(kind == k, F.regexp_replace(good, old, new)).otherwise(text)
    return structure.validate_structure(v.spark, _written(v, text))


register("a11_validate_structure", lambda v: _misbuilt(v).groupBy("violation").agg(F.count("*").alias("collections")), with_views("bronze", body=", h AS (SELECT DISTINCT ems, cell_name, date_trunc('hour', period_start) AS h FROM bronze), k AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{x[0]}')" for k, x in BROKEN.items()) + ") t(k, violation)) SELECT violation, count(*) AS collections FROM h JOIN k ON substr(cell_name, 2)::INT % 12 = k GROUP BY 1"))


def _profile(v: Views):
    path = pm_files(v)
    return files.corpus_profile(files.file_ledger(v.spark, path).filter(F.col("file_name").contains(".txt")), files.read_pm_xml(v.spark, path)).select("kind", "values", "counters")


register("a12_corpus_profile", _profile, with_views("bronze", body=f", {_PM} SELECT 'p' AS kind, count(*) AS values, count(DISTINCT counter) AS counters FROM pm"))
register("a13_layer_sizes", lambda v: files.layer_sizes(v.spark, {"orders": f"{v.sf_dir}/orders.parquet", "events": f"{v.sf_dir}/events.parquet"}).select("layer", "rows"), "SELECT 'orders' AS layer, count(*) AS rows FROM orders UNION ALL SELECT 'events', count(*) FROM events")


def _stream(v: Views):
    """The bronze table of this run as a stream of its files."""
    path = bronze_table(v, by_day=True)
    return ingest.pick_up(v.spark, path, v.spark.read.parquet(path).schema, files_per_batch=64)


_VALUES = [*_KEYS, "value", "arrival_time"]


def _merged(v: Views):
    out = scratch_path(v.spark, "silver")
    ingest.run_once(_stream(v).drop("day"), ingest.merge_batches(out, _KEYS), scratch_path(v.spark, "ckpt"))
    return v.spark.read.parquet(out)


register("j01_pick_up_and_merge", lambda v: rounded(_merged(v).select(*_VALUES), 6), with_views("bronze", body=f", {_NEWEST} SELECT ems, cell_name, counter, period_start, round(value, 6) AS value, arrival_time FROM newest"))


def _late(v: Views):
    """The newest half first, then the older rows, then the newest again."""
    out = scratch_path(v.spark, "silver")
    each, rows = ingest.merge_batches(out, _KEYS), _arrivals(v).select(*_RAW, "row_id")
    for i, half in enumerate(("row_id % 3 <> 0", "row_id % 3 = 0", "row_id % 3 <> 0")):
        each(rows.filter(half).drop("row_id"), i)
    return v.spark.read.parquet(out)


register("j05_late_rows_merge", lambda v: rounded(_late(v).select(*_VALUES), 6), with_views("bronze", body=f", {_NEWEST} SELECT ems, cell_name, counter, period_start, round(value, 6) AS value, arrival_time FROM newest"))


def _collected(v: Views, stream):
    out = scratch_path(v.spark, "stream")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(v.spark, "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return v.spark.read.schema(stream.schema).parquet(out)


def _loads(v: Views) -> ingest.Loads:
    return ingest.Loads(scratch_path(v.spark, "loads"), ["ems", "file_name", "file_hash"])


def _deduplicated(v: Views):
    """Each delivery of a file once, through a stream whose last batches are run twice."""
    path, out, loads = scratch_path(v.spark, "deliveries"), scratch_path(v.spark, "taken"), _loads(v)
    v.deliveries().select("ems", "file_name", "file_hash", "arrival_time").repartition(12).write.parquet(path)
    each = loads.only_new(lambda rows, i: rows.select("ems", "file_name", "file_hash").write.mode("overwrite").parquet(f"{out}/batch={i}"))

    def twice(batch, i):
        each(batch, i)
        each(batch, i)

    ingest.run_once(ingest.pick_up(v.spark, path, v.spark.read.parquet(path).schema, files_per_batch=3), twice, scratch_path(v.spark, "ckpt"))
    return v.spark.read.parquet(out).drop("batch"), loads


register("j02_deduplicated", lambda v: _deduplicated(v)[0], with_views("deliveries", body="SELECT DISTINCT ems, file_name, file_hash FROM deliveries"))
register("j07_load_log", lambda v: _deduplicated(v)[1].log(v.spark).agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), (F.count("*") == F.count_distinct("batch")).alias("each_once")), with_views("deliveries", body="SELECT count(DISTINCT (ems, file_name, file_hash)) AS rows, count(DISTINCT (ems, file_name, file_hash)) AS keys, true AS each_once FROM deliveries"))


def _windows(v: Views, width: str):
    path = bronze_table(v)
    s = ingest.pick_up(v.spark, path, v.spark.read.parquet(path).schema, files_per_batch=1000).withColumn("t", F.col("period_start").cast("timestamp"))
    return rounded(_ntz(_collected(v, ingest.tumbling(s, "t", width, ["ems"], "value"))).filter(F.col("end") <= F.lit(datetime(2024, 1, 28))), 4)


_WIN = "SELECT {0} AS start, {0} + {1} AS \"end\", ems, count(*) AS n, round(sum(value), 4) AS total FROM bronze WHERE {0} + {1} <= TIMESTAMP '2024-01-28' GROUP BY 1, 2, 3"
register("j03_closed_days", lambda v: _windows(v, "1 day"), with_views("bronze", body=_WIN.format("date_trunc('day', period_start)::TIMESTAMP", "INTERVAL 1 DAY")))
register("j04_tumbling_hour", lambda v: _windows(v, "1 hour"), with_views("bronze", body=_WIN.format("date_trunc('hour', period_start)::TIMESTAMP", "INTERVAL 1 HOUR")))


def _quarters(v: Views):
    """Quarters of an hour of a stream whose rows come up to two days late, in many batches:
    the rows are written by their arrival, so each batch brings rows of many windows."""
    path, out = scratch_path(v.spark, "bronze"), scratch_path(v.spark, "windows")
    _arrivals(v, by_day=False).select(*_RAW).repartitionByRange(16, "arrival_time").write.parquet(path)
    s = ingest.pick_up(v.spark, path, v.spark.read.parquet(path).schema, files_per_batch=2).withColumn("t", F.col("period_start").cast("timestamp"))
    ingest.run_once(s, ingest.merge_windows(out, "t", "15 minutes", ["ems"], "value"), scratch_path(v.spark, "ckpt"))
    return rounded(_ntz(ingest.merged_windows(v.spark, out, ["ems"])), 4)


register("j04_tumbling_quarter", _quarters, with_views("bronze", body="SELECT period_start AS start, period_start + INTERVAL 15 MINUTE AS \"end\", ems, count(*) AS n, round(sum(value), 4) AS total, period_start + INTERVAL 45 MINUTE <= (SELECT max(period_start) FROM bronze) AS closed FROM bronze GROUP BY period_start, ems"))


def _rebuilt(v: Views):
    silver, gold = scratch_path(v.spark, "silver"), scratch_path(v.spark, "gold")
    build = lambda rows: rows.groupBy("cell_name", (F.col("period_start") + F.expr("interval 7 hours")).cast("date").alias("period")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    ingest.run_once(_stream(v).drop("day"), ingest.rebuild_touched(silver, gold, build, _KEYS), scratch_path(v.spark, "ckpt"))
    return v.spark.read.parquet(gold).select("cell_name", "period", "n", "total")


register("j06_rebuild_touched", lambda v: rounded(_rebuilt(v), 4), with_views("bronze", body=f", {_NEWEST} SELECT cell_name, (period_start + INTERVAL 7 HOUR)::DATE AS period, count(*) AS n, round(sum(value), 4) AS total FROM newest GROUP BY 1, 2"))


def _progress(v: Views):
    log = ingest.ProgressLog(v.spark, scratch_path(v.spark, "progress"))
    stream = ingest.observed(_stream(v).drop("day"), "arrival_time")
    ingest.run_once(stream, lambda batch, i: batch.write.format("noop").mode("overwrite").save(), scratch_path(v.spark, "ckpt"), log)
    return log.table()


register("j08_progress", lambda v: _progress(v).agg(F.sum("rows").alias("rows"), (F.count_distinct("batch") == F.count("*")).alias("each_once"), F.max(F.col("latest").cast("timestamp_ntz")).alias("latest")), with_views("bronze", body=f", {_NEWEST} SELECT count(*) AS rows, true AS each_once, max(arrival_time) AS latest FROM arrived"))


def _retained(v: Views):
    """A file for each day is picked up and archived; three days after the newest one began,
    retention deletes what ended before, archived or not.  What is left, by day."""
    path, archive = scratch_path(v.spark, "landing"), scratch_path(v.spark, "archive")
    rows = v.bronze().select("ems", "value", F.col("ts").cast("date").alias("day"))
    rows.repartition("day").write.partitionBy("day").parquet(path)
    stream = ingest.pick_up(v.spark, path, v.spark.read.parquet(path).schema, files_per_batch=4, archive=archive)
    ingest.run_once(stream, lambda batch, i: batch.write.format("noop").mode("overwrite").save(), scratch_path(v.spark, "ckpt"))
    newest, out = rows.agg(F.max("day")).first()[0], v.spark.createDataFrame([], "day date, n long")
    for place in (path, ingest.archived(v.spark, archive, path)):
        ingest.expire(v.spark, place, datetime.combine(newest, datetime.min.time()))
        if ingest.partitions(v.spark, place):
            out = out.unionByName(v.spark.read.parquet(place).groupBy("day").agg(F.count("*").alias("n")))
    return out.groupBy("day").agg(F.sum("n").alias("n"))


register("j09_retention", _retained, with_views("bronze", body="SELECT ts::DATE AS day, count(*) AS n FROM bronze WHERE ts::DATE >= (SELECT max(ts)::DATE FROM bronze) - 3 GROUP BY 1"))


def _twice(v: Views):
    out = scratch_path(v.spark, "silver")
    each = ingest.merge_batches(out, ["cell_name", "period_start"], version=["value"])
    rows = v.bronze().groupBy("cell_name", "period_start").agg(F.sum("value").alias("value"))
    each(rows, 0)
    each(rows, 0)
    return v.spark.read.parquet(out)


register("j07_idempotent_batch", lambda v: rounded(_twice(v).agg(F.count("*").alias("n"), F.sum("value").alias("total")), 2), with_views("bronze", body="SELECT count(*) AS n, round(sum(value), 2) AS total FROM (SELECT cell_name, period_start, sum(value) AS value FROM bronze GROUP BY 1, 2)"))
register("j09_visible_files", lambda v: ingest.visible_files(v.deliveries(), datetime(1997, 1, 1)).groupBy("ems").agg(F.count("*").alias("n")), with_views("deliveries", body="SELECT ems, count(*) AS n FROM deliveries WHERE arrival_time > TIMESTAMP '1996-12-29' GROUP BY 1"))
