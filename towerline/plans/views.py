"""Carrier views: the shared tables under the schemas of this library.

Each view is given twice: as a DataFrame for the queries, and as a CTE for their oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import floor_minutes

RENAME_DAY = "2024-01-16"

#: A literal dictionary: (vendor, release, meas_group, counter, rule, target, other, bin, scale, attestation).
ENTRIES = [
    ("A", r, "G", f"{c}_v2" if r == "R2" and c == "click" else c, "copy", m, None, None, s, a)
    for r in ("R1", "R2")
    for c, m, s, a in (
        ("click", "RRC.ConnEstabAtt.sum", 1.0, "standard"), ("view", "RRC.ConnEstabSucc.sum", 1.0, "standard"), ("error", "ERAB.RelActNbr.sum", 1.0, "vendor"),
        ("signup", "ERAB.EstabInitSuccNbr.sum", 1.0, "vendor"), ("purchase", "DRB.IPVolDl.sum", 10.0, "vendor"),
    )
]
ENTRY_SCHEMA = "vendor string, release string, meas_group string, counter string, rule string, target string, other string, bin int, scale double, attestation string"


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def entries(self) -> DataFrame:
        return self.spark.createDataFrame(ENTRIES, ENTRY_SCHEMA)

    def bronze(self) -> DataFrame:
        """Raw counter values: one row for each event."""
        e = self.table("events")
        late = F.col("ts") >= F.lit(RENAME_DAY).cast("timestamp_ntz")
        return e.select(
            F.concat(F.lit("ems"), (F.col("user_id") % 2).cast("string")).alias("ems"), F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("cell_name"),
            floor_minutes(F.col("ts"), 15).alias("period_start"), F.when(late, "R2").otherwise("R1").alias("release"), F.lit("G").alias("meas_group"),
            F.when(late & (F.col("event_type") == "click"), "click_v2").otherwise(F.col("event_type")).alias("counter"), "value",
            (F.regexp_extract("props", r"(\d+)", 1).cast("int") >= 90).alias("suspect"),
            F.concat(F.lit("f"), F.date_format("ts", "yyyyMMddHH")).alias("file_name"), F.col("event_id").alias("row_id"), "ts",
        )

    def deliveries(self) -> DataFrame:
        """File deliveries: orders sent again with each of their lines."""
        li = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return li.select(
            F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.col("l_orderkey").cast("string").alias("file_name"),
            (F.col("l_partkey") % 3).cast("string").alias("file_hash"), F.col("o_orderdate").alias("period_start"),
            (F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_linenumber"))).alias("arrival_time"), (F.col("l_returnflag") != "R").alias("loaded"),
            F.col("l_quantity").cast("long").alias("size"), "l_linenumber",
        )

    def values(self) -> DataFrame:
        """Values under file versions: a version is the hash of the delivery."""
        li = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return li.select(
            F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.col("l_orderkey").cast("string").alias("file_name"),
            (F.col("l_partkey") % 3).cast("string").alias("file_hash"), (F.col("l_suppkey") % 2).alias("k"), F.when(F.col("l_quantity") > 45, None).otherwise(F.col("l_extendedprice")).alias("value"),
        ).groupBy("ems", "file_name", "file_hash", "k").agg(F.max("value").alias("value"))

    def wide(self) -> DataFrame:
        """Wide cell counters of both technologies: one row for each line item."""
        li = self.table("lineitem")
        q, p, d, t = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
        a = F.col("l_suppkey") % 2 == 0
        kept = F.col("l_returnflag") != "R"
        return li.select(
            F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("cell_name"), F.when(a, "A").otherwise("B").alias("vendor"),
            (F.col("l_shipdate") + F.make_dt_interval(mins=15 * F.col("l_linenumber"))).alias("period_start"),
            q.alias("rrc_att"), (q * (1 - d)).alias("rrc_succ"), (q + 1).alias("s1_att"), q.alias("s1_succ"), p.alias("erab_att"), (p * (1 - t)).alias("erab_succ"), (q * d).alias("erab_rel"),
            F.when(a, p).alias("session_s"), p.alias("ip_vol_kbit"), (q * 10).alias("ip_time_ms"), (d * 1000).alias("prb_pct"), (t * 1000).alias("unavail_s"),
            F.when(kept, q).alias("ho_att"), F.when(kept, q * (1 - t)).alias("ho_succ"),
            (q + 5).alias("tch_req"), F.col("l_linenumber").cast("double").alias("tch_blocked"), (q - q * t).alias("tch_succ"), (q + 2).alias("ia_att"), (q + 2 - q * d).alias("ia_succ"),
            (q * t).alias("sdcch_blocked"), F.when(a, q * d * t).alias("sdcch_lost"), (q * t * t).alias("tch_lost"), (q * d * d).alias("ho_unsucc"), (q * 0.5).alias("ho_in"),
            (q * 7).alias("cqi_weighted"), q.alias("cqi_samples"), (F.col("l_linestatus") == "F").alias("reported"), (F.col("l_returnflag") == "A").alias("suspect"),
        )

    def cells(self) -> DataFrame:
        s = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return s.select(
            F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("cell_name"), F.col("n_name").alias("site"), F.element_at(F.array(F.lit("rural"), F.lit("suburban"), F.lit("urban")), (F.col("n_regionkey") % 3 + 1).cast("int")).alias("area"),
            F.when(F.col("s_acctbal") < 0, 25).when(F.col("s_acctbal") < 5000, 50).otherwise(100).alias("n_rb"), F.when(F.col("s_suppkey") % 3 == 0, "GSM").otherwise("LTE").alias("technology"),
        )

    def place(self, table: str, key: str, name: str) -> DataFrame:
        """Keys with places on a plane of 100 by 100 km."""
        k = F.col(key)
        return self.table(table).select(k.alias(name), ((k * 37) % 1000 / 10.0).alias("x"), ((k * 91) % 1000 / 10.0).alias("y"), "*")

    def cm(self) -> DataFrame:
        """Configuration snapshots: orders of a customer."""
        return self.table("orders").select(
            F.concat(F.lit("ems"), (F.col("o_custkey") % 2).cast("string")).alias("ems"), F.concat(F.lit("dn"), F.col("o_custkey").cast("string")).alias("dn"), F.col("o_orderdate").alias("time"),
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("label"),
        )


SQL = {
    "bronze": f"""bronze AS (SELECT 'ems' || (user_id % 2) AS ems, 'c' || user_id AS cell_name, time_bucket(INTERVAL '15 minutes', ts) AS period_start,
  CASE WHEN ts >= TIMESTAMP '{RENAME_DAY}' THEN 'R2' ELSE 'R1' END AS release, 'G' AS meas_group,
  CASE WHEN ts >= TIMESTAMP '{RENAME_DAY}' AND event_type = 'click' THEN 'click_v2' ELSE event_type END AS counter, value,
  CAST(regexp_extract(props, '(\\d+)', 1) AS INT) >= 90 AS suspect, 'f' || strftime(ts, '%Y%m%d%H') AS file_name, event_id AS row_id, ts FROM events)""",
    "cmap": "cmap AS (SELECT * FROM (VALUES " + ", ".join(f"('{e[1]}', '{e[3]}', '{e[5]}', {1 / e[8]!r}::DOUBLE, '{e[9]}')" for e in ENTRIES) + ") t(release, counter, measurement, factor, attestation))",
    "deliveries": """deliveries AS (SELECT 'ems' || (o_custkey % 2) AS ems, CAST(l_orderkey AS VARCHAR) AS file_name, CAST(l_partkey % 3 AS VARCHAR) AS file_hash, o_orderdate AS period_start,
  l_shipdate + to_minutes(l_linenumber) AS arrival_time, l_returnflag <> 'R' AS loaded, CAST(l_quantity AS BIGINT) AS size, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "vals": """vals AS (SELECT 'ems' || (o_custkey % 2) AS ems, CAST(l_orderkey AS VARCHAR) AS file_name, CAST(l_partkey % 3 AS VARCHAR) AS file_hash, l_suppkey % 2 AS k,
  max(CASE WHEN l_quantity > 45 THEN NULL ELSE l_extendedprice END) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
    "states": """states AS (SELECT ems, file_name, min(period_start) AS period_start, min(arrival_time) AS first_arrival, count(*) AS deliveries,
  count(DISTINCT file_hash) FILTER (WHERE loaded) AS versions, max({'a': arrival_time, 'h': file_hash}) FILTER (WHERE loaded).h AS latest_hash FROM deliveries GROUP BY ems, file_name)""",
    "wide": """wide AS (SELECT 's' || l_suppkey AS cell_name, CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS vendor, l_shipdate + to_minutes(15 * l_linenumber) AS period_start,
  l_quantity AS rrc_att, l_quantity * (1 - l_discount) AS rrc_succ, l_quantity + 1 AS s1_att, l_quantity AS s1_succ, l_extendedprice AS erab_att, l_extendedprice * (1 - l_tax) AS erab_succ,
  l_quantity * l_discount AS erab_rel, CASE WHEN l_suppkey % 2 = 0 THEN l_extendedprice END AS session_s, l_extendedprice AS ip_vol_kbit, l_quantity * 10 AS ip_time_ms, l_discount * 1000 AS prb_pct,
  l_tax * 1000 AS unavail_s, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS ho_att, CASE WHEN l_returnflag <> 'R' THEN l_quantity * (1 - l_tax) END AS ho_succ,
  l_quantity + 5 AS tch_req, CAST(l_linenumber AS DOUBLE) AS tch_blocked, l_quantity - l_quantity * l_tax AS tch_succ, l_quantity + 2 AS ia_att, l_quantity + 2 - l_quantity * l_discount AS ia_succ,
  l_quantity * l_tax AS sdcch_blocked, CASE WHEN l_suppkey % 2 = 0 THEN l_quantity * l_discount * l_tax END AS sdcch_lost, l_quantity * l_tax * l_tax AS tch_lost,
  l_quantity * l_discount * l_discount AS ho_unsucc, l_quantity * 0.5 AS ho_in, l_quantity * 7 AS cqi_weighted, l_quantity AS cqi_samples, l_linestatus = 'F' AS reported, l_returnflag = 'A' AS suspect FROM lineitem)""",
    "cells": """cells AS (SELECT 's' || s_suppkey AS cell_name, n_name AS site, ['rural', 'suburban', 'urban'][n_regionkey % 3 + 1] AS area,
  CASE WHEN s_acctbal < 0 THEN 25 WHEN s_acctbal < 5000 THEN 50 ELSE 100 END AS n_rb, CASE WHEN s_suppkey % 3 = 0 THEN 'GSM' ELSE 'LTE' END AS technology FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    "cm": """cm AS (SELECT 'ems' || (o_custkey % 2) AS ems, 'dn' || o_custkey AS dn, o_orderdate AS time, o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS label FROM orders)""",
}


def place_sql(table: str, key: str, name: str) -> str:
    return f"(SELECT {key} AS {name}, ({key} * 37) % 1000 / 10.0 AS x, ({key} * 91) % 1000 / 10.0 AS y, * FROM {table})"


def with_views(*names: str, body: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n" + body
