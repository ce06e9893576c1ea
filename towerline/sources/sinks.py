"""Writers of lake tables on Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import scratch_path

DAY = "day"


def with_day(df: DataFrame, time: str = "period_start") -> DataFrame:
    """The partition column of all day-partitioned tables."""
    return df.withColumn(DAY, F.col(time).cast("date"))


def append_bronze(df: DataFrame, path: str, columns: list[str], time: str = "period_start") -> None:
    """Append only; columns are checked and put in order first."""
    missing = [c for c in columns if c not in df.columns]
    extra = [c for c in df.columns if c not in columns]
    if missing or extra:
        raise ValueError(f"columns missing {missing}, not known {extra}")
    with_day(df.select(*columns), time).repartition(DAY).write.mode("append").partitionBy(DAY).parquet(path)


def replace_days(df: DataFrame, path: str, time: str = "period_start") -> None:
    """Overwrite just the days that the rows touch."""
    with_day(df, time).repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def upsert_days(spark: SparkSession, path: str, source: DataFrame, keys: list[str], time: str = "period_start", version: Sequence[str] = ()) -> None:
    """Keyed upsert that reads and rewrites only the day partitions that the source touches.
    With version columns, the row with the greatest of them stays, of the source's and the
    table's alike.

    Days are overwritten dynamically: Spark writes all new files aside and puts them in the
    place of the old days when the job commits, so what is read is there until then and
    each row is written once."""
    from ..operators.quality import newest, upsert

    staged = with_day(source, time)
    days = staged.select(DAY).distinct()
    try:
        old = spark.read.parquet(path).join(F.broadcast(days), DAY, "left_semi").select(*staged.columns)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = staged.limit(0)
    rows = newest(old.unionByName(staged), keys, version) if version else upsert(old, staged, keys)
    rows.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def export_sample(tables: dict[str, DataFrame], out: str, cap_bytes: int = 50_000_000) -> DataFrame:
    """Small tables as one Parquet file each, and a manifest (table, rows, bytes, sha256).
    An empty table, or more than the cap, is an error; both are found on a first copy, which
    Spark writes in as many parts as it likes, before any table goes into one file."""
    spark = next(iter(tables.values())).sparkSession
    rows, total = [], 0
    for name, df in tables.items():
        first = scratch_path(spark, "sample")
        df.write.parquet(first)
        part = spark.read.schema(df.schema).parquet(first).groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.max("_metadata.file_size").alias("size"))
        got = part.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
        if not got["n"]:
            raise ValueError(f"{name} is empty")
        total += got["size"]
        if total > cap_bytes:
            raise ValueError(f"more than {cap_bytes} bytes")
        rows.append((name, got["n"], first))
    for name, _, first in rows:
        spark.read.schema(tables[name].schema).parquet(first).coalesce(1).write.mode("overwrite").parquet(f"{out}/{name}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(out)
    per = files.select(F.element_at(F.split("path", "/"), -2).alias("table"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    manifest = spark.createDataFrame([r[:2] for r in rows], "table string, rows long").join(per, "table")
    return manifest
