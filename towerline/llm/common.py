"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sort key that stands for a null document id where ids must be comparable.
NULL_ID = -(2**63)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else (only where the
    session names none, as in local tests) a fresh temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    found = spark.conf.get("towerline.scratch", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-towerline-", dir="/tmp")
        spark.conf.set("towerline.scratch", found)
    return found


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage at a table in the shared folder, so that a lost executor costs a
    reread and not a recomputation."""
    path = f"{shared_dir(df.sparkSession)}/towerline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Let rows with whole texts go to Python workers in batches of ``BATCH_BYTES`` at most
    (a setting of the session), so that what a worker holds does not grow with the texts."""
    now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    if now is None or not now.isdigit() or int(now) > BATCH_BYTES or int(now) <= 0:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def lean_worker() -> Iterator[None]:
    """A Python worker serves many tasks.  Inside this block it hands freed memory back to the
    system at once, and what is left when the block ends, so that a stage does not begin with
    what an earlier one held.  Where the C library has no such calls, nothing changes."""
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 2 << 20)  # M_MMAP_THRESHOLD: larger arrays are given back when freed
        libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
    try:
        yield
    finally:
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)


def id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ID))


def row_keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, rid, rth): rows of one id stay apart through the hash of their text."""
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).select(
        "doc_id", "text", id_key(F.col("doc_id")).alias("rid"), F.xxhash64("text").alias("rth")
    )


def fraction_kept(total: float, wanted: float) -> float:
    return 1.0 if total <= wanted else wanted / total


def hash_unit(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    h = F.xxhash64(*cols, F.lit(seed))
    return F.shiftrightunsigned(h, 11) / F.lit(float(2**53))


def crc_mod(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
