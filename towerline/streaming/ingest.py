"""Structured Streaming: continuous pickup, closing windows, and late data by merge."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.clock import report_day
from ..sources.sinks import DAY, replace_days, upsert_days

GRACE = "30 minutes"


def pick_up(spark: SparkSession, path: str, schema, *, form: str = "parquet", files_per_batch: int = 100, archive: str | None = None, **options) -> DataFrame:
    """Each new file of a folder once (the checkpoint remembers them).  With an archive,
    Spark moves a file there, under its own path, when a later batch begins; ``expire``
    deletes what is too old in it."""
    if archive is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).load(path)


def deduplicated(stream: DataFrame, keys: list[str], time: str, delay: str = GRACE) -> DataFrame:
    """First row of each key within the grace time; older keys leave the state.  Where keys
    may come again at any time, use ``Loads``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, time: str, width: str, by: list[str], value: str, delay: str = GRACE) -> DataFrame:
    """Counts and sums of windows; a window comes out when the watermark has passed it."""
    return (
        stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n", "total")
    )


def closed_days(stream: DataFrame, time: str, by: list[str], value: str) -> DataFrame:
    """Days, each once it is over by the grace time."""
    return tumbling(stream, time, "1 day", by, value)


VERSION = ("arrival_time", "file_hash")


def merge_batches(path: str, keys: list[str], time: str = "period_start", version: Sequence[str] = VERSION) -> Callable[[DataFrame, int], None]:
    """foreachBatch: of the rows of a key, in the batch and in the table, the one of the
    newest version stays, however late it or an older one comes; rerunning a batch changes
    nothing, since the merge is keyed."""

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_days(batch.sparkSession, path, batch, keys, time, version)

    return run


def rebuild_touched(silver: str, gold: str, build: Callable[[DataFrame], DataFrame], keys: list[str], time: str = "period_start", version: Sequence[str] = VERSION) -> Callable[[DataFrame, int], None]:
    """foreachBatch: merge into silver, then rebuild the reporting days that the batch
    touches out of all of silver's rows of those days.  Only the UTC day partitions in
    which those reporting days lie are read."""
    merge = merge_batches(silver, keys, time, version)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        merge(batch, batch_id)
        days = batch.select(report_day(F.col(time)).alias("d")).distinct()
        parts = days.select(F.explode(F.array(F.col("d"), F.date_sub("d", 1))).alias(DAY)).distinct()
        rows = batch.sparkSession.read.parquet(silver).join(F.broadcast(parts), DAY, "left_semi")
        touched = rows.withColumn("d", report_day(F.col(time))).join(F.broadcast(days), "d", "left_semi").drop("d")
        replace_days(build(touched), gold, "period")
        batch.unpersist()

    return run


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


LOG = "batch bigint, rows bigint, keys bigint, committed timestamp"


class Loads:
    """A ledger of what has been taken and a log of the batches that took it, in one folder.

    A batch first leaves out the keys that committed batches have taken, hands the rest on,
    writes its keys to the ledger under its own number, and then its line of the log.  So a
    batch that is run again after its line was written does nothing; one that broke off
    before finds only the keys of others in the ledger, and overwrites its own.  No key is
    kept in the state of the stream."""

    def __init__(self, path: str, keys: Sequence[str]):
        self.path, self.keys = path, list(keys)

    def log(self, spark: SparkSession) -> DataFrame:
        """batch, rows, keys, committed: a line for each committed batch."""
        return _read(spark, f"{self.path}/log", LOG)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """The keys taken, with the batch that took each."""
        schema = ", ".join([f"`{k}` string" for k in self.keys] + ["batch bigint"])
        taken = _read(spark, f"{self.path}/ledger", schema)
        return taken.join(self.log(spark).select("batch"), "batch", "left_semi")

    def only_new(self, each: Callable[[DataFrame, int], None], first: bool = True) -> Callable[[DataFrame, int], None]:
        """foreachBatch: each(rows of keys not taken before, batch id).  first: one row of a
        key goes on (as where a row is a file); else all of its rows in the batch do."""

        def run(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            if self.log(spark).filter(F.col("batch") == batch_id).limit(1).count():
                return
            named = batch
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(f"b.{k}").cast("string").eqNullSafe(F.col(f"t.{k}"))
            taken = self.ledger(spark).select(*self.keys)
            new = named.alias("b").join(taken.alias("t"), same, "left_anti")
            new = (new.dropDuplicates(self.keys) if first else new).persist()
            try:
                each(new, batch_id)
                mine = new.select(*[F.col(k).cast("string").alias(k) for k in self.keys])
                mine = mine if first else mine.distinct()
                mine.write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch_id}")
                keys = F.count("*") if first else F.count_distinct(F.struct(*self.keys))
                done = new.agg(F.count("*").alias("rows"), keys.alias("keys"))
                done.select("rows", "keys", F.current_timestamp().alias("committed")).write.mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")
            finally:
                new.unpersist()

        return run


def merge_windows(path: str, time: str, width: str, by: list[str], value: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch: what a batch adds to tumbling windows, as a table partition under the
    batch's number; run again it is overwritten.  Late rows are added, however late."""

    def run(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(time).alias("latest"))
        part.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total", "latest").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def merged_windows(spark: SparkSession, path: str, by: list[str], delay: str = GRACE) -> DataFrame:
    """start, end, by, n, total, closed: whether the newest row is past the window's end by
    the grace time."""
    parts = spark.read.parquet(path)
    newest = parts.agg((F.max("latest") - F.expr(f"interval {delay}")).alias("__until"))
    sums = parts.groupBy("start", "end", *by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return sums.crossJoin(F.broadcast(newest)).withColumn("closed", F.col("end") <= F.col("__until")).drop("__until")


PROGRESS = "query string, batch long, rows long, latest string, at string"


class ProgressLog(StreamingQueryListener):
    """Writes a row for each progress report of a session's streams to a table, some at a
    time, so that no report is lost however long a stream runs.  ``rows`` and ``latest``
    come from the metrics that ``observed`` adds, else from Spark's own count."""

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.lock, self.ended = threading.Lock(), threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        seen = p.get("observedMetrics", {}).get("progress", {})
        with self.lock:
            self.held.append((p["runId"], p["batchId"], seen.get("rows", p.get("numInputRows", 0)), str(seen["latest"]) if seen.get("latest") is not None else None, p["timestamp"]))
            if len(self.held) >= self.every:
                self.flush()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.flush()
        self.ended.set()

    def flush(self) -> None:
        if self.held:
            self.spark.createDataFrame(self.held, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self.held = []

    def table(self) -> DataFrame:
        """query, batch, rows, latest, at: the last report of each batch."""
        rows = _read(self.spark, self.path, PROGRESS)
        return rows.groupBy("query", "batch").agg(F.max("rows").alias("rows"), F.max("latest").alias("latest"), F.max("at").alias("at"))


def observed(stream: DataFrame, time: str | None = None) -> DataFrame:
    """The stream with metrics for ``ProgressLog``: rows and, of a time column, the latest."""
    return stream.observe("progress", F.count(F.lit(1)).alias("rows"), *([F.max(time).cast("string").alias("latest")] if time else []))


def run_once(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, progress: ProgressLog | None = None, timeout: float = 120.0):
    """Take all that is there, in batches, and stop.  With a progress log, all reports are in
    its table on return (they come in a thread of their own)."""
    if progress is not None:
        stream.sparkSession.streams.addListener(progress)
    try:
        q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if progress is not None and not progress.ended.wait(timeout):
            raise TimeoutError("the end of the stream was not reported")
    finally:
        if progress is not None:
            stream.sparkSession.streams.removeListener(progress)
    return q


def partitions(spark: SparkSession, path: str, column: str = DAY) -> dict[date, str]:
    """The days of a folder (``column=yyyy-mm-dd``) and where each lies, by one listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    return {date.fromisoformat(f.getPath().getName().split("=", 1)[1]): f.getPath().toString() for f in found}


def archived(spark: SparkSession, archive: str, path: str) -> str:
    """Where Spark puts the files of a folder in an archive."""
    return archive + spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def expire(spark: SparkSession, path: str, now: datetime, days: int = 3, column: str = DAY) -> list[date]:
    """Deletes the partitions of a folder that retention no longer keeps: those that ended
    `days` days before `now`.  Returns the days."""
    gone = {d: p for d, p in partitions(spark, path, column).items() if datetime.combine(d + timedelta(days=1), datetime.min.time()) <= now - timedelta(days=days)}
    for place in gone.values():
        target = spark._jvm.org.apache.hadoop.fs.Path(place)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return sorted(gone)


def visible_files(ledger: DataFrame, now: datetime, days: int = 3) -> DataFrame:
    """Deliveries that retention keeps visible."""
    return ledger.filter(F.col("arrival_time") > F.lit(now) - F.expr(f"interval {days} days"))


__all__ = [
    "Loads", "ProgressLog", "archived", "closed_days", "deduplicated", "expire", "merge_batches", "merge_windows", "merged_windows", "observed", "partitions", "pick_up", "rebuild_touched", "run_once", "tumbling", "visible_files",
]
