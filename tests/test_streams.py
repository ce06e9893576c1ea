"""Streams: replayed and broken batches, late rows, progress of many batches, retention."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from towerline.streaming import ingest

FILES = "ems string, file_name string, file_hash string, rows int"


def deliveries(spark, *rows):
    return spark.createDataFrame([(e, n, h, i) for i, (e, n, h) in enumerate(rows)], FILES)


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    loads, taken = ingest.Loads(str(tmp_path / "loads"), ["ems", "file_name", "file_hash"]), []
    each = loads.only_new(lambda rows, i: taken.append((i, {tuple(r)[:3] for r in rows.collect()})))
    first, second = deliveries(spark, ("e", "a", "1"), ("e", "a", "1"), ("f", "a", "1")), deliveries(spark, ("e", "a", "1"), ("e", "a", "2"), ("e", None, "3"))
    for batch, i in ((first, 0), (first, 0), (second, 1), (second, 1), (first, 0), (second, 2)):
        each(batch, i)
    assert taken == [(0, {("e", "a", "1"), ("f", "a", "1")}), (1, {("e", "a", "2"), ("e", None, "3")}), (2, set())]
    log = {r["batch"]: (r["rows"], r["keys"]) for r in loads.log(spark).collect()}
    assert log == {0: (2, 2), 1: (2, 2), 2: (0, 0)} and loads.ledger(spark).count() == 4


def test_a_batch_that_broke_off_is_taken_whole(spark, tmp_path):
    loads, out = ingest.Loads(str(tmp_path / "loads"), ["ems", "file_name", "file_hash"]), []
    batch = deliveries(spark, ("e", "a", "1"), ("e", "b", "1"))

    def fails(rows, i):
        out.append(rows.count())
        raise OSError("lost")

    with pytest.raises(OSError):
        loads.only_new(fails)(batch, 0)
    # as if it had broken off between the ledger and the log
    batch.select("ems", "file_name", "file_hash").write.parquet(f"{loads.path}/ledger/batch=0")
    assert loads.ledger(spark).count() == 0
    loads.only_new(lambda rows, i: out.append(rows.count()))(batch, 0)
    assert out == [2, 2] and loads.ledger(spark).count() == 2 and loads.log(spark).count() == 1


def test_all_rows_of_new_keys_go_on_if_asked(spark, tmp_path):
    loads, out = ingest.Loads(str(tmp_path / "loads"), ["file_name"]), []
    each = loads.only_new(lambda rows, i: out.append(sorted(r["rows"] for r in rows.collect())), first=False)
    each(deliveries(spark, ("e", "a", "1"), ("e", "a", "2")), 0)
    each(deliveries(spark, ("e", "a", "3"), ("e", "b", "1"), ("e", "b", "2")), 1)
    assert out == [[0, 1], [1, 2]]


def test_late_rows_are_added_to_their_window(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    batch = lambda *rows: spark.createDataFrame([("e", at(m), float(v)) for m, v in rows], "ems string, t timestamp, v double")
    each = ingest.merge_windows(str(tmp_path / "w"), "t", "15 minutes", ["ems"], "v")
    each(batch((0, 1), (14, 2), (15, 4)), 0)
    each(batch((300, 8), (1, 16)), 1)  # five hours later, and a late one
    each(batch((300, 8), (1, 16)), 1)
    got = {r["start"]: (r["n"], r["total"], r["closed"]) for r in ingest.merged_windows(spark, str(tmp_path / "w"), ["ems"]).collect()}
    assert got == {at(0): (3, 19.0, True), at(15): (1, 4.0, True), at(300): (1, 8.0, False)}


def test_progress_of_more_batches_than_a_query_remembers(spark, tmp_path):
    path, n = str(tmp_path / "in"), 150
    spark.range(n * 3).select("id", (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at")).repartitionByRange(n, "id").write.parquet(path)
    files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    log = ingest.ProgressLog(spark, str(tmp_path / "log"), every=40)
    stream = ingest.observed(ingest.pick_up(spark, path, spark.read.parquet(path).schema, files_per_batch=1), "at")
    ingest.run_once(stream, lambda rows, i: rows.write.format("noop").mode("overwrite").save(), str(tmp_path / "ckpt"), log)
    got = log.table().agg(F.count("*"), F.sum("rows"), F.count_distinct("batch"), F.max("latest")).first()
    assert files > 100 and got[0] == got[2] == files and got[1] == n * 3 and got[3].startswith("2024-01-01 07:29")


def test_old_files_go_and_the_ledger_stays(spark, tmp_path):
    landing, archive = f"file://{tmp_path}/landing", f"file://{tmp_path}/archive"
    rows = spark.createDataFrame([("e", f"f{d}", "1", date(2024, 1, d)) for d in range(1, 11)], "ems string, file_name string, file_hash string, day date")
    rows.repartition("day").write.partitionBy("day").parquet(landing)
    loads = ingest.Loads(f"file://{tmp_path}/loads", ["ems", "file_name", "file_hash"])
    stream = ingest.pick_up(spark, landing, rows.schema, files_per_batch=2, archive=archive)
    ingest.run_once(stream, loads.only_new(lambda new, i: new.count()), str(tmp_path / "ckpt"))
    held = ingest.archived(spark, archive, landing)
    assert len(list((tmp_path / "archive").rglob("*.parquet"))) >= 6  # all but those of the last batches
    gone = {d for place in (held, landing) for d in ingest.expire(spark, place, datetime(2024, 1, 10, 12))}
    assert gone == {date(2024, 1, d) for d in range(1, 7)}
    left = {p.parent.name for p in tmp_path.rglob("part-*.parquet") if p.parent.name.startswith("day=")}
    assert left == {f"day=2024-01-{d:02d}" for d in range(7, 11)} and loads.ledger(spark).count() == 10


def test_first_rows_of_keys_are_told_apart_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest.F, "count_distinct", lambda *_: pytest.fail("keys are distinct already"))
    loads, out = ingest.Loads(str(tmp_path / "loads"), ["a", "b"]), []
    each = loads.only_new(lambda rows, i: out.extend(map(tuple, rows.select("a", "b").collect())))
    rows = lambda *r: spark.createDataFrame(r, "a string, b int")
    each(rows(("x", 1), ("x", 1), ("y", None)), 0)
    each(rows(("x", 1), ("y", None), ("z", 2), ("z", 2)), 1)
    each(rows(("w", 3)), 1)
    assert sorted(out, key=str) == [("x", 1), ("y", None), ("z", 2)]
    assert sorted((r["batch"], r["rows"], r["keys"]) for r in loads.log(spark).collect()) == [(0, 2, 2), (1, 1, 1)]
