"""Tables in versions: failures before the swap, rival writers, late rows and final windows."""

import os
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.session import work_folder
from fieldmark.sources import versions
from fieldmark.sources.versions import read_table, remove_old, replace_cells
from fieldmark.streaming import arrivals
from tests.conftest import rows_of

ROW = "k INT, day STRING, v DOUBLE"


def local(path):
    return path.removeprefix("file://")


def data_files(path):
    return {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(local(path) + "/data") for f in names if f.endswith(".parquet")}


def test_only_touched_cells_are_written(spark, frame):
    path = work_folder(spark, "t")
    assert replace_cells(frame([(1, "d1", 1.0), (2, "d2", 2.0), (3, None, 3.0), (4, "", 4.0)], ROW), path, "day") == 1
    before = data_files(path)
    assert arrivals.upsert_partitions(frame([(2, "d2", 5.0), (9, "d3", 9.0), (3, None, 7.0)], ROW), path, ["k"], "day") == 2
    after = data_files(path)
    assert all(after[f] == t for f, t in before.items())
    assert rows_of(read_table(spark, path)) == rows_of(frame([(1, "d1", 1.0), (2, "d2", 5.0), (3, None, 7.0), (4, "", 4.0), (9, "d3", 9.0)], ROW))
    assert rows_of(read_table(spark, path, 1), "v") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    assert read_table(spark, path).columns == ["k", "day", "v"]
    # The plan reads the folders that the manifest names.
    assert "dynamicpruning" in read_table(spark, path)._jdf.queryExecution().toString().lower()


def test_failure_before_the_swap_loses_nothing(spark, frame, monkeypatch):
    path = work_folder(spark, "t")
    first = frame([(1, "d1", 1.0), (2, "d1", 2.0)], ROW)
    second = frame([(2, "d1", 20.0), (3, "d2", 3.0)], ROW)
    arrivals.upsert_partitions(first, path, ["k"], "day")

    def broken(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_swap", broken)
        with pytest.raises(RuntimeError):
            arrivals.upsert_partitions(second, path, ["k"], "day")
    assert rows_of(read_table(spark, path)) == rows_of(first)

    def torn(frame, *_, **__):
        raise RuntimeError("an executor took the job with it")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_cells", torn)
        with pytest.raises(RuntimeError):
            arrivals.upsert_partitions(second, path, ["k"], "day")
    assert rows_of(read_table(spark, path)) == rows_of(first)
    for number in (2, 3):  # run again, and once more
        assert arrivals.upsert_partitions(second, path, ["k"], "day") == number
        assert rows_of(read_table(spark, path), "k", "v") == [(1, 1.0), (2, 20.0), (3, 3.0)]
    remove_old(spark, path, keep=1)
    assert versions.versions(spark, path) == [3]
    assert rows_of(read_table(spark, path), "k", "v") == [(1, 1.0), (2, 20.0), (3, 3.0)]
    assert len(os.listdir(local(path) + "/data")) == 1
    with pytest.raises(LookupError):
        read_table(spark, path, 1)


def test_of_two_writers_one_fails(spark, frame, monkeypatch):
    path = work_folder(spark, "t")
    arrivals.upsert_partitions(frame([(1, "d1", 1.0)], ROW), path, ["k"], "day")
    swap = versions._swap

    def late(spark, path, hidden, number):
        monkeypatch.setattr(versions, "_swap", swap)
        arrivals.upsert_partitions(frame([(5, "d5", 5.0)], ROW), path, ["k"], "day")
        swap(spark, path, hidden, number)

    monkeypatch.setattr(versions, "_swap", late)
    with pytest.raises(versions.ConcurrentWrite):
        arrivals.upsert_partitions(frame([(2, "d1", 2.0)], ROW), path, ["k"], "day")
    assert rows_of(read_table(spark, path), "k") == [(1,), (5,)]


def test_cells_that_lose_all_rows_are_gone(spark, frame):
    path = work_folder(spark, "t")
    replace_cells(frame([(1, "d1", 1.0), (2, "d2", 2.0)], ROW), path, "day")
    replace_cells(frame([(1, "d1", 1.0)], ROW), path, "day", lambda stored, rows: stored.join(rows, "k", "left_anti").select(*rows.columns))
    assert rows_of(read_table(spark, path), "k") == [(2,)]


def test_nothing_to_write(spark, frame):
    path = work_folder(spark, "t")
    assert replace_cells(frame([], ROW), path, "day") == 0
    with pytest.raises(LookupError):
        read_table(spark, path)
    replace_cells(frame([(1, "d1", 1.0)], ROW), path, "day")
    assert replace_cells(frame([], ROW), path, "day") == 1


EVENT = "k INT, t TIMESTAMP, v DOUBLE"


def test_windows_are_final_and_late_rows_counted(spark):
    """Files come in falling order of time.  A batch is held against the watermark before the last one."""
    times = [dt(2024, 1, 1, h, m) for h in (9, 8, 7) for m in (0, 5, 20, 50)]
    parts = [times[:4], times[4:8], times[8:]]
    source, base = work_folder(spark, "t"), work_folder(spark, "t")
    rows = lambda part: spark.createDataFrame([(1, x, 1.0) for x in part], EVENT)
    for part in parts:
        rows(part).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
        arrivals.final_windows(arrivals.tumbling_means(stream, "t", ["k"], "v", late="20 minutes"), f"{base}/w", f"{base}/state").awaitTermination()
        return spark.read.parquet(f"{base}/w")

    first = rows_of(run(), "window_start", "n")
    assert first == [(dt(2024, 1, 1, h, m), n) for h, m, n in ((8, 0, 2), (8, 15, 1), (8, 45, 1), (9, 0, 2), (9, 15, 1))]
    files = {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(local(base) + "/w") for f in names if f.endswith(".parquet")}
    rows([dt(2024, 1, 1, 9, 1), dt(2024, 1, 1, 12, 0), dt(2024, 1, 1, 12, 30)]).coalesce(1).write.mode("append").parquet(source)
    windows = run()
    assert rows_of(windows, "window_start", "n") == [*first, (dt(2024, 1, 1, 9, 45), 1)]
    now = {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(local(base) + "/w") for f in names if f.endswith(".parquet")}
    assert all(now[f] == t for f, t in files.items())
    late = arrivals.late_rows(spark.read.schema(EVENT).parquet(source), windows, "t", ["k"], "v")
    assert rows_of(late, "window_start", "n_late") == [(dt(2024, 1, 1, h, m), n) for h, m, n in ((7, 0, 2), (7, 15, 1), (7, 45, 1), (9, 0, 1))]
    whole = rows_of(spark.read.schema(EVENT).parquet(source).agg(F.count("v")))
    assert whole == [(15,)]
