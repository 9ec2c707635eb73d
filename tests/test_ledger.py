"""Exports run again: only missing and changed days are written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareline import schemas
from fareline.operators.bounds import day_bounds
from fareline.plans import ledger
from fareline.sources import sinks
from fareline.sources.scans import read_text

T0 = dt.datetime(2024, 3, 1)


def _treatments(frame, hours, price=1.0):
    rows = [(k, T0 + dt.timedelta(hours=h), price, f"b{k}\nx") for k, h in enumerate(hours)]
    return frame("TreatmentID long, LoggedUTC timestamp_ntz, TotalItineraryPrice double, ExternalBookingID string", *rows)


def _files(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return {(r.path, r.modificationTime) for r in files.select("path", "modificationTime").collect() if "export=" in r.path}


@pytest.fixture
def days(frame):
    def build(log, n=4):
        return day_bounds(log, "TreatmentID", "LoggedUTC", T0.date(), T0.date() + dt.timedelta(days=n - 1))

    return build


def test_only_missing_and_changed_days_are_written(spark, frame, path, days, monkeypatch):
    root = path("root")
    log = _treatments(frame, [1, 2, 30, 31, 80])  # the third day has no rows
    fixed = days(log).cache()
    run = lambda rows, when=fixed, **how: ledger.export_changed({"Treatment": rows}, "Treatment", when, root, **how)
    first = run(log)
    assert len(first) == 4 and all(n.startswith("Treatment_2024-03-0") for n in first)
    before = _files(spark, root)
    assert run(log) == [] and run(log.repartition(3)) == [] and _files(spark, root) == before

    # Another price on the second day alone: its folder is replaced, the others stay.
    changed = log.withColumn("TotalItineraryPrice", F.when(F.col("TreatmentID") == 3, 9.0).otherwise(1.0))
    assert run(changed) == [first[1]]
    after = _files(spark, root)
    assert {p for p, _ in before & after} == {p for p, _ in before if first[1] not in p}
    rows = read_text(spark, f"{root}/Treatment", schemas.struct_of("Treatment"))
    assert rows.count() == 5 and rows.where("TotalItineraryPrice = 9").count() == 1

    # A run that is cut off before the ledger is written does the same day again.
    def cut_off(*_, **__):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(ledger, "write_missing_headers", cut_off)
        with pytest.raises(RuntimeError):
            run(log)
    assert run(log) == [first[1]]

    # A folder that is gone is written again; a day that loses its rows becomes a header.
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/Treatment/export={first[0]}")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    assert run(log) == [first[0]]
    assert run(log.where("TreatmentID < 4")) == [first[3]]
    assert sinks.written_values(spark, f"{root}/Treatment") == set(first)
    assert read_text(spark, f"{root}/Treatment", schemas.struct_of("Treatment")).count() == 4
    entries = {r.export: r.rows for r in ledger.read_ledger(spark, root).collect()}
    assert entries == dict(zip(first, [2, 2, 0, 0], strict=True))


def test_other_settings_and_other_bounds_are_other_extracts(spark, frame, path, days):
    root = path("root")
    log = _treatments(frame, [1, 30])
    assert len(ledger.export_changed({"Treatment": log}, "Treatment", days(log, 2), root)) == 2
    assert len(ledger.export_changed({"Treatment": log}, "Treatment", days(log, 2), root, exact_nulls=True)) == 2
    more = log.unionByName(_treatments(frame, [50]).withColumn("TreatmentID", F.lit(7).cast("long")))
    assert len(ledger.export_changed({"Treatment": more}, "Treatment", days(more, 3), root, exact_nulls=True)) == 2  # the second has an end now


def test_headers_of_all_empty_days_in_one_write(spark, frame, path):
    at, schema = path("t"), frame('a int, `b;"c` string').schema
    sinks.write_missing_headers(spark, at, ["x", "y", "z"], schema)
    assert sinks.written_values(spark, at) == {"x", "y", "z"}
    lines = {r.value for r in spark.read.text(at).collect()}
    assert lines == {'a;"b;""c"'} and sinks.read_text(spark, at, schema).collect() == []
