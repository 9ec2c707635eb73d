"""Plans and results that must hold at any size of the tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import io
import random

from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from checks import standins
from fareline.functions import ordered
from fareline.operators import assembly, intervals, journeys
from fareline.plans import maintenance
from fareline.plans.journey_views import RouteStudy
from fareline.session import tune, write_placed
from fareline.sources import sinks


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _flights(frame):
    return {
        "InventoryLeg": frame(
            "InventoryLegID long, STDUTC timestamp_ntz, STAUTC timestamp_ntz, STD timestamp_ntz, STA timestamp_ntz, "
            "FlightNumber string, OperatingFlightNumber string, Status int, CarrierCode string, Capacity int, "
            "AdjustedCapacity int, Lid int, DepartureStation string, ArrivalStation string"
        ),
        "InventoryLegOp": frame("InventoryLegID long, DepartureStatus int"),
        "InventoryLegClass": frame("InventoryLegID long, ClassOfService string, ClassNest int"),
        "InventoryLegNest": frame(
            "InventoryLegID long, ClassNest int, TravelClassCode string, NestType string, Lid string, AdjustedCapacity string"
        ),
        "PassengerJourneyLeg": frame(
            "InventoryLegID long, PassengerID long, SegmentID long, LegNumber int, BookingStatus string, LiftStatus int"
        ),
    }


def test_tables_of_flights_are_not_broadcast_on_an_estimate(spark, frame):
    # Empty tables: the least estimate there is.
    tables = _flights(frame)
    segments = frame("SegmentID long, PassengerID long, ClassOfService string")
    for legs in (assembly.described_legs(tables), assembly.legs_in_class(tables, segments)):
        assert "BroadcastExchange" not in plan(legs)


def test_totals_of_intervals_make_no_pairs(spark, frame):
    at = lambda s, us=0: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s, microseconds=us)
    points = [(k, at(k // 3, k % 3 * 400_000)) for k in range(30_000)] + [(30_000, None)]
    df = spark.createDataFrame(points, "id long, ts timestamp_ntz")
    spans = [(0, at(0), at(20_000)), (1, at(5, 1), at(5, 400_000)), (2, at(7, 500_000), at(9_000, 399_999)), (3, at(50), at(50)),
             (4, at(99), at(98)), (5, at(20_001), at(90_000)), (6, at(-9), at(3_700)), (7, None, at(5)), (8, at(10), at(11)), (9, at(10, 1), at(12))]
    wide = frame("k long, first timestamp_ntz, last timestamp_ntz", *spans, spans[0])
    totals = intervals.totals_in_intervals(df, "ts", wide, "id", "first", "last")
    want = {}
    for k, a, b in [*spans, spans[0]]:
        ids = [i for i, t in points if t and a and a <= t <= b]
        if ids:
            want[k] = (want.get(k, (0,))[0] + len(ids), min(ids), max(ids))
    assert {r.k: (r["rows"], r.lowest, r.highest) for r in totals.collect()} == want


def test_digests_of_groups_hold_no_group_in_a_row(spark, frame):
    rng = random.Random(3)
    data = [(k, i, None if i % 7 == 0 else f"é{i}" * (i % 5)) for k in ("a", "b", None) for i in range(900)] + [("c", 1, None)]
    rng.shuffle(data)
    found = ordered.digest_in_order(frame("k string, o int, v string", *data).repartition(5), ["k"], ["o"], F.col("v"))
    want = {}
    for k in ("a", "b", "c", None):
        own = sorted((o, v) for x, o, v in data if x == k)
        texts = [v for _, v in own if v is not None]
        want[k] = (len(own), hashlib.md5("|".join(texts).encode()).hexdigest() if texts else None)
    assert {r.k: (r.n, r.digest) for r in found.collect()} == want
    for name in ("n12_long_journeys", "a13_large_legs"):
        assert "collect_list" not in plan(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_equal_rows_meet_in_the_sort_of_their_digest(spark, frame):
    rng = random.Random(4)
    data = [(k, i, None if i % 5 == 0 else f"v{i % 3}", "x" if i % 2 else None) for k in ("a", "b", None) for i in range(300)]
    given = data * 3 + [("a", 1, "v1", "y")] * 50
    rng.shuffle(given)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # equal rows lie in several batches
    try:
        df = frame("k string, o int, v string, w string", *given).repartition(5)
        found = {r.k: (r.n, r.digest) for r in ordered.digest_in_order(df, ["k"], ["o", "v"], F.col("v"), distinct=True, rows=3_000).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {}
    for k in ("a", "b", None):
        own = sorted({(o, v or "", w or "") for x, o, v, w in given if x == k})
        want[k] = (len(own), hashlib.md5("|".join(v for _, v, _ in own if v).encode()).hexdigest())
    assert found == want
    long = plan(QUERIES["n12_long_journeys"](spark, "/root/testdata/sf0.001"))
    # Legs are shuffled once, by ranges; what is placed by carrier after it is pages.
    assert long.count("Exchange rangepartitioning") == 1 and "keys=[JourneyKey" not in long
    assert not [line for line in long.splitlines() if "Exchange hashpartitioning(" in line and "SegmentID" in line]


def test_listed_journeys_and_row_ids_shuffle_their_rows_once(spark, frame):
    legs = frame(", ".join(f"{c} string" for c in journeys.JOURNEY_LEG_COLUMNS), ("x",) * len(journeys.JOURNEY_LEG_COLUMNS))
    assert plan(journeys.leg_lists(legs)).count("Exchange hashpartitioning") == 1
    numbered = ordered.number_all_rows(frame("v int", *[(k,) for k in range(500, 0, -1)]), ["v"], "id")
    # What is left is the counts of ranges; the rows are numbered where they stand.
    assert "Exchange hashpartitioning(__range" not in plan(numbered) and "hashpartitioning(__all" not in plan(numbered)
    assert [r.v - r.id for r in numbered.collect()] == [1] * 500


def test_kept_legs_and_booking_lines_carry_no_columns_in_vain(spark, monkeypatch):
    own = standins.kept_legs(spark, "/root/testdata/sf0.001")
    written = spark.read.parquet(*own.inputFiles()).columns
    assert not set(written) & {"Key", "JourneyKey", "FlightKey", "FlightCode"}
    whole = standins.legs(spark, "/root/testdata/sf0.001")
    assert sorted(own.columns) == sorted(whole.columns)
    assert own.select(*whole.columns).exceptAll(whole).isEmpty() and own.count() == whole.count()

    numbered = []
    plain = journeys.number_all_rows
    monkeypatch.setattr(journeys, "number_all_rows", lambda df, *rest: numbered.append(df.columns) or plain(df, *rest))
    journeys.booking_lines(own, "A")
    assert not set(numbered[0]) & {"Key", "JourneyKey", "FlightKey", "PassengerStatus", "Capacity", "STA", "STAUTC"}


def test_kept_legs_stay_placed_by_passenger(spark, path):
    own = standins.kept_legs(spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    profile = journeys.journey_profile(own, "A", [], [], pinned=True)
    trips = own.where("Status = 0").join(profile.select(*journeys.JOURNEY).hint("merge"), journeys.JOURNEY, "left_semi")
    # Profiles, the lookup of indirect journeys and trips meet where the legs were written.
    assert "Exchange" not in plan(trips) and "Exchange" not in plan(journeys.indirect_journeys(own))
    assert "Exchange" not in plan(profile.join(journeys.indirect_journeys(own).hint("merge"), ["PassengerID", "JourneyNumber"], "left"))
    # No table is left in the catalog, and the files are whole for who reads them by their path.
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("placed_")]
    tune(spark)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"

    at, df = path("placed"), spark.range(1_000).selectExpr("cast(id % 97 as string) p", "id", "if(id % 5 = 0, null, 1) n")
    placed = write_placed(df.repartition(3, "p"), at, "p", 3)
    for read in (placed, spark.read.parquet(at)):
        assert read.select(*df.columns).exceptAll(df).isEmpty() and read.count() == 1_000
    assert placed.groupBy("p", "n").count().count() == df.groupBy("p", "n").count().count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_assembled_legs_are_placed_by_passenger(spark, path):
    at = dt.date(1998, 1, 1), dt.date(1999, 6, 30)
    tables = {}
    for name, df in standins.sources(spark, "/root/testdata/sf0.001").items():
        if "PassengerID" in df.columns:  # some passengers twice, some without an ID
            df = df.unionByName(df.where("PassengerID % 7 = 0"))
            df = df.withColumn("PassengerID", F.expr("if(PassengerID % 11 = 0, null, PassengerID)"))
        tables[name] = df.unionByName(df.where("InventoryLegID % 13 = 0")) if name == "InventoryLegClass" else df
    for route in ((None, None), ("Brand#7", None)):
        tune(spark)
        plain = assembly.passenger_legs(tables, *route, *at).withColumn("PassengerID", F.col("PassengerID").cast("string"))
        placed = assembly.placed_passenger_legs(tables, *route, *at, 3).select(*plain.columns)
        assert placed.exceptAll(plain).isEmpty() and placed.count() == plain.count() > 0
        # In three places by the text of the passenger, whatever the joins before became.
        here = F.spark_partition_id() == F.expr("pmod(hash(PassengerID), 3)")
        assert placed.where(~here).isEmpty()

    study = RouteStudy("ECONOMY", [], [], None, None, *at)
    own, inventory = study.load(spark, tables, path("study"))
    assert "Exchange" not in plan(journeys.journey_profile(own, "ECONOMY", [], [], pinned=True))
    assert "Exchange" not in plan(journeys.indirect_journeys(own))
    for kept in (own, inventory):
        assert not set(spark.read.parquet(*kept.inputFiles()).columns) & set(journeys.KEYS)
    fresh = study.pull_legs(tables)
    assert own.columns == fresh.columns and own.exceptAll(fresh).isEmpty() and own.count() == fresh.count()
    stocked = study.pull_inventory(tables)
    assert inventory.columns == stocked.columns and inventory.exceptAll(stocked).isEmpty()
    tune(spark)


def test_lid_adjustment_finds_the_trips_once(spark):
    found = plan(QUERIES["n21_lid_adjustment"](spark, "/root/testdata/sf0.001"))
    assert "links" not in found and "lead(" not in found


def test_legs_that_are_placed_by_passenger_are_not_shuffled_again(spark, frame, monkeypatch):
    def pinned(df):
        raise AssertionError("legs were pinned")

    # The lines, their orders and, for these, customers: no shuffle beyond that, and no repartition by the journey's columns.
    monkeypatch.setattr(ordered, "pin", pinned)
    for name in ("n12_distinct_ordered_legs", "n13_journey_profile", "n14_journey_chain_validity"):
        found = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "Exchange hashpartitioning(JourneyKey" not in found and "REPARTITION_BY_COL" not in found
        assert found.count("Exchange hashpartitioning(PassengerID") == 2
        # Equal legs meet in the one sort; no hash table of whole legs.
        assert not [line for line in found.splitlines() if "Aggregate(" in line and "keys=[" in line and "SegmentID" in line.split("functions=")[0]]
    # One order makes one row of equal legs, whatever columns the order leaves out; nulls are equal.
    rows = [("a", 2, None), ("a", 1, "x"), ("a", 2, None), ("a", 1, "y"), ("a", 1, "x"), (None, 1, None), (None, 1, None)]
    df = frame("k string, o int, v string", *rows).repartition(3)
    ahead = ordered.distinct_ahead(df, ["k"], ["o"], {"next": "v"})
    assert sorted(map(str, map(tuple, ahead.collect()))) == sorted(
        map(str, [("a", 1, "x", "y"), ("a", 1, "y", None), ("a", 2, None, None), (None, 1, None, None)])
    )


def test_checked_extracts_are_named_once_a_file(spark, frame, path):
    schema, at = frame("a int, b string").schema, path()
    days = [(k, str(k), f"T_2024-01-0{k % 3 + 1}_to_2024-01-0{k % 3 + 1}") for k in range(9)]
    sinks.write_text(frame("a int, b string, export string", *days), at, by="export")
    spark.createDataFrame([("a;b",), ("x;bad",)], "value string").coalesce(1).write.mode("append").text(f"{at}/export=T_2024-01-01_to_2024-01-01")
    report = maintenance.check_extracts(spark, at, schema)
    # Rows are counted under their file's path; names are taken from the few paths after it.
    counts = [line for line in plan(report).splitlines() if "partial_count(bad_row" in line]
    assert counts and all("__file" in line for line in counts)
    got = sorted(map(tuple, report.collect()))
    assert got == [("T_2024-01-01_to_2024-01-01", 4, 1, False), ("T_2024-01-02_to_2024-01-02", 3, 0, True), ("T_2024-01-03_to_2024-01-03", 3, 0, True)]
    assert [r.rows for r in maintenance.check_extracts(spark, at, schema, first_day=2, last_day=2).collect()] == [3]
