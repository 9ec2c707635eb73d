import datetime as dt

import pytest

from fareline import schemas
from fareline.operators import bounds, export, quality
from fareline.plans import daily_export, maintenance
from fareline.sources import scans, sinks
from tests.conftest import rows

DAY = "interval 1 day"


def at(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


def test_range_ends(frame):
    t = frame("id bigint, x string, y int", (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4))
    assert rows(scans.id_range(t, ["id", "x"], "id", 2, 3), "id") == [(2, "b"), (3, "c")]
    assert rows(scans.id_range(t, ["id"], "id", 1, 4, "exclusive"), "id") == [(2,), (3,)]
    with pytest.raises(ValueError):
        scans.id_range(t, ["id"], "id", 1, 4, "open")


def test_range_and_columns_reach_the_scan(spark, frame, path):
    where = path("range")
    frame("id bigint, x string, y int", (1, "a", 1), (2, "b", 2)).write.parquet(where)
    plan = scans.id_range(spark.read.parquet(where), ["x"], "id", 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,1)" in plan and "LessThanOrEqual(id,2)" in plan
    assert "y" not in plan.split("ReadSchema:")[1]


def test_last_batch_of_one_id_is_read(frame):
    t = frame("id bigint", *[(i,) for i in range(1, 12)])
    got = scans.with_batch(t, "id", 1, 11, size=5).groupBy("batch").count()
    assert rows(got, "batch") == [(0, 5), (1, 5), (2, 1)]


def test_children_of_a_parent_range(frame):
    parent = frame("pid bigint, t timestamp_ntz", (1, at(1)), (2, at(2)), (3, at(3)), (9, at(9)))
    child = frame("cid bigint, pid2 bigint, t timestamp_ntz", (10, 1, None), (11, 2, None), (12, 2, None), (13, 3, None), (14, 7, None))
    inclusive = export.child_of_range(child, parent, "pid2", "pid", 1, 3, ["t"])
    assert rows(inclusive, "cid") == [(10, 1, at(1)), (11, 2, at(2)), (12, 2, at(2)), (13, 3, at(3))]
    exclusive = export.child_of_range(child, parent, "pid2", "pid", 1, 3, ["t"], "exclusive")
    assert rows(exclusive, "cid") == [(11, 2, at(2)), (12, 2, at(2))]


def test_conform(spark, frame):
    schema = schemas.struct_of("currency_conversion")
    raw = frame("ConversionRate string, FromCurrencyCode string", ("1.5", "NZD"))
    got = export.conform(raw, schema)
    assert got.schema == schema
    assert rows(got) == [("NZD", None, 1.5)]
    broken = frame("ConversionRate string", ("much",))
    assert rows(export.conform(broken, schema, strict=False)) == [(None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        export.conform(broken, schema).collect()


def test_empty_and_appended(spark, frame):
    schema = schemas.struct_of("currency_conversion")
    assert export.append_all([], schema, spark).schema == schema
    one = frame("FromCurrencyCode string", ("NZD",))
    assert export.append_all([one, one], schema, spark).count() == 2


def test_constant_nulls(frame):
    name = "TreatmentDistinctRanked"
    got = export.with_constant_nulls(frame("MinTreatmentID bigint", (1,)), name)
    assert set(schemas.CONSTANT_NULL[name]) < set(got.columns)
    assert got.schema["MMB"].dataType.simpleString() == "string"


def test_time_ends(frame):
    t = frame("t timestamp_ntz", (at(1),), (at(1, 23, 59, 59, 999999),), (at(2),))
    assert export.in_time(t, "t", at(1), at(2)).count() == 3
    assert export.in_time(t, "t", at(1), at(2), inclusive_end=False).count() == 2


def test_days_of_rows(frame):
    t = frame("id int, t timestamp_ntz", (1, at(1)), (2, at(1, 12)), (3, at(2)), (4, at(4)), (5, None))
    days = frame("start timestamp_ntz, end timestamp_ntz", (at(1), at(2)), (at(2), at(3)))
    closed = export.assign_days(t, "t", days).select("id", "start")
    assert rows(closed, "id", "start") == [(1, at(1)), (2, at(1)), (3, at(1)), (3, at(2))]
    half_open = export.assign_days(t, "t", days, inclusive_end=False).select("id", "start")
    assert rows(half_open, "id") == [(1, at(1)), (2, at(1)), (3, at(2))]


def test_many_ranges_are_not_broadcast(frame, monkeypatch):
    from fareline import session

    t = frame("id int, t timestamp_ntz", (1, at(1, 5)), (2, at(2, 5)))
    days = frame("start timestamp_ntz, end timestamp_ntz", (at(1), at(1, 23)), (at(2), at(2, 23)))
    monkeypatch.setattr(export, "broadcast_if_small", lambda df: session.broadcast_if_small(df, 1))
    joined = export.assign_days(t, "t", days)
    assert joined.count() == 2
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_accessory(frame):
    t = frame("a int, t timestamp_ntz", (1, at(1)))
    assert export.drop_accessory(t, "t").columns == ["a"]
    assert export.drop_accessory(t.select("t", "a"), "t").columns == ["t", "a"]


def test_cleaning(frame):
    t = frame("a string, kept string, n int", ("x\ny\tz\r\n", "p\tq", 1), (None, None, None))
    assert rows(export.clean_text(t, keep=["kept"]), "n") == [(None, None, None), ("x y z\r ", "p\tq", 1)]


TEXTS = ["a;b", 'say "hi"', "back\\slash", "line\nbreak", "cr\rhere", "  edge  ", "", None, "\\N?", "plain", "ü€"]


def test_text_round_trip(spark, frame, path):
    where = path("text")
    t = frame("i int, s string, t timestamp_ntz, x double", *[(i, s, at(1, 1, 1, 1, i), i / 3) for i, s in enumerate(TEXTS)])
    sinks.write_text(t, where, exact_nulls=True)
    assert rows(scans.read_text(spark, where, t.schema, exact_nulls=True), "i") == rows(t, "i")


def test_single_line_reading_keeps_carriage_returns(spark, frame, path):
    where = path("lines")
    t = frame("i int, s string", *[(i, s) for i, s in enumerate(TEXTS) if s is None or "\n" not in s])
    sinks.write_text(t, where, exact_nulls=True)
    assert rows(scans.read_text(spark, where, t.schema, exact_nulls=True, multi_line=False), "i") == rows(t, "i")


def test_text_is_quoted_only_where_needed(spark, frame, path):
    where = path("quotes")
    sinks.write_text(frame("a int, s string", (1, "plain"), (2, "a;b")).coalesce(1), where)
    lines = sorted(r.value for r in spark.read.text(where).collect())
    assert lines == ["1;plain", '2;"a;b"', "a;s"]


def test_strict_reading_fails_on_a_bad_row(spark, frame, path):
    where = path("bad")
    sinks.write_text(frame("a string, s string", ("1", "x"), ("one", "y")), where)
    schema = frame("a int, s string").schema
    with pytest.raises(Exception, match="MALFORMED"):
        scans.read_text(spark, where, schema).collect()
    loose = rows(scans.read_text(spark, where, schema, strict=False), "s")
    assert loose == [(1, "x", None), (None, "y", "one;y")]


def test_parts_recombine_to_the_whole(spark, frame, path):
    parts, whole = path("parts"), path("whole")
    t = frame("id bigint, s string", *[(i, f"r{i}") for i in range(1, 12)]).withColumn("export", sinks.F.lit("base"))
    sinks.write_split(t, parts, sinks.F.lit("base"), "id", 1, 11)
    schema = frame("id bigint, s string").schema
    named = scans.read_text(spark, parts, schema).withColumn("export", sinks.source_name())
    sizes = rows(named.groupBy("export").count(), "export")
    assert sizes == [("base_part1", 6), ("base_part2", 5)]
    sinks.combine_parts(spark, parts, whole, schema)
    got = scans.read_text(spark, whole, schema).withColumn("export", sinks.source_name())
    assert rows(got, "id") == rows(t, "id")


@pytest.mark.parametrize("parts", [2, 3, 7])
def test_every_id_lands_in_one_part(frame, parts):
    t = frame("id bigint", *[(i,) for i in range(5, 105)])
    got = t.select(sinks.part_number("id", 5, 104, parts).alias("p")).groupBy("p").count()
    numbers = rows(got, "p")
    assert [n for n, _ in numbers] == list(range(1, parts + 1))
    assert max(c for _, c in numbers) - min(c for _, c in numbers) <= 1


def test_part_files_by_file_name(frame):
    t = frame("p string", ("file:/x/T_2024-01-01_to_2024-01-02_part1.csv.gz",), ("s3://b/e/export=T_1_part2/part-0.csv",))
    assert rows(t.select(sinks.source_name(sinks.F.col("p")))) == [("T_2024-01-01_to_2024-01-02_part1",), ("T_1_part2",)]


def test_cache(spark, frame, path):
    where = path("cache")
    pulls = []

    def pull():
        pulls.append(1)
        return frame("n int", (len(pulls),))

    assert rows(sinks.cached_extract(spark, where, pull, save=False)) == [(1,)]
    assert rows(sinks.cached_extract(spark, where, pull)) == [(2,)]
    assert rows(sinks.cached_extract(spark, where, pull)) == [(2,)]
    assert rows(sinks.cached_extract(spark, where, pull, force=True)) == [(3,)]


def test_reports(frame):
    t = frame("export string, a int, bad_row string, t timestamp_ntz", ("x-01-09", 1, None, at(9)), ("x-01-09", None, "?", at(8)), ("x-01-24", 2, None, at(24)))
    assert rows(quality.parse_report(t, "export"), "export") == [("x-01-09", 2, 1, False), ("x-01-24", 1, 0, True)]
    assert rows(quality.time_report(t, "export", "t"), "export") == [("x-01-09", 2, at(8), at(9)), ("x-01-24", 1, at(24), at(24))]
    assert quality.named(t, "export", "-01-", first_day=24).count() == 1
    assert quality.named(t, "export", "-09-").count() == 0
    assert quality.named(t, "export", last_day=10).count() == 2


def test_unsigned_limits(frame):
    t = frame("a int, b bigint", (-1, 5), (65535, 4294967295), (65536, 4294967296), (None, 0))
    got = quality.unsigned_report(t, {"a": 65_535, "b": 4_294_967_295})
    assert rows(got, "column") == [("a", 4, 2), ("b", 4, 1)]


def _tables(frame):
    stamp = [at(1, 5), at(1, 23, 59, 59, 999999), at(2), at(2, 9), at(3, 1)]
    return {
        "Treatment": frame("TreatmentID bigint, LoggedUTC timestamp_ntz, ExternalBookingID string, FareClass string",
                           *[(i, t, f"b\t{i}", "f\tc") for i, t in enumerate(stamp)]),
        "TreatmentDistinctRanked": frame("MinTreatmentID bigint, MinLoggedUTC timestamp_ntz, Stage int",
                                         *[(i, t, i) for i, t in enumerate(stamp)]),
        "TreatmentProduct": frame("TreatmentID bigint, TreatmentProductSequence int, Cost double", *[(i, 1, 0.5) for i in range(7)]),
        "TreatmentProductRanked": frame("TreatmentIDLook bigint, TreatmentProductSequence int", *[(i, 1) for i in range(7)]),
        "TreatmentProductInputParameterPivot": frame("TreatmentID bigint, TreatmentProductSequence int, FareClass string", *[(i, 1, "x") for i in range(7)]),
    }


@pytest.mark.parametrize("split", [False, True])
def test_whole_export(spark, frame, path, split):
    from fareline.operators.bounds import day_bounds

    tables, root = _tables(frame), path("export")
    days = day_bounds(tables["Treatment"], "TreatmentID", "LoggedUTC", dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    daily_export.export_all(tables, days, root, split=split)
    if split:
        whole = path("combined")
        maintenance.combine_all(spark, root, whole)
        root = whole
    for name, cut in daily_export.LOG_TABLES.items():
        got = scans.read_text(spark, f"{root}/{name}", maintenance.exported_schema(name))
        assert rows(got.groupBy(sinks.source_name().alias("e")).count(), "e") == [
            (f"{name}_2024-01-01_to_2024-01-01", 2), (f"{name}_2024-01-02_to_2024-01-02", 2)
        ]
        assert (cut.time_col in got.columns) == (cut.parent is None)
    one = rows(scans.read_text(spark, f"{root}/Treatment", schemas.struct_of("Treatment")).select("TreatmentID", "ExternalBookingID", "FareClass"), "TreatmentID")
    # Plain text is cleaned, categorical text is not.
    assert one[0] == (0, "b 0", "f\tc")


def test_inclusive_next_midnight_is_exported_twice(frame):
    from fareline.operators.bounds import day_bounds

    tables = _tables(frame)
    days = day_bounds(tables["Treatment"], "TreatmentID", "LoggedUTC", dt.date(2024, 1, 1), dt.date(2024, 1, 2), inclusive_end=True)
    names = daily_export.export_rows(tables, "Treatment", days)
    assert names.where("TreatmentID = 2").count() == 2
    assert daily_export.export_rows(tables, "Treatment", days, inclusive_end=False).where("TreatmentID = 2").count() == 1


def test_extract_check_by_name(spark, frame, path):
    where = path("check")
    t = frame("a string, s string, export string", ("1", "x", "T_2024-09-10_to_2024-09-10"), ("?", "y", "T_2024-09-24_to_2024-09-24"))
    sinks.write_text(t, where, by="export")
    schema = frame("a int, s string").schema
    assert rows(maintenance.check_extracts(spark, where, schema), "export") == [
        ("T_2024-09-10_to_2024-09-10", 1, 0, True), ("T_2024-09-24_to_2024-09-24", 1, 1, False)
    ]
    assert maintenance.check_extracts(spark, where, schema, "-09-", first_day=24).count() == 1


def test_declared_schemas():
    counts = {"Treatment": 20, "TreatmentProductRanked": 21, "TreatmentProduct": 17, "TreatmentProductInputParameterPivot": 15,
              "TreatmentDistinctRanked": 76, "passenger_legs": 36, "inventory_legs": 23, "bookings": 35, "journey_charges": 12, "journey_fees": 19}
    assert {t: len(schemas.struct_of(t)) for t in counts} == counts
    assert schemas.unsigned_limits("TreatmentProduct")["QuantityRequested"] == 4_294_967_295


def test_large_ids_and_ids_outside_the_range(frame):
    low = 2**60
    t = frame("id bigint", *[(low + k,) for k in range(-3, 13)], (None,))
    got = {r.id: r.p for r in t.select("id", sinks.part_number("id", low, low + 9, 3).alias("p")).collect()}
    assert got == {None: 1, **{low + k: 1 for k in range(-3, 4)}, **{low + k: 2 for k in range(4, 7)}, **{low + k: 3 for k in range(7, 13)}}


def test_parts_with_other_separator_read_by_lines(frame, spark, path):
    t = frame("id bigint, x string", *[(k, "a,b") for k in range(1, 12)])
    sinks.write_split(t, parts := path(), sinks.F.lit("base"), "id", 1, 11, sep=",")
    sinks.combine_parts(spark, parts, whole := path(), t.schema, sep=",", multi_line=False)
    assert rows(scans.read_text(spark, whole, t.schema, sep=",").select("id", "x"), "id") == rows(t, "id")


def test_every_day_has_extracts(frame, spark, path):
    """Each day is cut at the middle of its own IDs; a day without rows has a header alone."""
    stamp = dt.datetime(2024, 1, 1, 12)
    logged = [(n, stamp + dt.timedelta(days=n // 100 * 2, seconds=n)) for n in range(200)]
    log = frame("TreatmentID bigint, LoggedUTC timestamp_ntz", *logged)
    days = bounds.day_bounds(log, "TreatmentID", "LoggedUTC", dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    for split, wanted in ((False, [100, 0, 100]), (True, [51, 49, 0, 0, 50, 50])):
        daily_export.export_table({"Treatment": log}, "Treatment", days, root := path(), split=split)
        schema = maintenance.exported_schema("Treatment")
        report = maintenance.check_extracts(spark, f"{root}/Treatment", schema).orderBy("export").collect()
        assert [r.rows for r in report] == wanted and all(r.parses for r in report)
        times = maintenance.time_ranges(spark, f"{root}/Treatment", schema, "LoggedUTC" if "LoggedUTC" in schema.names else schema.names[0])
        assert sorted(r.rows for r in times.collect()) == sorted(wanted)
    maintenance.combine_parts(spark, f"{root}/Treatment", whole := path(), schema)
    assert sorted(r.rows for r in maintenance.check_extracts(spark, whole, schema).collect()) == [0, 100, 100]
