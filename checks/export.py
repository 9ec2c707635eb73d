"""Queries on ID ranges, day bounds, extracts and their quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks.registry import query, table
from checks.standins import BOUNDS, SPINE, log_days, log_tables
from fareline import schemas
from fareline.operators import bounds, export
from fareline.plans import daily_export, maintenance
from fareline.session import new_path
from fareline.sources import scans, sinks

_NOON = "date_trunc('day', min(ts)) + INTERVAL 15 DAY + INTERVAL 12 HOUR"


def _id_range(rows, id_col="event_id"):
    span = bounds.key_bounds(rows, id_col).first()
    return span.min_id, span.max_id


def _middle(rows, id_col="event_id"):
    """The middle half of the IDs: a quarter of the range is left out on either side."""
    low, high = _id_range(rows, id_col)
    return low + (high - low) // 4, high - (high - low) // 4


def _noon(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.agg((F.date_trunc("day", F.min("ts")).cast("timestamp_ntz") + F.expr("interval 372 hours")).alias("t")).first().t


def _bounds(spark, sf_dir, **options):
    return bounds.day_bounds(table(spark, sf_dir, "events"), "event_id", "ts", *log_days(spark, sf_dir), **options)


def _daily(df, time_col="ts", name="day"):
    return df.groupBy(F.to_date(time_col).alias(name)).agg(
        F.count("*").alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("treatment_daily_export", "WITH" + BOUNDS + """
    SELECT 'Treatment_' || strftime(b.start, '%Y-%m-%d') || '_to_' || strftime(b.start, '%Y-%m-%d') AS export,
           CAST(count(*) AS BIGINT) AS rows, min(e.event_id) AS first_id, max(e.event_id) AS last_id,
           min(e.ts) AS first, max(e.ts) AS last
    FROM bounds b JOIN events e
      ON e.event_id BETWEEN coalesce(b.logged_start_id, e.event_id) AND coalesce(b.logged_end_id, e.event_id)
     AND e.ts BETWEEN b.start AND b.end_time
    GROUP BY b.start""")
def treatment_daily_export(spark, sf_dir):
    tables = log_tables(spark, sf_dir)
    days = bounds.day_bounds(tables["Treatment"], "TreatmentID", "LoggedUTC", *log_days(spark, sf_dir))
    rows = daily_export.export_rows(tables, "Treatment", days)
    return rows.groupBy("export").agg(
        F.count("*").alias("rows"), F.min("TreatmentID").alias("first_id"), F.max("TreatmentID").alias("last_id"),
        F.min("LoggedUTC").alias("first"), F.max("LoggedUTC").alias("last"),
    )


@query("s1_id_range_scan", """
    WITH span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
    SELECT event_id, ts, event_type FROM events, span WHERE event_id >= lo + (hi - lo) // 4 AND event_id <= hi - (hi - lo) // 4""")
def s1(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return scans.id_range(events, ["event_id", "ts", "event_type"], "event_id", *_middle(events))


@query("s2_batched_range_read", """
    SELECT CAST(floor((event_id - (SELECT min(event_id) FROM events)) / 777) AS BIGINT) AS batch,
           CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM events GROUP BY 1""")
def s2(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    batched = scans.with_batch(events, "event_id", *_id_range(events), size=777)
    return batched.groupBy("batch").agg(
        F.count("*").alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("p1_key_bounds", "SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders")
def p1(spark, sf_dir):
    return bounds.key_bounds(table(spark, sf_dir, "orders"), "o_orderkey")


@query("p2_row_at_or_above", """
    SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_orderkey >= (SELECT avg(o_orderkey) FROM orders)
    ORDER BY l_orderkey, l_shipdate LIMIT 1""")
def p2(spark, sf_dir):
    middle = table(spark, sf_dir, "orders").agg(F.avg("o_orderkey")).first()[0]
    return bounds.row_at(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate", middle)


@query("p3_id_before_time", f"""
    WITH t AS (SELECT {_NOON} AS t_at FROM events)
    SELECT event_id, ts, ts > t_at - INTERVAL 300 SECOND AS within_tolerance FROM events, t
    WHERE ts <= t_at ORDER BY ts DESC, event_id DESC LIMIT 1""")
def p3_before(spark, sf_dir):
    return bounds.id_at_time(table(spark, sf_dir, "events"), "event_id", "ts", _noon(spark, sf_dir))


@query("p3_id_after_time", f"""
    WITH t AS (SELECT {_NOON} AS t_at FROM events)
    SELECT event_id, ts, ts < t_at + INTERVAL 300 SECOND AS within_tolerance FROM events, t
    WHERE ts >= t_at ORDER BY ts, event_id LIMIT 1""")
def p3_after(spark, sf_dir):
    return bounds.id_at_time(table(spark, sf_dir, "events"), "event_id", "ts", _noon(spark, sf_dir), "after")


@query("p4_asof_tolerance", """
    WITH t AS (SELECT max(ts) AS t_at FROM events)
    SELECT event_id, ts, ts > t_at + INTERVAL 200 SECOND - INTERVAL 150 SECOND AS within_tolerance FROM events, t
    WHERE ts <= t_at + INTERVAL 200 SECOND ORDER BY ts DESC, event_id DESC LIMIT 1""")
def p4(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    at = events.agg((F.max("ts") + F.expr("interval 200 seconds")).alias("t")).first().t
    return bounds.id_at_time(events, "event_id", "ts", at, tolerance_s=150)


@query("p5_day_bounds", "WITH" + BOUNDS + "SELECT date, start, end_time, logged_start_id, logged_start_datetime, "
       "logged_end_id, logged_end_datetime FROM bounds")
def p5(spark, sf_dir):
    return _bounds(spark, sf_dir).withColumnRenamed("end", "end_time")


@query("p6_day_spine", "WITH" + SPINE + """
    SELECT day, start, start + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS day_end,
           start + INTERVAL 1 DAY AS next_midnight FROM spine""")
def p6(spark, sf_dir):
    first, last = log_days(spark, sf_dir)
    closed = bounds.day_spine(spark, first, last).select("day", "start", F.col("end").alias("day_end"))
    open_end = bounds.day_spine(spark, first, last, inclusive_end=True)
    return closed.join(open_end.select("day", F.col("end").alias("next_midnight")), "day")


_CHILD = """
    WITH span AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders)
    SELECT {cols} FROM lineitem JOIN orders ON l_orderkey = o_orderkey, span
    WHERE o_orderkey {lo} low + (high - low) // 4 AND o_orderkey {hi} high - (high - low) // 4"""
_CHILD_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"


def _child(spark, sf_dir, how):
    lines = table(spark, sf_dir, "lineitem").select(*_CHILD_COLUMNS.split(", "))
    orders = table(spark, sf_dir, "orders")
    low, high = _middle(orders, "o_orderkey")
    return export.child_of_range(lines, orders, "l_orderkey", "o_orderkey", low, high, ["o_orderdate"], how)


@query("p7_parent_range_child", _CHILD.format(cols=_CHILD_COLUMNS + ", o_orderdate", lo=">=", hi="<="))
def p7(spark, sf_dir):
    return _child(spark, sf_dir, "inclusive")


@query("p8_exclusive_range", _CHILD.format(cols=_CHILD_COLUMNS + ", o_orderdate", lo=">", hi="<"))
def p8(spark, sf_dir):
    return _child(spark, sf_dir, "exclusive")


@query("p9_constant_null_columns", """
    SELECT event_id AS TreatmentID, seq AS TreatmentProductSequence, event_type AS FareClass,
           CAST(NULL AS VARCHAR) AS JourneyFareClassOfServiceList, CAST(NULL AS INTEGER) AS FareClassID,
           CAST(NULL AS DOUBLE) AS ProbabilityMatch, CAST(NULL AS VARCHAR) AS BookingWeekday,
           CAST(NULL AS INTEGER) AS output_label1ID, CAST(NULL AS INTEGER) AS BookingWeekdayID,
           CAST(NULL AS VARCHAR) AS LabelMatch, CAST(NULL AS VARCHAR) AS LineOfBusiness,
           CAST(NULL AS VARCHAR) AS output_label1, CAST(NULL AS FLOAT) AS output_probability1,
           CAST(NULL AS FLOAT) AS output_probability2
    FROM events, (VALUES (1), (2)) AS s(seq)""")
def p9(spark, sf_dir):
    name = "TreatmentProductInputParameterPivot"
    return export.with_constant_nulls(log_tables(spark, sf_dir)[name], name)


@query("p10_conform_to_schema", """
    SELECT event_id AS TreatmentID, event_type AS ClientCode, value AS SamplingRandomNumber, ts AS LoggedUTC,
           CAST(user_id AS INTEGER) AS NumberOfPassengers, CAST(NULL AS VARCHAR) AS FareClass,
           CAST(NULL AS INTEGER) AS TripType, 20 AS columns FROM events""")
def p10(spark, sf_dir):
    treatment = log_tables(spark, sf_dir)["Treatment"]
    texts = treatment.select(*[F.col(c).cast("string") if c != "LoggedUTC" else F.col(c) for c in treatment.columns])
    out = export.conform(texts, schemas.struct_of("Treatment"))
    kept = ["TreatmentID", "ClientCode", "SamplingRandomNumber", "LoggedUTC", "NumberOfPassengers", "FareClass", "TripType"]
    return out.select(*kept, F.lit(len(out.columns)).alias("columns"))


@query("p11_append_batches", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def p11(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    batches = [orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    return export.append_all(batches, orders.schema, spark)


@query("p12_empty_result_guard", """
    SELECT CAST(count(*) FILTER (WHERE value < 0) AS BIGINT) AS rows, 20 AS columns FROM events""")
def p12(spark, sf_dir):
    none = log_tables(spark, sf_dir)["Treatment"].where(F.col("SamplingRandomNumber") < 0)
    out = export.append_all([none], schemas.struct_of("Treatment"), spark)
    return out.agg(F.count("*").alias("rows"), F.lit(len(out.columns)).alias("columns"))


@query("p13_time_filter", """
    WITH t AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
    middle AS (SELECT date_trunc('hour', lo + (hi - lo) / 4) AS lo, date_trunc('hour', hi - (hi - lo) / 4) AS hi FROM t)
    SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM events, middle WHERE ts >= lo AND ts <= hi GROUP BY 1""")
def p13_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    hour = lambda t: t.replace(minute=0, second=0, microsecond=0)
    quarter = (span.hi - span.lo) / 4
    return _daily(export.in_time(events, "ts", hour(span.lo + quarter), hour(span.hi - quarter)))


@query("p13_interval_join", """
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT day, CAST(count(*) AS BIGINT) AS rows, min(l_shipdate) AS first, max(l_shipdate) AS last
    FROM d JOIN lineitem ON l_shipdate >= day AND l_shipdate <= day + INTERVAL 1 DAY GROUP BY day""")
def p13_join(spark, sf_dir):
    # Ship dates are midnights, so with inclusive ends each line falls into two days.
    span = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    start = F.col("day").cast("timestamp_ntz")
    days = span.select("day", start.alias("start"), (start + F.expr("interval 1 day")).alias("end"))
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate")
    dated = export.assign_days(lines, "l_shipdate", days, inclusive_end=True)
    return dated.groupBy("day").agg(
        F.count("*").alias("rows"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )


@query("p14_drop_accessory_column", _CHILD.format(cols=_CHILD_COLUMNS, lo=">=", hi="<="))
def p14(spark, sf_dir):
    return export.drop_accessory(_child(spark, sf_dir, "inclusive"), "o_orderdate")


@query("p15_control_character_cleaning", r"""
    SELECT doc_id, md5(regexp_replace(text, '[\n\t]', ' ', 'g')) AS text_md5,
           CAST(length(text) AS BIGINT) AS n, lang FROM documents""")
def p15(spark, sf_dir):
    cleaned = export.clean_text(table(spark, sf_dir, "documents"), keep=["lang"])
    return cleaned.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("bigint").alias("n"), "lang"
    )


_EXPORT_NAMES = ", ".join(f"('{name}', {2 if cut.parent else 1})" for name, cut in daily_export.LOG_TABLES.items())


@query("p16_multi_table_daily_export", f"""
    SELECT name AS "table", name || '_' || strftime(ts, '%Y-%m-%d') || '_to_' || strftime(ts, '%Y-%m-%d') AS export,
           CAST(count(*) * any_value(n) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM events, (VALUES {_EXPORT_NAMES}) AS t(name, n) GROUP BY 1, 2""")
def p16(spark, sf_dir):
    root = new_path(spark, "export")
    tables = log_tables(spark, sf_dir)
    daily_export.export_all(tables, _bounds(spark, sf_dir), root)
    reports = []
    for name, cut in daily_export.LOG_TABLES.items():
        rows = scans.read_text(spark, f"{root}/{name}", maintenance.exported_schema(name))
        reports.append(
            rows.withColumn("export", sinks.source_name()).groupBy(F.lit(name).alias("table"), "export").agg(
                F.count("*").alias("rows"), F.min(cut.id_col).alias("first_id"), F.max(cut.id_col).alias("last_id")
            )
        )
    return reduce(lambda a, b: a.unionByName(b), reports)


@query("p16_halves_of_each_day", "WITH" + BOUNDS + """,
    span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
    dated AS (
        SELECT e.event_id, strftime(e.ts, '%Y-%m-%d') AS day, coalesce(b.logged_start_id, s.lo) AS low, coalesce(b.logged_end_id, s.hi) AS high
        FROM events e JOIN bounds b ON CAST(e.ts AS DATE) = CAST(b.start AS DATE), span s
    )
    SELECT 'Treatment_' || day || '_to_' || day || '_part' || CASE WHEN event_id <= low + (high - low) // 2 THEN '1' ELSE '2' END AS export,
           CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM dated WHERE event_id BETWEEN low AND high GROUP BY 1""")
def p16_halves(spark, sf_dir):
    root = new_path(spark, "halves")
    daily_export.export_table(log_tables(spark, sf_dir), "Treatment", _bounds(spark, sf_dir), root, split=True)
    rows = scans.read_text(spark, f"{root}/Treatment", maintenance.exported_schema("Treatment")).withColumn("export", sinks.source_name())
    return rows.groupBy("export").agg(
        F.count("*").alias("rows"), F.min("TreatmentID").alias("first_id"), F.max("TreatmentID").alias("last_id")
    )


@query("p16_days_without_rows", "WITH" + SPINE + f"""
    SELECT name || '_' || strftime(day, '%Y-%m-%d') || '_to_' || strftime(day, '%Y-%m-%d') AS export,
           CAST(count(event_id) * any_value(n) AS BIGINT) AS rows
    FROM spine CROSS JOIN (VALUES {_EXPORT_NAMES}) AS t(name, n)
    LEFT JOIN events ON CAST(ts AS DATE) = day AND day(ts) % 3 <> 0 GROUP BY 1""")
def p16_without_rows(spark, sf_dir):
    """Every third day of the log is taken out; its extracts are there, with a header alone."""
    root, days = new_path(spark, "gaps"), _bounds(spark, sf_dir)
    tables = log_tables(spark, sf_dir)
    for name, cut in daily_export.LOG_TABLES.items():
        if cut.parent is None:
            tables[name] = tables[name].where(F.dayofmonth(cut.time_col) % 3 != 0)
    daily_export.export_all(tables, days, root)
    reports = [maintenance.check_extracts(spark, f"{root}/{name}", maintenance.exported_schema(name)) for name in daily_export.LOG_TABLES]
    return reduce(lambda a, b: a.unionByName(b), reports).select("export", "rows")


@query("q4_unsigned_range_check", """
    WITH v AS (SELECT l_linenumber - 2 AS a, CAST(l_extendedprice AS BIGINT) AS b FROM lineitem)
    SELECT c AS "column", CAST(count(*) AS BIGINT) AS rows,
           CAST(count(*) FILTER (WHERE (c = 'TreatmentProductSequence' AND a < 0)
                                    OR (c IN ('ProductID', 'CalculatedFrom') AND (b < 0 OR b > 65535))) AS BIGINT) AS out_of_range
    FROM v, (VALUES ('TreatmentProductSequence'), ('ProductID'), ('CalculatedFrom'), ('TreatmentOrdinal'),
             ('OptimizedPoints'), ('QuantityRequested')) AS t(c) GROUP BY c""")
def q4(spark, sf_dir):
    price = F.round("l_extendedprice").cast("int")
    raw = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") - 2).alias("TreatmentProductSequence"), price.alias("ProductID"), price.alias("CalculatedFrom"),
        F.col("l_quantity").cast("int").alias("QuantityRequested"),
    )
    return maintenance.range_check(export.conform(raw, schemas.struct_of("TreatmentProduct")), "TreatmentProduct")
