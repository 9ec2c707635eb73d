"""Queries on a zone map of the event log, and on intervals of any length."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from checks.standins import BOUNDS, log_days
from fareline.operators import bounds, intervals
from fareline.session import new_path
from fareline.sources import zones


def _zoned_log(spark, sf_dir):
    """The events as a log of files in order of IDs, written in two parts, and its zone map, brought up to date after each."""
    events = table(spark, sf_dir, "events")
    log, kept = new_path(spark, "log"), new_path(spark, "zones")
    span = bounds.key_bounds(events, "event_id").first()
    middle = (span.min_id + span.max_id) // 2
    for part in (F.col("event_id") <= middle, F.col("event_id") > middle):
        events.where(part).repartitionByRange(8, "event_id").sortWithinPartitions("event_id").write.mode("append").parquet(log)
        zones.refresh_zones(spark, log, kept, "event_id", "ts", zone_rows=10_000)
    return zones.read_zones(spark, log, kept), events.schema


@query("p5_day_bounds_by_zones", "WITH" + BOUNDS + "SELECT date, start, end_time, logged_start_id, logged_start_datetime, "
       "logged_end_id, logged_end_datetime FROM bounds")
def p5_zones(spark, sf_dir):
    zone_map, _ = _zoned_log(spark, sf_dir)
    return zones.day_bounds_in_zones(spark, zone_map, "event_id", "ts", *log_days(spark, sf_dir)).withColumnRenamed("end", "end_time")


@query("s1_id_range_by_zones", """
    WITH span AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
    SELECT event_id, ts, event_type FROM events, span WHERE event_id >= lo + (hi - lo) // 4 AND event_id <= hi - (hi - lo) // 4""")
def s1_zones(spark, sf_dir):
    zone_map, schema = _zoned_log(spark, sf_dir)
    span = zone_map.agg(F.min("low_id").alias("lo"), F.max("high_id").alias("hi")).first()
    quarter = (span.hi - span.lo) // 4
    return zones.id_range_in_zones(spark, zone_map, ["event_id", "ts", "event_type"], "event_id", span.lo + quarter, span.hi - quarter, schema)


@query("p13_intervals_of_any_length", """
    WITH begun AS (SELECT date_trunc('day', min(ts)) AS t FROM events),
    span AS (
        SELECT s_suppkey, t + to_hours(s_suppkey * 37 % 1000) AS first,
               t + to_hours(s_suppkey * 37 % 1000) + to_seconds(60 * CAST(power(4, s_suppkey % 12) AS BIGINT)) AS last
        FROM supplier, begun
    )
    SELECT s_suppkey, first, last, CAST(count(*) AS BIGINT) AS rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM span JOIN events ON ts BETWEEN first AND last GROUP BY ALL""")
def p13_any(spark, sf_dir):
    """Overlapping spans from a minute to some eight years."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    begun = events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("t")).first().t
    first = F.timestamp_add("HOUR", F.col("s_suppkey") * 37 % 1000, F.lit(begun).cast("timestamp_ntz"))
    length = (60 * F.pow(F.lit(4), F.col("s_suppkey") % 12)).cast("bigint")
    spans = table(spark, sf_dir, "supplier").select("s_suppkey", first.alias("first"))
    spans = spans.withColumn("last", F.timestamp_add("SECOND", length, F.col("first")))
    return intervals.totals_in_intervals(events, "ts", spans, "event_id", "first", "last", ("rows", "first_id", "last_id"))
