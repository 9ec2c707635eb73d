"""Queries that write files, read them back and compare; below the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from checks.standins import BOUNDS, log_days, log_tables
from fareline import schemas
from fareline.operators import bounds, quality
from fareline.plans import ledger, maintenance
from fareline.session import new_path
from fareline.sources import multiline, scans, sinks

_DAY_NAME = "'events_' || strftime(ts, '%Y-%m-%d') || '_to_' || strftime(ts, '%Y-%m-%d')"


def _named_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("export", sinks.export_name("events", "ts", "ts"))


def _event_schema(spark, sf_dir):
    return table(spark, sf_dir, "events").schema


@query("s3_strict_text_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s3(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = new_path(spark, "text")
    sinks.write_text(events, path)
    return scans.read_text(spark, path, events.schema)


@query("s3_divided_multi_line_scan", """
    SELECT doc_id, text, lang, source, n_chars FROM documents""")
def s3_divided(spark, sf_dir):
    """Texts with line feeds in one file, read by as many tasks as the file has parts."""
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "text")
    sinks.write_text(documents, path, exact_nulls=True)
    return multiline.read_text_divided(spark, path, documents.schema, exact_nulls=True)


@query("s4_text_sink", """
    SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n, lang, source FROM documents""")
def s4(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    path = new_path(spark, "text")
    sinks.write_text(documents, path, exact_nulls=True)
    back = scans.read_text(spark, path, documents.schema, exact_nulls=True)
    return back.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.length("text").cast("bigint").alias("n"), "lang", "source"
    )


@query("s5_compressed_export", f"""
    SELECT {_DAY_NAME} AS export, CAST(count(*) AS BIGINT) AS rows, true AS compressed FROM events GROUP BY 1""")
def s5(spark, sf_dir):
    path = new_path(spark, "gzip")
    sinks.write_text(_named_events(spark, sf_dir), path, by="export", compressed=True)
    rows = scans.read_text(spark, path, _event_schema(spark, sf_dir))
    rows = rows.withColumn("export", sinks.source_name()).withColumn("file", F.col("_metadata.file_name"))
    return rows.groupBy("export").agg(
        F.count("*").alias("rows"), F.bool_and(F.col("file").endswith(".gz")).alias("compressed")
    )


def _split(spark, sf_dir, parts=2):
    path = new_path(spark, "parts")
    events = _named_events(spark, sf_dir)
    span = bounds.key_bounds(events, "event_id").first()
    sinks.write_split(events, path, F.col("export"), "event_id", span.min_id, span.max_id, parts)
    return path


_SPLIT = """
    WITH ends AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
    span AS (SELECT lo, hi, (hi - lo + 1) // 7 AS q, (hi - lo + 1) % 7 AS r FROM ends)
    SELECT {name} || '_part' || {part} AS export, CAST(count(*) AS BIGINT) AS rows,
           min(event_id) AS first_id, max(event_id) AS last_id
    FROM events, span GROUP BY 1"""


def _parts_report(spark, sf_dir, parts):
    rows = scans.read_text(spark, _split(spark, sf_dir, parts), _event_schema(spark, sf_dir))
    return rows.withColumn("export", sinks.source_name()).groupBy("export").agg(
        F.count("*").alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("s6_two_part_split", _SPLIT.format(
    name=_DAY_NAME, part="CASE WHEN event_id <= (lo + hi) // 2 THEN '1' ELSE '2' END"))
def s6_two(spark, sf_dir):
    return _parts_report(spark, sf_dir, 2)


@query("s6_many_part_split", _SPLIT.format(
    name=_DAY_NAME, part="CAST(CASE WHEN event_id - lo < r * (q + 1) THEN (event_id - lo) // (q + 1) ELSE r + (event_id - lo - r * (q + 1)) // q END + 1 AS VARCHAR)"))
def s6_many(spark, sf_dir):
    return _parts_report(spark, sf_dir, 7)


@query("s7_combine_parts", f"""
    SELECT {_DAY_NAME} AS export, event_id, ts, user_id, event_type, value, props FROM events""")
def s7(spark, sf_dir):
    parts, whole = _split(spark, sf_dir), new_path(spark, "whole")
    schema = _event_schema(spark, sf_dir)
    sinks.combine_parts(spark, parts, whole, schema)
    return scans.read_text(spark, whole, schema).withColumn("export", sinks.source_name())


@query("s7_combine_divided_parts", """
    SELECT lang || '_all' AS export, doc_id, text, lang, source, n_chars FROM documents WHERE lang IS NOT NULL""")
def s7_divided(spark, sf_dir):
    """Parts whose texts hold line feeds, combined by reading each part in divided form."""
    documents = table(spark, sf_dir, "documents").where("lang is not null")
    parts, whole = new_path(spark, "parts"), new_path(spark, "whole")
    span = bounds.key_bounds(documents, "doc_id").first()
    name = F.concat("lang", F.lit("_all"))
    sinks.write_split(documents, parts, name, "doc_id", span.min_id, span.max_id, 3, exact_nulls=True)
    sinks.combine_parts(spark, parts, whole, documents.schema, exact_nulls=True, divided=True)
    rows = multiline.read_text_divided(spark, whole, documents.schema, exact_nulls=True, file="file")
    return rows.withColumn("export", sinks.source_name(F.col("file"))).drop("file")


@query("s8_extract_cache", """
    SELECT event_type, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS pulled_again FROM events GROUP BY 1""")
def s8(spark, sf_dir):
    path = sinks.extract_path(new_path(spark, "cache"), "AAA", "BBB", *log_days(spark, sf_dir))
    pulls = []

    def pull():
        pulls.append(1)
        return table(spark, sf_dir, "events")

    sinks.cached_extract(spark, path, pull)
    kept = sinks.cached_extract(spark, path, pull)
    return kept.groupBy("event_type").agg(
        F.count("*").alias("rows"), F.lit(len(pulls) - 1).cast("bigint").alias("pulled_again")
    )


@query("s9_bounds_table", "WITH" + BOUNDS + """
    SELECT date, start, end_time, logged_start_id, logged_start_datetime, logged_end_id, logged_end_datetime FROM bounds
    WHERE start >= (SELECT min(start) FROM bounds) AND start <= (SELECT max(start) FROM bounds)""")
def s9(spark, sf_dir):
    first, last = log_days(spark, sf_dir)
    path = new_path(spark, "bounds")
    bounds.save_bounds(bounds.day_bounds(table(spark, sf_dir, "events"), "event_id", "ts", first, last), path)
    return bounds.load_bounds(spark, path, first, last).withColumnRenamed("end", "end_time")


@query("q1_strict_reread_check", f"""
    SELECT {_DAY_NAME} AS export, CAST(count(*) AS BIGINT) AS rows,
           CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS bad_rows,
           count(*) FILTER (WHERE event_type = 'error') = 0 AS parses
    FROM events GROUP BY 1""")
def q1(spark, sf_dir):
    # Values of error events are written as text that is no number.
    broken = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    path = new_path(spark, "reread")
    sinks.write_text(_named_events(spark, sf_dir).withColumn("value", broken), path, by="export")
    return maintenance.check_extracts(spark, path, _event_schema(spark, sf_dir))


@query("q2_file_time_ranges", f"""
    SELECT {_DAY_NAME} AS export, CAST(count(*) AS BIGINT) AS rows, min(ts) AS first, max(ts) AS last
    FROM events GROUP BY 1""")
def q2(spark, sf_dir):
    path = new_path(spark, "times")
    sinks.write_text(_named_events(spark, sf_dir), path, by="export")
    return maintenance.time_ranges(spark, path, _event_schema(spark, sf_dir), "ts")


@query("q3_file_subset_by_name", f"""
    SELECT {_DAY_NAME} AS export, extract('day' FROM ts)::INTEGER AS name_day, CAST(count(*) AS BIGINT) AS rows,
           contains({_DAY_NAME}, '-01-') AND extract('day' FROM ts) >= 24 AS late_january
    FROM events GROUP BY 1, 2, 4""")
def q3(spark, sf_dir):
    path = new_path(spark, "names")
    sinks.write_text(_named_events(spark, sf_dir), path, by="export")
    rows = scans.read_text(spark, path, _event_schema(spark, sf_dir)).withColumn("export", sinks.source_name())
    late = quality.named(rows, "export", "-01-", first_day=24).select("export").distinct().withColumn("late_january", F.lit(True))
    counted = rows.groupBy("export", quality.name_day("export").alias("name_day")).agg(F.count("*").alias("rows"))
    return counted.join(late, "export", "left").withColumn("late_january", F.coalesce("late_january", F.lit(False)))


@query("p16_export_run_again", "WITH" + BOUNDS + """
    SELECT 'Treatment_' || strftime(b.start, '%Y-%m-%d') || '_to_' || strftime(b.start, '%Y-%m-%d') AS export,
           CAST(count(e.event_id) AS BIGINT) AS rows, count(*) FILTER (WHERE e.event_type = 'error' AND e.value <> 0) > 0 AS written_again
    FROM bounds b LEFT JOIN events e ON e.ts BETWEEN b.start AND b.end_time
     AND e.event_id BETWEEN coalesce(b.logged_start_id, e.event_id) AND coalesce(b.logged_end_id, e.event_id)
    GROUP BY b.start""")
def p16_again(spark, sf_dir):
    """All days exported; values of error events changed; then only their days are exported again."""
    tables, root = log_tables(spark, sf_dir), new_path(spark, "ledger")
    days = bounds.day_bounds(tables["Treatment"], "TreatmentID", "LoggedUTC", *log_days(spark, sf_dir))
    ledger.export_changed(tables, "Treatment", days, root)
    doubled = F.when(F.col("ClientCode") == "error", F.col("SamplingRandomNumber") * 2).otherwise(F.col("SamplingRandomNumber"))
    changed = tables | {"Treatment": tables["Treatment"].withColumn("SamplingRandomNumber", doubled)}
    again = ledger.export_changed(changed, "Treatment", days, root)
    rows = scans.read_text(spark, f"{root}/Treatment", schemas.struct_of("Treatment")).groupBy(sinks.source_name().alias("export")).count()
    kept = ledger.read_ledger(spark, root).join(rows, "export", "left")
    return kept.select("export", F.coalesce("count", F.lit(0)).cast("bigint").alias("rows"), F.col("export").isin(again).alias("written_again"))
