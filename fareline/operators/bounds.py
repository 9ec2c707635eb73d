"""Row IDs that bracket points in time, in a log whose IDs rise with time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.schemas import struct_of
from fareline.session import pin
from fareline.sources.scans import read_text
from fareline.sources.sinks import write_text

ONE_HOUR = dt.timedelta(hours=1)
ONE_DAY = dt.timedelta(days=1)
_TICK = dt.timedelta(microseconds=1)


def _span(amount: dt.timedelta):
    return F.lit(amount)


def key_bounds(log: DataFrame, id_col: str) -> DataFrame:
    """Lowest and highest ID: one row (min_id, max_id)."""
    return log.agg(F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id"))


def row_at(log: DataFrame, id_col: str, time_col: str, key: int, exact: bool = False) -> DataFrame:
    """ID and time of the first row at or above `key` (or exactly at it); nulls if there is none."""
    wanted = F.col(id_col) == key if exact else F.col(id_col) >= key
    found = log.where(wanted).agg(F.min(F.struct(id_col, time_col)).alias("r"))
    return found.select(F.col(f"r.{id_col}"), F.col(f"r.{time_col}"))


def id_at_time(
    log: DataFrame, id_col: str, time_col: str, target: dt.datetime, direction: str = "before",
    tolerance_s: int = 300,
) -> DataFrame:
    """The row closest to `target` on one side, the target itself included.

    Rows of equal time: the highest ID before, the lowest after. `within_tolerance` tells whether the
    row lies less than `tolerance_s` away.
    """
    at = F.lit(target).cast("timestamp_ntz")
    t = F.col(time_col)
    pair = F.struct(F.col(time_col), F.col(id_col))
    near = F.expr(f"interval {tolerance_s} seconds")
    if direction == "before":
        found = log.where(t <= at).agg(F.max(pair).alias("r"))
        close = F.col(f"r.{time_col}") > at - near
    elif direction == "after":
        found = log.where(t >= at).agg(F.min(pair).alias("r"))
        close = F.col(f"r.{time_col}") < at + near
    else:
        raise ValueError(f"direction must be before or after, not {direction!r}")
    return found.select(
        F.col(f"r.{id_col}"), F.col(f"r.{time_col}"), close.alias("within_tolerance")
    )


def day_spine(
    spark: SparkSession, first: dt.date, last: dt.date, inclusive_end: bool = False
) -> DataFrame:
    """One row (day, date, start, end) per calendar day.

    The end is the day's last microsecond, or with `inclusive_end` the next midnight.
    """
    days = (last - first).days + 1
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    start = day.cast("timestamp_ntz")
    end = start + F.expr("interval 1 day")
    if not inclusive_end:
        end = end - _span(_TICK)
    return spark.range(days).select(
        day.alias("day"), start.alias("date"), start.alias("start"), end.alias("end")
    )


def day_bounds(
    log: DataFrame, id_col: str, time_col: str, first: dt.date, last: dt.date,
    margin: dt.timedelta = ONE_HOUR, inclusive_end: bool = False, near: dt.timedelta = ONE_DAY,
) -> DataFrame:
    """For each day, the last row at or before (start - margin) and the first at or after (end + margin).

    The closest row is nearly always near, and a row found near is the closest of all. So the log is
    first read from `near` before the first wanted time to `near` after the last, a range the file scan
    can prune by. Days that stay open on a side all want the same row, the closest one outside of that
    range; one aggregate over the rest of the log finds it. The result, a row per day, is pinned.
    """
    low = dt.datetime.combine(first, dt.time()) - margin - near
    high = dt.datetime.combine(last, dt.time()) + ONE_DAY + margin + near
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (low, high))
    t = F.col(time_col)
    nearby = log.where(t.between(low, high))
    found = pin(_bounds_in(nearby, id_col, time_col, first, last, margin, inclusive_end))
    is_open = F.col("logged_start_id").isNull() | F.col("logged_end_id").isNull()
    if found.where(is_open).isEmpty():
        return found

    pair = F.struct(t.alias("t"), F.col(id_col).alias("i"))
    outside = log.where((t < low) | (t > high)).agg(
        F.max(F.when(t < low, pair)).alias("before"), F.min(F.when(t > high, pair)).alias("after")
    ).first()
    kinds = {f.name: f.dataType for f in found.schema.fields}
    closest = {
        "logged_start_id": outside.before and outside.before.i,
        "logged_start_datetime": outside.before and outside.before.t,
        "logged_end_id": outside.after and outside.after.i,
        "logged_end_datetime": outside.after and outside.after.t,
    }
    return found.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(kinds[c])) for c, value in closest.items()}
    )


def _bounds_in(
    log: DataFrame, id_col: str, time_col: str, first: dt.date, last: dt.date,
    margin: dt.timedelta, inclusive_end: bool,
) -> DataFrame:
    """Day bounds as far as these rows of the log tell.

    Wanted times are a day apart, so plain date arithmetic tells the first wanted time at or after a
    row and the last one at or before it. A hash aggregate per such slot leaves a few rows per day;
    running extremes over the days then also answer days whose neighbourhood is empty. A second narrow
    pass looks up the IDs of the times found.
    """
    days = (last - first).days + 1
    t = F.col(time_col)
    end_shift = margin if inclusive_end else margin - _TICK
    # Slot k: "at or before start of day k, less margin" / "at or after end of day k, plus margin".
    before = F.date_diff(F.to_date(t + _span(margin) - _span(_TICK)), F.lit(first)) + 1
    after = F.date_diff(F.to_date(t - _span(end_shift)), F.lit(first)) - 1
    extremes = log.groupBy(
        F.least(F.greatest(before, F.lit(0)), F.lit(days)).alias("before"),
        F.greatest(F.least(after, F.lit(days - 1)), F.lit(-1)).alias("after"),
    ).agg(F.max(t).alias("latest"), F.min(t).alias("earliest"))

    # From here to the second pass: one row per day at most.
    none = F.lit(None).cast("timestamp_ntz")
    slots = extremes.select(
        F.inline(
            F.array(
                F.struct(F.col("before").alias("slot"), F.col("latest"), none.alias("earliest")),
                F.struct(F.col("after").alias("slot"), none.alias("latest"), F.col("earliest")),
            )
        )
    ).where(F.col("slot").between(0, days - 1))
    slots = slots.groupBy("slot").agg(F.max("latest").alias("latest"), F.min("earliest").alias("earliest"))
    spine = day_spine(log.sparkSession, first, last, inclusive_end)
    spine = spine.withColumn("slot", F.date_diff("day", F.lit(first)))
    up_to = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.orderBy("slot").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    times = spine.join(slots, "slot", "left").select(
        "date", "start", "end",
        F.max("latest").over(up_to).alias("logged_start_datetime"),
        F.min("earliest").over(onward).alias("logged_end_datetime"),
    )

    # The shuffled slots serve all uses of `times`; at most two wanted times per day are broadcast.
    found = times.select(F.explode(F.array("logged_start_datetime", "logged_end_datetime")).alias("at"))
    found = found.where(F.col("at").isNotNull()).distinct()
    ids = (
        log.join(F.broadcast(found), t == F.col("at"), "inner")
        .groupBy("at")
        .agg(F.max(id_col).alias("last_id"), F.min(id_col).alias("first_id"))
    )
    start_ids = ids.select(F.col("at").alias("logged_start_datetime"), F.col("last_id").alias("logged_start_id"))
    end_ids = ids.select(F.col("at").alias("logged_end_datetime"), F.col("first_id").alias("logged_end_id"))
    return (
        times.join(start_ids, "logged_start_datetime", "left")
        .join(end_ids, "logged_end_datetime", "left")
        .select(
            "date", "start", "end", "logged_start_id", "logged_start_datetime", "logged_end_id",
            "logged_end_datetime",
        )
    )


def save_bounds(bounds: DataFrame, path: str, text: bool = False) -> None:
    """Keep a day-bounds table, sorted by start, as one small file; as comma-separated `text` if asked."""
    ordered = bounds.coalesce(1).sortWithinPartitions("start")
    if text:
        write_text(ordered, path, sep=",", mode="overwrite")
    else:
        ordered.write.mode("overwrite").parquet(path)


def load_bounds(
    spark: SparkSession, path: str, first: dt.datetime | None = None, last: dt.datetime | None = None,
    text: bool = False,
) -> DataFrame:
    """A kept day-bounds table, cut to days that start in [first, last]."""
    if text:
        bounds = read_text(spark, path, struct_of("day_bounds"), sep=",")
    else:
        bounds = spark.read.parquet(path)
    if first is not None:
        bounds = bounds.where(F.col("start") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        bounds = bounds.where(F.col("start") <= F.lit(last).cast("timestamp_ntz"))
    return bounds
