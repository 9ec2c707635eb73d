"""A zone map of a log: the lowest and highest ID and time of each run of rows, kept beside the log.

The log is a folder of Parquet files that come and go. The map is a folder too, to which each refresh appends the zones of
files it has not seen; files already known are not opened. A zone counts only while its file is listed with the size and
time it was read with, so that replaced and deleted files drop out by themselves, a refresh that fails leaves nothing
behind, and two at once do no harm.

Lookups by time first find, in the map alone, the zones that can hold the answer, and open only their files.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.operators.bounds import ONE_HOUR, _bounds_in, day_spine, id_at_time
from fareline.operators.intervals import assign_intervals
from fareline.session import pin
from fareline.sources.scans import id_range

#: Rows of a file that make one zone.
ZONE_ROWS = 1 << 20
_FILE = ["file", "size", "modified"]


def list_log(spark: SparkSession, log: str) -> DataFrame:
    """The Parquet files below a folder (file, size, modified); no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(log)
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified")
    )


def _written(spark: SparkSession, zones: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(zones)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.parquet(zones) if there else None


def open_files(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.parquet(*[unquote(f) for f in files])


def refresh_zones(spark: SparkSession, log: str, zones: str, id_col: str, time_col: str, zone_rows: int = ZONE_ROWS) -> int:
    """Add the zones of files that the map does not know; returns how many files were read (only their ID and time)."""
    known, listed = _written(spark, zones), list_log(spark, log)
    fresh = listed if known is None else listed.join(known.select(*_FILE).distinct(), _FILE, "left_anti")
    files = [r.file for r in fresh.select("file").collect()]  # names, as the scan itself needs them
    if not files:
        return 0
    rows = open_files(spark, files).select(
        id_col, time_col, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"), F.call_function("div", F.col("_metadata.row_index"), F.lit(zone_rows)).alias("zone"),
    )
    made = rows.groupBy(*_FILE, "zone").agg(
        F.count("*").alias("rows"), F.min(id_col).alias("low_id"), F.max(id_col).alias("high_id"),
        F.min(time_col).alias("low_time"), F.max(time_col).alias("high_time"),
    )
    # A file without rows has one zone without bounds, so that it is known.
    empty = fresh.join(made.select(*_FILE).distinct(), _FILE, "left_anti")
    kinds = {f.name: f.dataType for f in made.schema}
    blank = empty.select(*[F.col(c) if c in _FILE else F.lit(0 if c in ("zone", "rows") else None).cast(kinds[c]).alias(c) for c in made.columns])
    made.unionByName(blank).write.mode("append").parquet(zones)
    return len(files)


def read_zones(spark: SparkSession, log: str, zones: str) -> DataFrame:
    """The zones of the files that are listed now; a zone that two refreshes wrote counts once."""
    known = _written(spark, zones)
    if known is None:
        raise FileNotFoundError(f"no zone map at {zones}; refresh it first")
    return known.join(list_log(spark, log), _FILE, "left_semi").dropDuplicates([*_FILE, "zone"])


def zones_of_ids(zones: DataFrame, low, high) -> DataFrame:
    """Zones that can hold an ID in low..high."""
    return zones.where((F.col("high_id") >= low) & (F.col("low_id") <= high))


def zones_at_times(zones: DataFrame, targets: DataFrame, direction: str = "before") -> DataFrame:
    """Zones that can hold the row closest to a target (`at`) on one side: (at, file, zone, ..).

    Before: of the zones that end at or before the target, those that end last; and the zones that hold the target. No
    other zone has a row between that end and the target. After is the mirror image. Zones may overlap in any way.
    """
    if direction not in ("before", "after"):
        raise ValueError(f"direction must be before or after, not {direction!r}")
    bounded = zones.where("low_time is not null")
    holding = assign_intervals(targets, "at", bounded, "low_time", "high_time")
    # For each target the last end before it: targets and ends in order, one running extreme for each day, then the days'.
    edge = "high_time" if direction == "before" else "low_time"
    ends = bounded.select(F.col(edge).alias("edge")).distinct()
    daily = ends.groupBy(F.to_date("edge").alias("day")).agg(F.min("edge").alias("first"), F.max("edge").alias("last"))
    days = targets.select("at", F.to_date("at").alias("day")).distinct()
    same = days.join(ends.withColumn("day", F.to_date("edge")), "day")
    if direction == "before":
        near = same.where("edge <= at").groupBy("at").agg(F.max("edge").alias("edge"))
        other = _closest_day(days, daily, "last")
        best = near.unionByName(other).groupBy("at").agg(F.max("edge").alias("edge"))
    else:
        near = same.where("edge >= at").groupBy("at").agg(F.min("edge").alias("edge"))
        other = _closest_day(days, daily, "first")
        best = near.unionByName(other).groupBy("at").agg(F.min("edge").alias("edge"))
    ending = best.join(bounded, best["edge"] == bounded[edge]).drop("edge")
    columns = ["at", *zones.columns]
    return holding.select(*columns).unionByName(ending.select(*columns)).distinct()


def _closest_day(days: DataFrame, daily: DataFrame, edge: str) -> DataFrame:
    """(at, edge): the closest edge on a day before (`last`) or after (`first`) that of each target.

    One row for each day of zones or targets goes through the window, far fewer than zones.
    """
    wanted = days.select("day").distinct()
    line = wanted.join(daily.select("day", edge), "day", "full_outer")
    around = Window.orderBy("day")
    if edge == "last":
        found = F.max(edge).over(around.rowsBetween(Window.unboundedPreceding, -1))
    else:
        found = F.min(edge).over(around.rowsBetween(1, Window.unboundedFollowing))
    return days.join(line.select("day", found.alias("edge")), "day").where("edge is not null").select("at", "edge")


def files_of(zones: DataFrame) -> list[str]:
    return sorted(r.file for r in zones.select("file").distinct().collect())  # a few for each target


def id_range_in_zones(spark: SparkSession, zones: DataFrame, columns: list[str], id_col: str, low, high, schema: T.StructType) -> DataFrame:
    """`id_range` that opens only the files of zones that reach into the range."""
    files = files_of(zones_of_ids(zones, low, high))
    log = open_files(spark, files) if files else spark.createDataFrame([], schema)
    return id_range(log, columns, id_col, low, high)


def id_at_time_in_zones(
    spark: SparkSession, zones: DataFrame, id_col: str, time_col: str, target: dt.datetime, direction: str = "before", tolerance_s: int = 300
) -> DataFrame:
    """`id_at_time` that opens only the files that can hold the answer."""
    at = spark.range(1).select(F.lit(target).cast("timestamp_ntz").alias("at"))
    files = files_of(zones_at_times(zones, at, direction))
    kinds = zones.schema
    schema = T.StructType([T.StructField(id_col, kinds["low_id"].dataType), T.StructField(time_col, kinds["low_time"].dataType)])
    log = open_files(spark, files) if files else spark.createDataFrame([], schema)
    return id_at_time(log, id_col, time_col, target, direction, tolerance_s)


def day_bounds_in_zones(
    spark: SparkSession, zones: DataFrame, id_col: str, time_col: str, first: dt.date, last: dt.date, margin: dt.timedelta = ONE_HOUR,
    inclusive_end: bool = False,
) -> DataFrame:
    """`day_bounds` of the log that a zone map describes; opens only files with an answer to one of the days."""
    days = day_spine(spark, first, last, inclusive_end)
    before = zones_at_times(zones, days.select((F.col("start") - F.lit(margin)).alias("at")))
    after = zones_at_times(zones, days.select((F.col("end") + F.lit(margin)).alias("at")), "after")
    files = files_of(before.select("file").unionByName(after.select("file")))
    kinds = zones.schema
    schema = T.StructType([T.StructField(id_col, kinds["low_id"].dataType), T.StructField(time_col, kinds["low_time"].dataType)])
    log = open_files(spark, files).select(id_col, time_col) if files else spark.createDataFrame([], schema)
    return pin(_bounds_in(log, id_col, time_col, first, last, margin, inclusive_end))
