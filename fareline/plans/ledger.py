"""An export that can be run again: a ledger of what each extract was made from.

For each table and day the ledger keeps a digest of the day's bounds, of how it is written, and of its rows. A rerun
writes only days that the ledger lacks or that are made from something else now. Rows are written first, each day's folder
replaced as a whole when the job commits, and the ledger after them, in one append: a run that is cut off between the two
writes the same days again, and one cut off before leaves what was there.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.operators.export import empty
from fareline.plans.daily_export import LOG_TABLES, export_rows
from fareline.session import broadcast_if_small, pin
from fareline.sources.sinks import export_name, write_missing_headers, write_text, written_values

_LEDGER = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("export", T.StringType()), T.StructField("made_from", T.StringType()),
     T.StructField("rows", T.LongType()), T.StructField("written", T.TimestampType())]
)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The last entry of each extract: table, export, made_from, rows, written."""
    path = f"{root}/_ledger"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return empty(spark, _LEDGER)
    last = Window.partitionBy("table", "export").orderBy(F.desc("written"), F.desc("made_from"))
    entries = spark.read.schema(_LEDGER).parquet(path)
    return entries.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def fingerprints(rows: DataFrame, days: DataFrame, name: str, how: Mapping) -> DataFrame:
    """(export, made_from, rows) of every day, those without rows too.

    Hashes of rows are added up, so that the order of rows and tasks plays no part, and equal rows count each.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns if c != "export"]
    one = F.xxhash64(*shown, *[F.col(c).isNull() for c in rows.columns if c != "export"])
    # Two halves, each a sum of 32-bit numbers, cannot overflow.
    low, high = F.sum(one.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(one, 32))
    seen = rows.groupBy("export").agg(F.count("*").alias("rows"), F.concat_ws(".", low, high).alias("content"))
    bounds = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in days.columns]), {"ignoreNullFields": "false"})
    wanted = days.select(export_name(name, "start", "end").alias("export"), bounds.alias("day"))
    setting = F.lit(json.dumps(dict(how), sort_keys=True, default=str))
    columns = F.lit(",".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields))
    made = F.sha2(F.concat_ws("|", "day", setting, columns, F.coalesce("content", F.lit("none"))), 256)
    return wanted.join(seen, "export", "left").select("export", made.alias("made_from"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def export_changed(
    tables: Mapping[str, DataFrame], name: str, days: DataFrame, root: str, *, compressed: bool = True, exact_nulls: bool = False, **options
) -> list[str]:
    """Bring the extracts of a log table below `root/name` up to date; returns the names that were written.

    A day is written if the ledger lacks it, if its bounds, its rows, its columns or how it is written have changed, or if its
    folder is gone. All of them are written in one job, those without rows as headers in a second one.
    """
    spark, path, how = days.sparkSession, f"{root}/{name}", {"compressed": compressed, "exact_nulls": exact_nulls}
    days = pin(days)
    rows = pin(export_rows(tables, name, days, **options))
    now = pin(fingerprints(rows, days, name, how | options))
    known = read_ledger(spark, root).where(F.col("table") == name).select("export", F.col("made_from").alias("before"))
    # One name a day from here on.
    there = spark.createDataFrame([(v,) for v in written_values(spark, path)], "export string").withColumn("there", F.lit(True))
    compared = now.join(known, "export", "left").join(there, "export", "left")
    stale = pin(compared.where(~F.col("made_from").eqNullSafe(F.col("before")) | F.col("there").isNull()).select("export", "made_from", "rows"))
    names = sorted(r.export for r in stale.collect())
    if not names:
        return []
    if not stale.where("rows > 0").isEmpty():
        fresh = rows.join(broadcast_if_small(stale.select("export")), "export", "left_semi").select(*rows.columns)
        write_text(fresh, path, by="export", replace_values=True, **how)
    # Days that have lost all their rows keep no old file.
    emptied = [r.export for r in stale.where("rows = 0").collect()]
    for folder in [f"{path}/export={n}" for n in emptied if n in written_values(spark, path)]:
        old = spark._jvm.org.apache.hadoop.fs.Path(folder)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    written = T.StructType([f for f in rows.schema if f.name != "export"])
    write_missing_headers(spark, path, emptied, written, **how)
    entry = stale.select(F.lit(name).alias("table"), "export", "made_from", "rows", F.current_timestamp().alias("written"))
    entry.coalesce(1).write.mode("append").parquet(f"{root}/_ledger")
    return names


def export_all_changed(tables: Mapping[str, DataFrame], days: DataFrame, root: str, **options) -> dict[str, list[str]]:
    """`export_changed` for every log table; after a run that was cut off, only what is missing is written."""
    return {name: export_changed(tables, name, days, root, **options) for name in LOG_TABLES}
