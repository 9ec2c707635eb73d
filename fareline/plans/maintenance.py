"""Upkeep of written extracts: recombining parts, strict re-reading, time ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline import schemas
from fareline.operators.quality import named, parse_report, time_report, unsigned_report
from fareline.plans.daily_export import LOG_TABLES
from fareline.sources.scans import read_text
from fareline.sources.sinks import combine_parts, extract_names, source_name


def exported_schema(table: str) -> T.StructType:
    """Schema of a written extract: the declared one without an accessory last column."""
    schema = schemas.struct_of(table)
    cut = LOG_TABLES.get(table)
    if cut and schema.names[-1] == cut.time_col:
        return T.StructType(schema.fields[:-1])
    return schema


def combine_all(spark: SparkSession, root: str, out: str, **options) -> None:
    for table in LOG_TABLES:
        combine_parts(spark, f"{root}/{table}", f"{out}/{table}", exported_schema(table), **options)


def check_extracts(
    spark: SparkSession, path: str, schema: T.StructType, contains: str = "", first_day: int = 1,
    last_day: int = 31, **options,
) -> DataFrame:
    """Rows and unparsable rows of each extract whose name fits; 0 for one with a header alone."""
    rows = read_text(spark, path, schema, strict=False, **options)
    if (contains, first_day, last_day) != ("", 1, 31):
        # Files of other names are left out before they are read.
        rows = named(rows.withColumn("export", source_name()), "export", contains, first_day, last_day).drop("export")
    # Counted by file first: names are taken from paths once a file, not once a row.
    files = parse_report(rows.withColumn("__file", F.col("_metadata.file_path")), "__file")
    report = files.groupBy(source_name(F.col("__file")).alias("export")).agg(
        F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"), F.bool_and("parses").alias("parses")
    )
    every = named(extract_names(spark, path), "export", contains, first_day, last_day)
    return every.join(report, "export", "left").select(
        "export", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("bad_rows", F.lit(0)).cast("bigint").alias("bad_rows"), F.coalesce("parses", F.lit(True)).alias("parses"),
    )


def time_ranges(
    spark: SparkSession, path: str, schema: T.StructType, time_col: str, contains: str = "",
    first_day: int = 1, last_day: int = 31, **options,
) -> DataFrame:
    """Row count, first and last time of each extract whose name fits."""
    rows = read_text(spark, path, schema, **options).withColumn("export", source_name())
    report = time_report(named(rows, "export", contains, first_day, last_day), "export", time_col)
    every = named(extract_names(spark, path), "export", contains, first_day, last_day)
    return every.join(report, "export", "left").select(
        "export", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "first", "last"
    )


def range_check(df: DataFrame, table: str) -> DataFrame:
    """Values outside the unsigned types of a declared table, per column."""
    return unsigned_report(df, schemas.unsigned_limits(table))
