"""Checks on written extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_report(rows: DataFrame, name: str, bad_row: str = "bad_row") -> DataFrame:
    """Rows and unparsable rows of each extract, for rows read without `strict`."""
    bad = F.count(bad_row)
    # Only columns a query uses are parsed, so all must take part for all to be checked.
    used = F.count(F.coalesce(*[F.col(c).cast("string") for c in rows.columns if c not in (name, bad_row)]))
    total = F.greatest(F.count("*"), used)
    return rows.groupBy(name).agg(
        total.alias("rows"), bad.alias("bad_rows"), (bad == 0).alias("parses")
    )


def time_report(rows: DataFrame, name: str, time_col: str) -> DataFrame:
    """Number of rows, first and last time of each extract."""
    return rows.groupBy(name).agg(
        F.count("*").alias("rows"), F.min(time_col).alias("first"), F.max(time_col).alias("last")
    )


def name_day(name: Column | str) -> Column:
    """Day of month at the end of an extract's name; null if there is none."""
    digits = F.regexp_extract(name, r"-(\d{1,2})(_part\d+)?$", 1)
    return F.when(digits != "", digits.cast("int"))


def named(rows: DataFrame, name: str, contains: str = "", first_day: int = 1, last_day: int = 31) -> DataFrame:
    """Rows of the extracts whose name holds a text and ends in a day of [first_day, last_day]."""
    return rows.where(F.col(name).contains(contains) & name_day(name).between(first_day, last_day))


def unsigned_report(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column, rows, out_of_range) for columns that must lie in 0..limit: one pass, one row each."""
    outside = [
        F.count_if((F.col(c) < 0) | (F.col(c) > limit)).alias(f"o{i}")
        for i, (c, limit) in enumerate(limits.items())
    ]
    totals = df.agg(F.count("*").alias("rows"), *outside)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"o{i}").alias("out_of_range"))
        for i, c in enumerate(limits)
    ]
    return totals.select(F.inline(F.array(*entries)))
