"""Typed, time-filtered and cleaned extracts of log tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline import schemas
from fareline.session import broadcast_if_small
from fareline.sources.scans import in_range


def null_column(table: str, name: str) -> Column:
    """A typed null under a declared column's name."""
    return F.lit(None).cast(schemas.struct_of(table)[name].dataType).alias(name)


def with_constant_nulls(df: DataFrame, table: str) -> DataFrame:
    """Add the declared columns that no source fills."""
    return df.withColumns({c: null_column(table, c) for c in schemas.CONSTANT_NULL.get(table, [])})


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Declared columns in declared order and type; absent ones come out null.

    A value that does not fit its type fails the job when `strict`, else becomes null.
    """
    present = set(df.columns)

    def shaped(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        cast = source.cast if strict else source.try_cast
        return cast(field.dataType).alias(field.name)

    return df.select(*[shaped(f) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def append_all(batches: Iterable[DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """All batches as one table; without any, an empty table with all columns."""
    out = empty(spark, schema)
    for batch in batches:
        out = out.unionByName(conform(batch, schema))
    return out


def child_of_range(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, low, high,
    carried: list[str], bounds: str = "inclusive",
) -> DataFrame:
    """Child rows whose parent lies in an ID range, with some of the parent's columns.

    The equi-join lets the optimizer put the same range on the child's scan.
    """
    wanted = parent.where(in_range(parent_key, low, high, bounds)).select(
        F.col(parent_key).alias("__parent"), *carried
    )
    child = child.drop(*carried)
    return child.join(wanted, F.col(child_key) == F.col("__parent"), "inner").drop("__parent")


def in_time(df: DataFrame, time_col: str, start, end, inclusive_end: bool = True) -> DataFrame:
    """Rows with start <= time <= end (or < end)."""
    t = F.col(time_col)
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return df.where((t >= low) & ((t <= high) if inclusive_end else (t < high)))


def assign_days(
    df: DataFrame, time_col: str, days: DataFrame, start: str = "start", end: str = "end",
    inclusive_end: bool = True,
) -> DataFrame:
    """One row per (row, day range that holds its time), with the range's columns attached.

    Ranges are cut at midnights first, which turns the interval join into an equi-join on the
    calendar day with the exact test on top. The ranges are broadcast while they are few.
    """
    pieces = days.withColumn(
        "__day", F.explode(F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day")))
    )
    t = F.col(time_col)
    inside = (t >= F.col(start)) & ((t <= F.col(end)) if inclusive_end else (t < F.col(end)))
    pieces = broadcast_if_small(pieces)
    return df.join(pieces, (F.to_date(t) == F.col("__day")) & inside, "inner").drop("__day")


def drop_accessory(df: DataFrame, name: str) -> DataFrame:
    """Drop a column if it is the last one."""
    return df.drop(name) if df.columns[-1] == name else df


def clean_text(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Replace each newline and tab of the text columns, except those in `keep`, by a blank."""
    spared = set(keep)
    cleaned = {
        f.name: F.translate(F.col(f.name), "\n\t", "  ")
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in spared
    }
    return df.withColumns(cleaned) if cleaned else df
