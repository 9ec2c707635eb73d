"""Reading tables: ID ranges, read batches, database tables and strict delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Options shared by the text reader and writer.
TEXT = {
    "sep": ";", "header": "true", "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
# Keeps null and empty text apart; both sides must use it.
EXACT_NULLS = {"nullValue": "\\N"}


def in_range(id_col: str, low, high, bounds: str = "inclusive") -> Column:
    """ID range predicate; `bounds` is "inclusive" or "exclusive" (both ends)."""
    c = F.col(id_col)
    if bounds == "inclusive":
        return c.between(low, high)
    if bounds == "exclusive":
        return (c > low) & (c < high)
    raise ValueError(f"bounds must be inclusive or exclusive, not {bounds!r}")


def id_range(
    table: DataFrame, columns: Sequence[str], id_col: str, low, high, bounds: str = "inclusive"
) -> DataFrame:
    """Chosen columns of the rows whose ID lies in a range.

    Range and projection reach the file scan, where row-group statistics skip what lies outside.
    """
    return table.where(in_range(id_col, low, high, bounds)).select(*columns)


def with_batch(table: DataFrame, id_col: str, low: int, high: int, size: int = 100_000) -> DataFrame:
    """ID range scan that tells the read batch (0, 1, ..) of each row.

    The scan is one job over its own partitions, so the batch is a label and not a loop. The last
    batch is read whole even if it holds a single ID.
    """
    batch = F.floor((F.col(id_col) - F.lit(low)) / F.lit(size)).cast("long")
    return table.where(in_range(id_col, low, high)).withColumn("batch", batch)


def database_range(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], id_col: str,
    low: int, high: int, bounds: str = "inclusive", rows_per_batch: int = 100_000,
    max_connections: int = 64, properties: dict[str, str] | None = None,
) -> DataFrame:
    """ID range of a database table, read in parallel strides of the ID.

    The range predicate runs in the database; strides only divide the work among tasks.
    """
    strides = max(1, min(max_connections, -(-(high - low + 1) // rows_per_batch)))
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=id_col, lowerBound=str(low),
        upperBound=str(high + 1), numPartitions=str(strides), fetchsize="10000",
        **(properties or {}),
    )
    return id_range(reader.load(), columns, id_col, low, high, bounds)


def read_text(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, strict: bool = True,
    exact_nulls: bool = False, sep: str = ";", multi_line: bool = True, bad_row: str = "bad_row",
) -> DataFrame:
    """Delimited text under a declared schema.

    `strict` fails the job on the first row that does not parse. Otherwise such rows carry their text
    in the column `bad_row`. Either way Spark parses the columns a query uses, and only those.
    Files whose values hold no newline (carriage returns may) can be read with `multi_line=False`:
    then a large file is divided among tasks.
    """
    lines = {"multiLine": "true"} if multi_line else {"lineSep": "\n"}
    reader = spark.read.options(**{**TEXT, "sep": sep}, **lines)
    if exact_nulls:
        reader = reader.options(**EXACT_NULLS)
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    wider = T.StructType([*schema.fields, T.StructField(bad_row, T.StringType())])
    return (
        reader.schema(wider)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=bad_row)
        .csv(path)
    )
