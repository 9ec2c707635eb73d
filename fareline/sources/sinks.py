"""Writing delimited extracts, splitting and recombining them, and caching pulled tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.session import write_placed, writing
from fareline.sources.multiline import read_text_divided
from fareline.sources.scans import EXACT_NULLS, TEXT, read_text


def export_name(table: str, start: Column | str, end: Column | str, suffix: Column | str = "") -> Column:
    """`{table}_{start}_to_{end}{suffix}` with dates as yyyy-MM-dd."""
    tail = F.lit(suffix) if isinstance(suffix, str) else suffix
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return F.concat(F.lit(f"{table}_"), day(start), F.lit("_to_"), day(end), tail)


def write_text(
    df: DataFrame, path: str, *, by: str | None = None, compressed: bool = False,
    exact_nulls: bool = False, mode: str = "errorifexists", sep: str = ";", replace_values: bool = False,
) -> None:
    """Delimited text with a header, quoted only where needed, one folder per value of `by`.

    `replace_values` replaces the folders of the values that are written, and leaves those of other values as they are.

    Rows are first gathered by `by`, so that a value gets few files. The rebalance step splits a value
    that holds much of the table over many tasks and merges small ones, by measured size.
    """
    if by is not None:
        df = df.hint("rebalance", by)
    writer = df.write.mode(mode).options(
        **{**TEXT, "sep": sep}, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    )
    if exact_nulls:
        writer = writer.options(**EXACT_NULLS)
    if compressed:
        writer = writer.option("compression", "gzip")
    if by is not None:
        writer = writer.partitionBy(by)
    if replace_values:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.csv(path)


def part_number(id_col: str, low: Column | int, high: Column | int, parts: int = 2) -> Column:
    """Which of `parts` equal slices of the ID range low..high a row lies in (1, 2, ..), in whole numbers.

    The first slices have one ID more where the range does not divide evenly, so two parts are cut at the
    midpoint (low + high) div 2, which belongs to the first. Rows before the range, and those without an
    ID, go to the first part, rows behind it to the last.
    """
    low, high = (x if isinstance(x, Column) else F.lit(x).cast("bigint") for x in (low, high))
    div = lambda a, b: F.call_function("div", a, b)
    size, longer = div(high - low + 1, F.lit(parts)), (high - low + 1) % parts
    at, edge = F.col(id_col).cast("bigint") - low, longer * (size + 1)
    number = F.when(at < edge, div(at, size + 1)).otherwise(longer + div(at - edge, F.greatest(size, F.lit(1)))) + 1
    return F.coalesce(F.least(F.lit(parts), F.greatest(F.lit(1), number)), F.lit(1)).cast("int")


def part_names(name: str, parts: int) -> list[str]:
    return [f"{name}_part{k}" for k in range(1, parts + 1)]


def write_split(
    df: DataFrame, path: str, name: Column, id_col: str, low: Column | int, high: Column | int,
    parts: int = 2, by: str = "export", drop: Sequence[str] = (), **options,
) -> None:
    """Write an extract in parts named `{name}_part1`, `{name}_part2`, ..

    The range may differ from row to row; `drop` names columns that serve it alone.
    """
    part = part_number(id_col, low, high, parts).cast("string")
    write_text(df.withColumn(by, F.concat(name, F.lit("_part"), part)).drop(*drop), path, by=by, **options)


def written_values(spark: SparkSession, path: str, by: str = "export") -> set[str]:
    """The values of `by` that have a folder below `path`: one name for each extract."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return set()
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return {n.split("=", 1)[1] for n in names if n.startswith(f"{by}=")}


def header_line(names: Iterable[str], sep: str = ";") -> str:
    """The header that `write_text` puts above columns of these names."""
    quoted = ['"' + n.replace('"', '""') + '"' if any(c in n for c in (sep, '"', "\n", "\r")) else n for n in names]
    return sep.join(quoted)


def write_missing_headers(
    spark: SparkSession, path: str, names: Iterable[str], schema: T.StructType, by: str = "export", **options
) -> None:
    """An extract with a header alone for each name that has none: one write for all of them."""
    missing = sorted(set(names) - written_values(spark, path, by))
    if not missing:
        return
    header = F.lit(header_line(schema.names, options.get("sep", ";"))).alias("value")
    rows = spark.createDataFrame([(n,) for n in missing], T.StructType([T.StructField(by, T.StringType())]))
    writer = rows.select(by, header).write.mode("append").partitionBy(by)
    if options.get("compressed"):
        writer = writer.option("compression", "gzip")
    writer.text(path)


def source_name(path: Column | None = None) -> Column:
    """Name of the extract a row was read from: the file's folder value, else its file name."""
    path = F.col("_metadata.file_path") if path is None else path
    folder = F.regexp_extract(path, r"/[^/=]+=([^/]+)/[^/]+$", 1)
    file = F.regexp_extract(path, r"/([^/]+?)(\.csv)?(\.gz)?$", 1)
    return F.when(folder != "", folder).otherwise(file)


def extract_names(spark: SparkSession, path: str) -> DataFrame:
    """The names of all extracts below `path`, in `export`, those without rows too; no file is opened."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(source_name(F.col("path")).alias("export")).distinct()


def read_parts(
    spark: SparkSession, path: str, schema: T.StructType, by: str = "export", divided: bool = False, **reading
) -> DataFrame:
    """Rows of all part extracts below `path`, with the base name before `_part` in column `by`.

    Extracts that are not parts are left out. `divided` reads a large part by many tasks, line feeds inside texts or not.
    """
    if divided:
        reading = {k: v for k, v in reading.items() if k != "multi_line"}
        rows, file = read_text_divided(spark, path, schema, file="__file", **reading), F.col("__file")
    else:
        rows, file = read_text(spark, path, T.StructType([*schema.fields]), **reading), None
    return (
        rows.withColumn(by, source_name(file))
        .drop("__file")
        .where(F.col(by).contains("_part"))
        .withColumn(by, F.regexp_extract(by, r"^(.*)_part", 1))
    )


def combine_parts(
    spark: SparkSession, path: str, out: str, schema: T.StructType, *, by: str = "export",
    exact_nulls: bool = False, sep: str = ";", multi_line: bool = True, divided: bool = False, **writing,
) -> None:
    """Rewrite part extracts as one extract per base name.

    `sep` and `exact_nulls` hold for both sides. `divided` reads a large part by many tasks, and so does
    `multi_line=False` where no text holds a line feed, with less work. Bases whose parts have no rows get a header alone.
    """
    rows = read_parts(
        spark, path, schema, by, divided, exact_nulls=exact_nulls, sep=sep, multi_line=multi_line
    )
    write_text(rows, out, by=by, exact_nulls=exact_nulls, sep=sep, **writing)
    parts = extract_names(spark, path).where(F.col("export").contains("_part"))
    bases = parts.select(F.regexp_extract("export", r"^(.*)_part", 1).alias("base")).distinct()
    names = [r.base for r in bases.collect()]  # as many as extracts
    write_missing_headers(spark, out, names, schema, by, exact_nulls=exact_nulls, sep=sep, **writing)


def extract_path(root: str, origin: str, destination: str, start: dt.date, end: dt.date, prefix: str = "") -> str:
    """Where the extract of a route and date range is kept."""
    day = "%d-%b-%y"
    return f"{root}/{prefix}{origin}to{destination}.{start.strftime(day)}to{end.strftime(day)}"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at `path`; half-written folders have no success marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def cached_extract(
    spark: SparkSession, path: str, pull: Callable[[], DataFrame], *, force: bool = False,
    save: bool = True, by: str | None = None, parts: int = 1,
) -> DataFrame:
    """The extract kept at `path`, else (or if forced) pull it and keep it.

    Rows pulled in `parts` by the column `by` are kept so, and whoever pulled them reads them as placed.
    """
    if not force and is_written(spark, path):
        return spark.read.parquet(path)
    if not save:
        return pull()
    pulled = pull()
    if by is not None:
        return write_placed(pulled, path, by, parts, mode="overwrite")
    with writing(spark):
        pulled.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
