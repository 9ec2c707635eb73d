"""Daily export of the five log tables: all days of a table in one job."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline import schemas
from fareline.operators.bounds import key_bounds
from fareline.operators.export import (
    assign_days, child_of_range, clean_text, conform, drop_accessory, in_time, with_constant_nulls,
)
from fareline.session import pin
from fareline.sources.scans import id_range
from fareline.sources.sinks import (
    export_name, part_names, write_missing_headers, write_split, write_text,
)


@dataclass(frozen=True)
class LogTable:
    """How a log table is cut: by which ID and time, and whose they are when it is a child."""

    id_col: str
    time_col: str
    parent: str | None = None
    parent_id: str | None = None


# The exported tables and the columns that bound them.
LOG_TABLES = {
    "Treatment": LogTable("TreatmentID", "LoggedUTC"),
    "TreatmentProductRanked": LogTable(
        "TreatmentIDLook", "MinLoggedUTC", "TreatmentDistinctRanked", "MinTreatmentID"
    ),
    "TreatmentProduct": LogTable("TreatmentID", "LoggedUTC", "Treatment", "TreatmentID"),
    "TreatmentProductInputParameterPivot": LogTable(
        "TreatmentID", "LoggedUTC", "Treatment", "TreatmentID"
    ),
    "TreatmentDistinctRanked": LogTable("MinTreatmentID", "MinLoggedUTC"),
}


LOWEST, HIGHEST = -(2**63), 2**63 - 1


def pull(tables: Mapping[str, DataFrame], name: str, low, high, bounds: str = "inclusive") -> DataFrame:
    """The declared columns of a log table's rows in an ID range."""
    cut = LOG_TABLES[name]
    schema = schemas.struct_of(name)
    if cut.parent is None:
        present = [c for c in schema.names if c in tables[name].columns]
        rows = id_range(tables[name], present, cut.id_col, low, high, bounds)
    else:
        rows = child_of_range(
            tables[name], tables[cut.parent], cut.id_col, cut.parent_id, low, high,
            [cut.time_col], bounds,
        )
    return with_constant_nulls(rows, name)


def _widest(days: DataFrame) -> tuple[int, int]:
    """ID range that covers all days; a day without a bound on one side opens that side."""
    low, high = F.coalesce("logged_start_id", F.lit(LOWEST)), F.coalesce("logged_end_id", F.lit(HIGHEST))
    widest = days.agg(F.min(low).alias("low"), F.max(high).alias("high")).first()
    return (LOWEST, HIGHEST) if widest.low is None else (widest.low, widest.high)


def export_rows(
    tables: Mapping[str, DataFrame], name: str, days: DataFrame, *, inclusive_end: bool = True,
    strict: bool = True, bounds: str = "inclusive", keep_range: bool = False,
) -> DataFrame:
    """Typed, cleaned rows of all days of a bounds table, with the extract's name in `export`.

    The widest ID range of the days prunes the scan; each day's own range and times select its rows.
    `keep_range` adds the day's own IDs, `day_low` and `day_high` (null on a side that is open).
    """
    cut = LOG_TABLES[name]
    low, high = _widest(days)
    pulled = pull(tables, name, low, high, bounds)
    # The days' whole span of time reaches the scan too, for logs that are laid out by time.
    span = days.agg(F.min("start").alias("first"), F.max("end").alias("last")).first()
    if span.first is not None:
        pulled = in_time(pulled, cut.time_col, span.first, span.last)
    rows = conform(pulled, schemas.struct_of(name), strict)
    ranges = days.select(
        F.col("start").alias("day_start"), F.col("end").alias("day_end"),
        F.coalesce("logged_start_id", F.lit(low)).alias("day_low"),
        F.coalesce("logged_end_id", F.lit(high)).alias("day_high"),
        F.col("logged_start_id").alias("__low"), F.col("logged_end_id").alias("__high"),
    )
    dated = assign_days(rows, cut.time_col, ranges, "day_start", "day_end", inclusive_end)
    dated = dated.where(F.col(cut.id_col).between(F.col("day_low"), F.col("day_high")))
    named = dated.withColumn("export", export_name(name, "day_start", "day_end"))
    kept = drop_accessory(named.select(*rows.columns), cut.time_col).columns
    own = {"day_low": "__low", "day_high": "__high"} if keep_range else {}
    shown = named.select(*kept, "export", *[F.col(c).alias(new) for new, c in own.items()])
    return clean_text(shown, keep=[*schemas.categorical_columns(name), "export", *own])


def export_table(
    tables: Mapping[str, DataFrame], name: str, days: DataFrame, root: str, *, split: bool = False,
    compressed: bool = True, exact_nulls: bool = False, mode: str = "errorifexists", **options,
) -> None:
    """Write one folder per day below `root/name`; with `split`, one per half of each day's own ID range.

    Days without rows get an extract with a header alone.
    """
    rows = export_rows(tables, name, days, keep_range=split, **options)
    path = f"{root}/{name}"
    how = {"compressed": compressed, "exact_nulls": exact_nulls, "mode": mode}
    names = [r.name for r in days.select(export_name(name, "start", "end").alias("name")).collect()]
    if not split:
        write_text(rows, path, by="export", **how)
    else:
        cut = LOG_TABLES[name]
        known = key_bounds(tables[cut.parent or name], cut.parent_id or cut.id_col).first()
        # A side left open by the day ends at the table's own last ID.
        low = F.coalesce("day_low", F.lit(known.min_id or 0).cast("bigint"))
        high = F.coalesce("day_high", F.lit(known.max_id or 0).cast("bigint"))
        write_split(rows, path, F.col("export"), cut.id_col, low, high, drop=["day_low", "day_high"], **how)
        names = [part for n in names for part in part_names(n, 2)]
    written = T.StructType([f for f in rows.schema if f.name not in ("export", "day_low", "day_high")])
    write_missing_headers(days.sparkSession, path, names, written, **how)


def export_all(tables: Mapping[str, DataFrame], days: DataFrame, root: str, **options) -> None:
    """Export every log table, each over all days; the tables' jobs share the cluster side by side."""
    days = pin(days)
    with ThreadPoolExecutor(len(LOG_TABLES)) as pool:
        for done in [pool.submit(export_table, tables, name, days, root, **options) for name in LOG_TABLES]:
            done.result()
