"""Points in intervals of any length: an equi-join on the cells of a tree over time.

Seconds are the lowest cells; 60 of them make a minute, 60 minutes an hour, 24 hours a day, and from there on eight cells
make one of the next level. An interval is covered by the fewest whole cells: a bounded number at each level, whatever its
length. A time lies in one cell of each level, and only levels that some interval uses are asked: one or two for a table
of whole days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.session import broadcast_if_small, pin

#: How many cells of each level make one of the next; with twos alone the cover is dyadic.
RADICES = (60, 60, 24, 8, 8, 8, 8)


def second_of(df: DataFrame, c: str) -> Column:
    """Whole seconds since 1970, without any time zone for times that have none."""
    if isinstance(df.schema[c].dataType, T.TimestampType):
        return F.unix_seconds(c)
    at = F.col(c).cast("timestamp_ntz")
    day = F.date_diff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)


def cover(first: str, last: str, radices: Sequence[int] = RADICES) -> Column:
    """The fewest whole cells (level, cell) that make up first..last, names of columns of whole seconds.

    From below, the cells at both ends that do not fill one of the next level are taken; the rest moves up. Null or empty
    ranges have no cells.
    """
    none = "cast(array() as array<struct<level:int,cell:bigint>>)"
    cells = lambda x, y: f"if({x} < {y}, transform(sequence({x}, {y} - 1), c -> named_struct('level', s.level, 'cell', c)), {none})"
    down = "((s.hi - pmod(s.hi, r)) div r)"
    up = "((s.lo + pmod(-s.lo, r)) div r)"
    return F.expr(
        f"""if({first} is null or {last} is null or {first} > {last}, {none}, aggregate(
            array({', '.join(f'{r}L' for r in (*radices, 1 << 40))}),
            named_struct('lo', {first}, 'hi', {last} + 1L, 'level', 0, 'out', {none}),
            (s, r) -> if({up} < {down},
                named_struct('lo', {up}, 'hi', {down}, 'level', s.level + 1,
                    'out', concat(s.out, {cells('s.lo', f'{up} * r')}, {cells(f'{down} * r', 's.hi')})),
                named_struct('lo', 0L, 'hi', 0L, 'level', s.level + 1, 'out', concat(s.out, {cells('s.lo', 's.hi')}))),
            s -> s.out))"""
    )


def cell_at(second: Column, level: int, radices: Sequence[int] = RADICES) -> Column:
    width = 1
    for r in radices[:level]:
        width *= r
    return F.call_function("div", second - F.pmod(second, F.lit(width)), F.lit(width))


def assign_intervals(
    df: DataFrame, time_col: str, intervals: DataFrame, start: str = "start", end: str = "end",
    inclusive_end: bool = True, radices: Sequence[int] = RADICES,
) -> DataFrame:
    """One row per (row, interval that holds its time), with the interval's columns attached.

    Intervals may overlap and be of any length. Rows without a time, and intervals without both ends or that end before
    they start, meet nothing. Covering cells do not overlap, so a pair meets once; the exact test on top tells apart
    what lies inside one second. The cells are broadcast only while they are few.
    """
    bounded = intervals.withColumns({"__lo": second_of(intervals, start), "__hi": second_of(intervals, end)})
    cells = bounded.withColumn("__cell", F.explode(cover("__lo", "__hi", radices))).drop("__lo", "__hi")
    cells = pin(cells)
    levels = sorted(r.level for r in cells.select("__cell.level").distinct().collect())  # as many as there are radices
    second = second_of(df, time_col)
    keys = F.array(*[F.struct(F.lit(k).alias("level"), cell_at(second, k, radices).alias("cell")) for k in levels])
    rows = df.where(F.col(time_col).isNotNull())
    if not levels:
        return rows.join(intervals.limit(0), F.lit(False), "inner")
    t = F.col(time_col)
    inside = (t >= F.col(start)) & ((t <= F.col(end)) if inclusive_end else (t < F.col(end)))
    asked = rows.withColumn("__at", F.explode(keys))
    return asked.join(broadcast_if_small(cells), (F.col("__at") == F.col("__cell")) & inside, "inner").drop("__at", "__cell")


def totals_in_intervals(
    df: DataFrame, time_col: str, intervals: DataFrame, value: str, start: str = "start", end: str = "end",
    names: Sequence[str] = ("rows", "lowest", "highest"), radices: Sequence[int] = RADICES,
) -> DataFrame:
    """The intervals that hold some row's time, ends included, with the number of rows and their lowest and highest value.

    What `assign_intervals` and a grouping by all columns of the intervals give, but pairs are never made: rows are added
    up by cell first, once for each level, and an interval meets the few cells that cover it. Only its first and its last
    second, which it may hold in part, meet the times inside them one by one.
    """
    n, low, high = names
    totals = [F.sum("__n").alias("__n"), F.min("__low").alias("__low"), F.max("__high").alias("__high")]
    known = df.where(F.col(time_col).isNotNull()).groupBy(F.col(time_col).alias("__t"))
    times = known.agg(F.count("*").alias("__n"), F.min(value).alias("__low"), F.max(value).alias("__high"))
    times = pin(times.withColumn("__second", second_of(times, "__t")))

    bounded = intervals.withColumns({"__lo": second_of(intervals, start), "__hi": second_of(intervals, end)})
    bounded = bounded.where(F.col(start) <= F.col(end))
    kept = intervals.columns
    covered = bounded.withColumn("__inside", cover("(__lo + 1)", "(__hi - 1)", radices))
    cells = pin(covered.select(*kept, F.explode("__inside").alias("__cell")))
    levels = sorted(r.level for r in cells.select("__cell.level").distinct().collect())  # as many as there are radices
    edges = bounded.select(*kept, F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias("__second"))
    met = edges.join(times, "__second").where(F.col("__t").between(F.col(start), F.col(end)))
    met = met.select(*kept, "__n", "__low", "__high")
    if levels:
        places = F.array(*[F.struct(F.lit(k).alias("level"), cell_at(F.col("__second"), k, radices).alias("cell")) for k in levels])
        seconds = times.groupBy("__second").agg(*totals)
        summed = seconds.withColumn("__cell", F.explode(places)).groupBy("__cell").agg(*totals)
        met = met.unionByName(cells.join(summed, "__cell").select(*kept, "__n", "__low", "__high"))
    return met.groupBy(*kept).agg(F.sum("__n").alias(n), F.min("__low").alias(low), F.max("__high").alias(high))
