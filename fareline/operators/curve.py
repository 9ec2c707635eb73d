"""Daily booking curve of each flight: counts, running totals, gap filling and the forecast table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.functions.nulls import sum_or_zero
from fareline.functions.ordered import fill_forward
from fareline.operators.journeys import FAR_DATE, LONGEST_LEAD_DAYS

FLIGHT = ["CarrierCode", "FlightNumber", "STD"]
SERIES = ["FlightKey", "Compartment", "CarrierCode", "FlightNumber", "STD", "STDUTC"]
DAY = "CreatedUTC"
COUNTS = ["bookings", "group_bookings"]
# Order of rows of one flight: by capture day, then by what else tells them apart.
DAY_ORDER = [DAY, "Compartment", "FlightKey", "STDUTC"]


def with_group_flag(legs: DataFrame, groups: DataFrame) -> DataFrame:
    """Add GroupBooking 1/0 and Booking 1."""
    flagged = legs.join(groups, "BookingID", "left")
    return flagged.withColumns(
        {
            "GroupBooking": F.when(F.coalesce("GroupBooking", F.lit(False)), 1).otherwise(0),
            "Booking": F.lit(1),
        }
    )


def daily_counts(
    rows: DataFrame, keys: Sequence[str] = SERIES, time_col: str = DAY,
    counted: dict[str, str] | None = None,
) -> DataFrame:
    """Sums per series and calendar day; the day replaces the time column."""
    counted = counted or {"bookings": "Booking", "group_bookings": "GroupBooking"}
    sums = [sum_or_zero(c).cast("bigint").alias(name) for name, c in counted.items()]
    return rows.groupBy(F.to_date(time_col).alias(time_col), *keys).agg(*sums)


def departure_rows(daily: DataFrame, keys: Sequence[str] = SERIES, departure: str = "STD") -> DataFrame:
    """One zero row per series on its day of departure, so that every curve reaches it."""
    zeros = [F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    return daily.select(*keys).distinct().select(F.to_date(departure).alias(DAY), *keys, *zeros)


def add_up(*tables: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Union of daily tables with equal (day, series) rows summed."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.groupBy(DAY, *keys).agg(*[sum_or_zero(c).alias(c) for c in COUNTS])


def daily_with_departure(rows: DataFrame, keys: Sequence[str] = SERIES, departure: str = "STD") -> DataFrame:
    """What `add_up(daily, departure_rows(daily))` gives, in one shuffle.

    Each leg also counts zero on its day of departure; partial sums fold these rows before the shuffle.
    """
    counts = [F.col("Booking").cast("bigint"), F.col("GroupBooking").cast("bigint")]
    zero = F.lit(0).cast("bigint")
    booked = F.struct(F.to_date(DAY).alias("day"), counts[0].alias(COUNTS[0]), counts[1].alias(COUNTS[1]))
    departs = F.struct(F.to_date(departure).alias("day"), zero.alias(COUNTS[0]), zero.alias(COUNTS[1]))
    both = rows.select(*keys, F.inline(F.array(booked, departs))).withColumnRenamed("day", DAY)
    return both.groupBy(DAY, *keys).agg(*[sum_or_zero(c).alias(c) for c in COUNTS])


def running_totals(
    daily: DataFrame, flight: Sequence[str] = FLIGHT, order: Sequence[str] = DAY_ORDER,
    counts: Sequence[str] = COUNTS,
) -> DataFrame:
    """Add `{count}_cum`, the sum up to and with the row. A flight has a few rows per day at most."""
    so_far = Window.partitionBy(*flight).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return daily.withColumns({f"{c}_cum": F.sum(c).over(so_far) for c in counts})


def upsample_days(
    rows: DataFrame, flight: Sequence[str] = FLIGHT, order: Sequence[str] = DAY_ORDER, day: str = DAY,
    first_needed: Column | None = None,
) -> DataFrame:
    """Add a row for every missing day between a flight's first and last, null but for keys and day.

    Each row already knows where the next begins, so it spawns the missing days after it; no calendar
    is joined. Spawned rows have `filled` true and keep a copy of their origin in `origin`.
    `first_needed` leaves out spawned days before that date; nothing after it depends on them.
    """
    ahead = Window.partitionBy(*flight).orderBy(*order)
    next_day = F.lead(day).over(ahead)
    gap_from = F.date_add(day, 1)
    if first_needed is not None:
        gap_from = F.greatest(gap_from, first_needed)
    has_gap = F.col("__next") > gap_from
    days = F.when(
        has_gap, F.sequence(gap_from, F.date_sub("__next", 1), F.expr("interval 1 day"))
    )
    kept = [c for c in rows.columns if c != day]
    spread = F.concat(
        F.array(F.struct(F.col(day).alias("d"), F.lit(False).alias("filled"))),
        F.coalesce(
            F.transform(days, lambda d: F.struct(d.alias("d"), F.lit(True).alias("filled"))),
            F.array().cast("array<struct<d:date,filled:boolean>>"),
        ),
    )
    out = rows.withColumn("__next", next_day).select(*kept, F.inline(spread))
    blank = {c: F.when(~F.col("filled"), F.col(c)) for c in kept if c not in flight}
    return (
        out.withColumn("origin", F.struct(*[c for c in kept if c not in flight]))
        .withColumns(blank)
        .withColumnRenamed("d", day)
        .select(*rows.columns, "filled", "origin")
    )


def forward_fill(
    upsampled: DataFrame, carried: Sequence[str], zeroed: Sequence[str] = COUNTS
) -> DataFrame:
    """Give spawned days their origin's values in `carried` and zero in `zeroed`.

    The origin is the last row before the gap, so this equals carrying the last known value forward.
    """
    filled = {c: F.coalesce(F.col(c), F.col("origin")[c]) for c in carried}
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in zeroed}
    return upsampled.withColumns({**filled, **zero}).drop("filled", "origin")


def fill_gaps(
    rows: DataFrame, carried: Sequence[str], flight: Sequence[str] = FLIGHT,
    order: Sequence[str] = DAY_ORDER, **limits,
) -> DataFrame:
    """Replace nulls of `carried` by the flight's last known value; for series that come with gaps."""
    return fill_forward(rows, list(flight), list(order), list(carried), **limits)


CAPACITY_COLUMNS = [
    "FlightKey", "Compartment", "AdjustedCapacity", "STD", "STA", "Capacity", "Lid", "ClassLid",
    "ClassAdjustedCapacity",
]


def with_capacity(curve: DataFrame, inventory: DataFrame) -> DataFrame:
    """Attach the distinct capacities of (flight, compartment); null where inventory has none."""
    capacity = inventory.select(*CAPACITY_COLUMNS).distinct().withColumnRenamed("STD", "STD_inventory")
    return curve.join(capacity, ["FlightKey", "Compartment"], "left")


def forecast_columns(
    curve: DataFrame, airline: str, origin: str | None, destination: str | None,
    time_format: str = "HH:mm",
) -> DataFrame:
    """The 20 columns of the forecast table."""
    zero = F.lit(0)
    return curve.select(
        F.lit(airline).alias("oprg_carr_code"),
        F.col("FlightNumber").alias("oprg_flt_no"),
        F.lit(origin).cast("string").alias("leg_orgn_aipc"),
        F.lit(destination).cast("string").alias("leg_dstn_aipc"),
        F.date_format("STD", time_format).alias("leg_dep_time_locl"),
        F.date_format("STA", time_format).alias("leg_arvl_time_locl"),
        F.date_diff(F.to_date("STD"), F.col(DAY)).alias("days_prior_dep"),
        F.col("Compartment").alias("cmpt_code"),
        F.to_date("STD").alias("flt_dep_date_locl"),
        F.col(DAY).alias("capture_date"),
        F.col("ClassAdjustedCapacity").alias("adj_cap"),
        F.col("ClassLid").alias("phy_cap"),
        F.col("ClassLid").alias("au"),
        zero.alias("seat_index"),
        zero.alias("bid_price"),
        zero.alias("dspl_cost"),
        (F.col("bookings_cum") - F.col("group_bookings_cum")).alias("ttl_bkd"),
        F.col("bookings_cum").alias("ttl_bkd_with_grp"),
        zero.alias("achv_dmd"),
        zero.alias("cnst_dmd"),
    )


# Dates stamped on forecast exports.
EXPORT_DATE = LOAD_DATE = FAR_DATE


def forecast_filter(forecast: DataFrame, start: dt.date, longest: int = LONGEST_LEAD_DAYS) -> DataFrame:
    """Captures at most `longest` days before departure and before the range; texts and ints as declared."""
    kept = forecast.where(
        (F.col("days_prior_dep") <= longest)
        & (F.col("capture_date") >= F.date_sub(F.lit(start), longest))
    )
    return kept.withColumns(
        {
            "oprg_flt_no": F.trim("oprg_flt_no"),
            "adj_cap": F.col("adj_cap").cast("int"),
            "flt_dep_date_locl": F.date_format("flt_dep_date_locl", "yyyy-MM-dd"),
        }
    )


def latest_capture(
    forecast: DataFrame, flight: Sequence[str], day: str = "capture_date", ties: Sequence[str] = ()
) -> DataFrame:
    """The row of each flight's last capture day; `ties` decide among rows of one day.

    Partial aggregation keeps one row per flight and task, so no flight has to fit a task.
    """
    rest = [c for c in forecast.columns if c not in flight]
    last = F.max_by(F.struct(*rest), F.struct(day, *ties))
    return forecast.groupBy(*flight).agg(last.alias("r")).select(*flight, "r.*").select(*forecast.columns)
