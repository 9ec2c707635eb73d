"""Queries on the daily booking curve and the flight forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.journeys import _GROUPS, AIRLINE, END, GROUP_BOUND, START, study
from checks.registry import query, table
from checks.standins import INVENTORY, LEGS, inventory, kept_legs, legs
from fareline.operators import curve, journeys

# Events as bookings: event type and user make a flight that departs on the first of next month. --------


def _bookings(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    month = F.add_months(F.trunc(F.to_date("ts"), "month"), 1).cast("timestamp_ntz")
    hours = F.make_dt_interval(hours=F.length("event_type"))
    rows = events.select(
        F.col("event_type").alias("CarrierCode"), F.col("user_id").cast("string").alias("FlightNumber"),
        (month + hours).alias("STD"), (month + hours - F.expr("interval 10 hours")).alias("STDUTC"),
        F.concat(F.col("event_type"), F.lit("."), F.col("user_id").cast("string")).alias("FlightKey"),
        F.when(F.col("value") < 20, "Y").otherwise("J").alias("Compartment"),
        F.col("ts").alias("CreatedUTC"), F.lit(1).alias("Booking"),
        F.when(F.col("value") > 50, 1).otherwise(0).alias("GroupBooking"),
    )
    return rows


_BOOKINGS = """
    made AS (
        SELECT event_type AS CarrierCode, CAST(user_id AS VARCHAR) AS FlightNumber,
               date_trunc('month', ts) + INTERVAL 1 MONTH + to_hours(length(event_type)) AS STD,
               date_trunc('month', ts) + INTERVAL 1 MONTH + to_hours(length(event_type)) - INTERVAL 10 HOUR AS STDUTC,
               event_type || '.' || CAST(user_id AS VARCHAR) AS FlightKey,
               CASE WHEN value < 20 THEN 'Y' ELSE 'J' END AS Compartment, ts AS CreatedUTC, 1 AS Booking,
               CASE WHEN value > 50 THEN 1 ELSE 0 END AS GroupBooking
        FROM events
    )"""
_SERIES = ", ".join(curve.SERIES)


def _daily_sql(rows):
    return f"""
    daily AS (
        SELECT CAST(CreatedUTC AS DATE) AS CreatedUTC, {_SERIES}, CAST(sum(Booking) AS BIGINT) AS bookings,
               CAST(sum(GroupBooking) AS BIGINT) AS group_bookings
        FROM {rows} GROUP BY ALL
    ),
    sentinels AS (
        SELECT DISTINCT CAST(STD AS DATE) AS CreatedUTC, {_SERIES}, CAST(0 AS BIGINT) AS bookings,
               CAST(0 AS BIGINT) AS group_bookings FROM daily
    ),
    added AS (
        SELECT CreatedUTC, {_SERIES}, CAST(sum(bookings) AS BIGINT) AS bookings,
               CAST(sum(group_bookings) AS BIGINT) AS group_bookings
        FROM (SELECT * FROM daily UNION ALL BY NAME SELECT * FROM sentinels) GROUP BY ALL
    ),
    totals AS (
        SELECT *, CAST(sum(bookings) OVER w AS BIGINT) AS bookings_cum,
               CAST(sum(group_bookings) OVER w AS BIGINT) AS group_bookings_cum
        FROM added WINDOW w AS (PARTITION BY CarrierCode, FlightNumber, STD
                                ORDER BY CreatedUTC, Compartment, FlightKey, STDUTC ROWS UNBOUNDED PRECEDING)
    ),
    calendar AS (
        SELECT CarrierCode, FlightNumber, STD,
               CAST(unnest(generate_series(CAST(min(CreatedUTC) AS TIMESTAMP), CAST(max(CreatedUTC) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
                   AS CreatedUTC
        FROM totals GROUP BY 1, 2, 3
    ),
    upsampled AS (SELECT * FROM calendar LEFT JOIN totals USING (CarrierCode, FlightNumber, STD, CreatedUTC)),
    filled AS (
        SELECT CreatedUTC, CarrierCode, FlightNumber, STD,
               last_value(FlightKey IGNORE NULLS) OVER w AS FlightKey, last_value(Compartment IGNORE NULLS) OVER w AS Compartment,
               coalesce(bookings, 0) AS bookings, coalesce(group_bookings, 0) AS group_bookings,
               last_value(bookings_cum IGNORE NULLS) OVER w AS bookings_cum,
               last_value(group_bookings_cum IGNORE NULLS) OVER w AS group_bookings_cum
        FROM upsampled WINDOW w AS (PARTITION BY CarrierCode, FlightNumber, STD
                                    ORDER BY CreatedUTC, Compartment, FlightKey, STDUTC ROWS UNBOUNDED PRECEDING)
    )"""


_EVENTS = "WITH" + _BOOKINGS + "," + _daily_sql("made")


def _daily(spark, sf_dir):
    return curve.daily_counts(_bookings(spark, sf_dir))


def _totals(spark, sf_dir):
    return curve.running_totals(curve.daily_with_departure(_bookings(spark, sf_dir)))


@query("f3_daily_counts", _EVENTS + "SELECT * FROM daily")
def f3(spark, sf_dir):
    return _daily(spark, sf_dir)


@query("f4_departure_rows", _EVENTS + "SELECT * FROM sentinels")
def f4(spark, sf_dir):
    return curve.departure_rows(_daily(spark, sf_dir))


@query("f5_union_and_add_up", _EVENTS + "SELECT * FROM added")
def f5(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return curve.add_up(daily, curve.departure_rows(daily))


@query("f5_one_shuffle_form", _EVENTS + "SELECT * FROM added")
def f5_fused(spark, sf_dir):
    return curve.daily_with_departure(_bookings(spark, sf_dir))


@query("f6_running_totals", _EVENTS + "SELECT * FROM totals")
def f6(spark, sf_dir):
    return _totals(spark, sf_dir)


@query("f7_upsample_daily", _EVENTS + """
    SELECT CreatedUTC, CarrierCode, FlightNumber, STD, FlightKey, Compartment, bookings, group_bookings, bookings_cum,
           FlightKey IS NULL AS filled FROM upsampled""")
def f7(spark, sf_dir):
    return curve.upsample_days(_totals(spark, sf_dir)).select(
        "CreatedUTC", "CarrierCode", "FlightNumber", "STD", "FlightKey", "Compartment", "bookings", "group_bookings",
        "bookings_cum", "filled",
    )


_CARRIED = ["FlightKey", "Compartment", "STDUTC", "bookings_cum", "group_bookings_cum"]


@query("f8_forward_fill", _EVENTS + "SELECT * FROM filled")
def f8(spark, sf_dir):
    filled = curve.upsample_days(_totals(spark, sf_dir))
    return curve.forward_fill(filled, _CARRIED).drop("STDUTC")


@query("f8_forward_fill_of_gaps", """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
           last_value(CASE WHEN l_returnflag = 'A' THEN l_quantity END IGNORE NULLS) OVER (
               PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice
               ROWS UNBOUNDED PRECEDING) AS carried
    FROM lineitem""")
def f8_gaps(spark, sf_dir):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *order, F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("carried")
    )
    return curve.fill_gaps(rows, ["carried"], ["l_orderkey"], order)


# Forecast on passenger legs --------------------------------------------------------------------------

_FLOWN = rf"""
    flown AS (
        SELECT * FROM legs WHERE STDUTC >= DATE '{START}' AND STDUTC <= DATE '{END}' AND CarrierCode = '{AIRLINE}'
           AND Status NOT IN (2, 3) AND regexp_matches(trim(FlightNumber, ' '), '^\d{{1,3}}$')
    )"""
_FLAGGED = """
    counted AS (
        SELECT f.*, CASE WHEN coalesce(g.GroupBooking, false) THEN 1 ELSE 0 END AS GroupBooking, 1 AS Booking
        FROM flown f LEFT JOIN groups g USING (BookingID)
    )"""


def _flown(spark, sf_dir):
    return journeys.trip_legs(legs(spark, sf_dir), None, None, START, END, AIRLINE)


_LEG_COLUMNS = ["Key", "FlightKey", "STDUTC", "CarrierCode", "FlightNumber"]


@query("f1_forecast_legs", "WITH" + LEGS + "," + _FLOWN + f"SELECT {', '.join(_LEG_COLUMNS)} FROM flown")
def f1(spark, sf_dir):
    return _flown(spark, sf_dir).select(*_LEG_COLUMNS)


@query("f2_group_flag", "WITH" + LEGS + "," + _GROUPS + "," + _FLOWN + "," + _FLAGGED + f"""
    SELECT {', '.join(_LEG_COLUMNS)}, GroupBooking, Booking FROM counted""")
def f2(spark, sf_dir):
    groups = journeys.group_bookings(legs(spark, sf_dir), GROUP_BOUND)
    return curve.with_group_flag(_flown(spark, sf_dir), groups).select(*_LEG_COLUMNS, "GroupBooking", "Booking")


@query("f9_capacity_join", "WITH" + LEGS + "," + INVENTORY + "," + _FLOWN + """,
    capacity AS (SELECT DISTINCT * FROM inventory)
    SELECT f.Key, f.FlightKey, f.Compartment, c.AdjustedCapacity, c.STA, c.Capacity, c.Lid, c.ClassLid, c.ClassAdjustedCapacity
    FROM flown f LEFT JOIN capacity c ON f.FlightKey = c.FlightKey AND f.Compartment = c.Compartment""")
def f9(spark, sf_dir):
    own = legs(spark, sf_dir)
    flown = journeys.trip_legs(own, None, None, START, END, AIRLINE).select("Key", "FlightKey", "Compartment")
    return curve.with_capacity(flown, inventory(own)).drop("STD_inventory")


_FORECAST = f"""
    forecast AS (
        SELECT '{AIRLINE}' AS oprg_carr_code, FlightNumber AS oprg_flt_no, {{origin}} AS leg_orgn_aipc, {{destination}} AS leg_dstn_aipc,
               strftime(f.STD, '%H:%M') AS leg_dep_time_locl, strftime(c.STA, '%H:%M') AS leg_arvl_time_locl,
               CAST(CAST(f.STD AS DATE) - CreatedUTC AS INTEGER) AS days_prior_dep, Compartment AS cmpt_code,
               CAST(f.STD AS DATE) AS flt_dep_date_locl, CreatedUTC AS capture_date, ClassAdjustedCapacity AS adj_cap,
               ClassLid AS phy_cap, ClassLid AS au, 0 AS seat_index, 0 AS bid_price, 0 AS dspl_cost,
               bookings_cum - group_bookings_cum AS ttl_bkd, bookings_cum AS ttl_bkd_with_grp, 0 AS achv_dmd, 0 AS cnst_dmd
        FROM filled f LEFT JOIN (SELECT DISTINCT * FROM inventory) c USING (FlightKey, Compartment)
    )"""
_FORECAST_KEPT = f"""
    SELECT * REPLACE (trim(oprg_flt_no, ' ') AS oprg_flt_no, CAST(adj_cap AS INTEGER) AS adj_cap,
                      strftime(flt_dep_date_locl, '%Y-%m-%d') AS flt_dep_date_locl)
    FROM forecast WHERE days_prior_dep <= 365 AND capture_date >= DATE '{START}' - INTERVAL 365 DAY"""


def _view_sql(where, origin, destination):
    return "WITH" + LEGS + "," + INVENTORY + "," + _GROUPS + "," + _FLOWN.replace("flown AS", "all_flown AS") + f""",
    flown AS (SELECT * FROM all_flown WHERE {where})""" + "," + _FLAGGED + "," + _daily_sql("counted") + "," + \
        _FORECAST.format(origin=origin, destination=destination)


_ROUTE = ("DepartureStation = 'ASIA' AND ArrivalStation = 'EUROPE'", "'ASIA'", "'EUROPE'")


@query("f10_forecast_columns", _view_sql(*_ROUTE) + "SELECT * FROM forecast")
def f10(spark, sf_dir):
    own = kept_legs(spark, sf_dir)
    flown = journeys.trip_legs(own, "ASIA", "EUROPE", START, END, AIRLINE)
    groups = journeys.group_bookings(own, GROUP_BOUND)
    totals = curve.running_totals(curve.daily_with_departure(curve.with_group_flag(flown, groups)))
    filled = curve.forward_fill(curve.upsample_days(totals), _CARRIED).drop("STDUTC")
    whole = curve.with_capacity(filled, inventory(own))
    return curve.forecast_columns(whole, AIRLINE, "ASIA", "EUROPE")


@query("f11_forecast_view", _view_sql(*_ROUTE) + _FORECAST_KEPT)
def f11(spark, sf_dir):
    own = kept_legs(spark, sf_dir)
    return study("ASIA", "EUROPE").forecast(own, inventory(own))


_ALL = ("true", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)")


@query("flight_forecast_all_routes", _view_sql(*_ALL) + f""",
    kept AS ({_FORECAST_KEPT})
    SELECT capture_date, cmpt_code, CAST(count(*) AS BIGINT) AS rows, CAST(sum(ttl_bkd) AS BIGINT) AS ttl_bkd,
           CAST(sum(ttl_bkd_with_grp) AS BIGINT) AS ttl_bkd_with_grp, CAST(sum(adj_cap) AS BIGINT) AS adj_cap,
           CAST(sum(days_prior_dep) AS BIGINT) AS days_prior_dep
    FROM kept GROUP BY 1, 2""")
def all_routes(spark, sf_dir):
    own = kept_legs(spark, sf_dir)
    view = study().forecast(own, inventory(own))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("ttl_bkd", "ttl_bkd_with_grp", "adj_cap", "days_prior_dep")]
    return view.groupBy("capture_date", "cmpt_code").agg(F.count("*").alias("rows"), *sums)


@query("f12_latest_capture", _EVENTS + """
    SELECT CarrierCode, FlightNumber, STD, CreatedUTC, Compartment, bookings_cum, group_bookings_cum
    FROM (SELECT *, row_number() OVER (PARTITION BY CarrierCode, FlightNumber, STD
                                       ORDER BY CreatedUTC DESC, Compartment DESC, FlightKey DESC) AS r FROM filled)
    WHERE r = 1""")
def f12(spark, sf_dir):
    filled = curve.forward_fill(curve.upsample_days(_totals(spark, sf_dir)), _CARRIED)
    last = curve.latest_capture(filled, curve.FLIGHT, "CreatedUTC", ["Compartment", "FlightKey"])
    return last.select("CarrierCode", "FlightNumber", "STD", "CreatedUTC", "Compartment", "bookings_cum", "group_bookings_cum")
