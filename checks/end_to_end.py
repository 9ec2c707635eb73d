"""Queries that run from source tables through to booking lines, flight forecast and daily revenue in one go."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.curve import _FLAGGED, _FLOWN, _FORECAST, _FORECAST_KEPT, _daily_sql
from checks.journeys import (
    _DESCRIBED, _GROUPS, _JOURNEY_LEGS, _KEPT, _LINES, _TARGET, AIRLINE, END, NON_STANDARD, ORGANIZATIONS, RULES, START, _travellers,
)
from checks.registry import query
from checks.revenue import _CODES, _KEPT as _REVENUE, _BASE_FARE, _EXTRACT, _PIVOT, _RATES, CARRIER, CHANNEL, CLASS, FIRST, LAST
from checks.revenue import _class_sql, _in_one_currency, _plus, _zeroed
from checks.standins import LEGS, RAW_LEGS, SALE_CODES, SALES, SOURCES, rate_history, sources
from fareline import codes
from fareline.operators import ancillary
from fareline.plans import revenue
from fareline.plans.journey_views import RouteStudy
from fareline.session import new_path

# Journeys: bookings are made in the years of the flights. -------------------------------------------------

_BOOKED_LATE = SOURCES.replace("min(o_orderdate) AS BookingUTC", "TIMESTAMP '1998-01-01' + to_days(CAST(o_custkey % 900 AS INTEGER)) AS BookingUTC")


def _late(spark, sf_dir):
    made = F.lit("1998-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("BookingID") % 900).cast("int"))
    tables = sources(spark, sf_dir)
    return tables | {"Booking": tables["Booking"].withColumn("BookingUTC", made)}


def _everywhere(margin):
    place = "(DepartureStation, ArrivalStation) = ('Brand#7', 'ring')\n              AND "
    return _travellers(margin).replace(place, "").replace("1998-03-01", str(START)).replace("1999-06-30", str(END))


_PULLED = "WITH" + _BOOKED_LATE + "," + _everywhere("1 DAY") + "," + _DESCRIBED + "," + _JOURNEY_LEGS + """,
    passenger AS (
        SELECT PassengerID AS p, FirstName, BookingUTC AS CreatedUTC, CAST(BookingID AS VARCHAR) AS BookingID, RecordLocator
        FROM Booking JOIN BookingPassenger USING (BookingID)
    ),
    raw_legs AS (
        SELECT passenger.* EXCLUDE (p), journey_legs.* REPLACE (
                   CAST(PassengerID AS VARCHAR) AS PassengerID, CAST(SegmentID AS VARCHAR) AS SegmentID)
        FROM journey_legs LEFT JOIN passenger ON p = PassengerID WHERE PassengerID IN (SELECT PassengerID FROM wanted)
    )""" + LEGS[len(RAW_LEGS):]


def _for_carrier(sql):
    return sql.replace(f"'{AIRLINE}'", f"'{CARRIER}'")


def _study():
    return RouteStudy(CARRIER, NON_STANDARD, ORGANIZATIONS, None, None, START, END, RULES)


@query("booking_lines_from_sources", _PULLED + _for_carrier("," + _TARGET + "," + _LINES + f"SELECT * EXCLUDE (id) FROM ({_KEPT})"))
def booking_lines(spark, sf_dir):
    study = _study()
    legs, _ = study.load(spark, _late(spark, sf_dir), new_path(spark, "study"))
    return study.booking_lines(legs).drop("id")


_STOCK = _everywhere("14 MONTH").replace("wanted AS", "far AS") + """,
    stocked AS (
        SELECT f.* EXCLUDE (Lid, AdjustedCapacity), f.Lid, f.AdjustedCapacity, nest.TravelClassCode AS Compartment, nest.Lid AS ClassLid,
               nest.AdjustedCapacity AS ClassAdjustedCapacity, leg.LiftStatus,
               (SELECT o.DepartureStatus FROM InventoryLegOp o WHERE o.InventoryLegID = f.InventoryLegID) AS DepartureStatus
        FROM InventoryLeg f LEFT JOIN InventoryLegNest nest USING (InventoryLegID)
        RIGHT JOIN PassengerJourneyLeg leg USING (InventoryLegID)
        WHERE leg.PassengerID IN (SELECT PassengerID FROM far) AND leg.PassengerID IN (SELECT PassengerID FROM BookingPassenger)
    ),
    inventory AS (
        SELECT strftime(STDUTC, '%Y-%m-%d %H:%M:%S.%f') || '.' || DepartureStation || '.' || ArrivalStation || '.'
                   || regexp_replace(CarrierCode || FlightNumber, '^\\s+|\\s+$', '', 'g') AS FlightKey,
               Compartment, AdjustedCapacity, STD, STA, Capacity, Lid, ClassLid, ClassAdjustedCapacity
        FROM stocked JOIN lift_names USING (LiftStatus) JOIN departure_names USING (DepartureStatus) JOIN inventory_names USING (Status)
    )"""


@query("flight_forecast_from_sources", _PULLED + "," + _STOCK + _for_carrier(
    "," + _GROUPS + "," + _FLOWN + "," + _FLAGGED + "," + _daily_sql("counted") + ","
    + _FORECAST.format(origin="CAST(NULL AS VARCHAR)", destination="CAST(NULL AS VARCHAR)") + _FORECAST_KEPT))
def flight_forecast(spark, sf_dir):
    study = _study()
    legs, inventory = study.load(spark, _late(spark, sf_dir), new_path(spark, "study"))
    return study.forecast(legs, inventory)


# Revenue: brands stand for real codes, return flags for currencies. ---------------------------------------

_LISTED = "[" + ", ".join(f"'{c}'" for c in SALE_CODES) + "]"
_MONEY = {"A": "AUD", "N": "NZD", "R": "JPY"}


def _sold(spark, sf_dir):
    tables = sources(spark, sf_dir)
    code = lambda c: F.element_at(F.array(*[F.lit(x) for x in SALE_CODES]), F.regexp_extract(c, r"(\d+)", 1).cast("int"))
    money = F.create_map(*[F.lit(x) for pair in _MONEY.items() for x in pair])
    paid = lambda name: tables[name].withColumn("CurrencyCode", money[F.col("CurrencyCode")])
    return tables | {
        "PassengerJourneyCharge": paid("PassengerJourneyCharge").withColumn("ChargeCode", code("ChargeCode")),
        "PassengerFee": tables["PassengerFee"].withColumn("FeeCode", code("FeeCode")), "PassengerFeeCharge": paid("PassengerFeeCharge"),
    }


_CODE_SQL = _LISTED + "[CAST(regexp_extract({0}, '(\\d+)', 1) AS INTEGER)]"
_MONEY_SQL = "CASE {0} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _MONEY.items()) + " END"
_HISTORY = "history AS" + SALES.split("history AS", 1)[1]
_ROUTE_ITEMS = _EXTRACT + f""",
    charges AS (
        SELECT PassengerID, SegmentID, InventoryLegID, ChargeType, {_CODE_SQL.format('ChargeCode')} AS ChargeCode,
               CAST(ChargeAmount AS FLOAT) AS ChargeAmount, {_MONEY_SQL.format('CurrencyCode')} AS CurrencyCode
        FROM lite JOIN PassengerJourneyCharge charge USING (PassengerID, SegmentID)
    ),
    fees AS (
        SELECT PassengerID, SegmentID, InventoryLegID, {_CODE_SQL.format('FeeCode')} AS FeeCode, FeeType, line.ChargeType,
               CAST(line.ChargeAmount AS FLOAT) AS ChargeAmount, {_MONEY_SQL.format('line.CurrencyCode')} AS CurrencyCode
        FROM lite JOIN PassengerFee fee USING (PassengerID, InventoryLegID)
        LEFT JOIN PassengerFeeCharge line USING (PassengerID, FeeNumber)
    ),
    bookings AS (SELECT PassengerID, CreatedUTC FROM booked),
    {_HISTORY},""" + _RATES.replace("max(ConversionRate)", "max(CAST(ConversionRate AS FLOAT))") + "," + _CODES + "," + \
    _in_one_currency("charges") + "," + _in_one_currency("fees") + ", items AS (" + " UNION ALL ".join(
        [_zeroed(_class_sql(kind)) for kind in codes.ANCILLARY_CODES] + [_BASE_FARE]) + ")"
_ROUNDED = [*_REVENUE, "BundleRevenue", "BaggageRevenue", "SeatRevenue", "AncilRevenue", "TotalRevenue"]


@query("daily_revenue_from_sources", _ROUTE_ITEMS + "," + _PIVOT + f""",
    totals AS (
        SELECT *, {_plus(codes.BUNDLE_REVENUE)} AS BundleRevenue, {_plus(codes.BAGGAGE_REVENUE)} AS BaggageRevenue, STF AS SeatRevenue FROM pivoted
    ),
    whole AS (
        SELECT *, {_plus(["BundleRevenue", "BaggageRevenue", "SeatRevenue"])} AS AncilRevenue,
               {_plus(["BundleRevenue", "BaggageRevenue", "SeatRevenue", codes.BASE_FARE])} AS TotalRevenue FROM totals
    )
    SELECT CreatedUTC, {', '.join(f'round({c}, 0) AS {c}' for c in _ROUNDED)} FROM whole""")
def daily_revenue(spark, sf_dir):
    """Amounts are single-precision in the declared schemas, so they are shown in whole units."""
    daily = revenue.revenue_of_route(
        _sold(spark, sf_dir), rate_history(spark, sf_dir), CARRIER, None, None, FIRST, LAST, CLASS, CHANNEL, one_rate_per_pair=True
    )
    return daily.select("CreatedUTC", *[F.round(c, 0).alias(c) for c in _ROUNDED])
