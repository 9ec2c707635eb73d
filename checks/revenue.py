"""Queries on ancillary extracts, categories and daily revenue."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from checks.registry import query
from checks.standins import (
    SALES, SOURCES, charges, fees, rate_history, sale_bookings, sources,
)
from fareline import codes
from fareline.operators import ancillary, assembly
from fareline.plans import revenue

CARRIER, CHANNEL, CLASS = "ECONOMY", 1, "Y"
FIRST, LAST = dt.date(1996, 1, 1), dt.date(2001, 7, 1)

# Extracts -------------------------------------------------------------------------------------------

_FLIGHTS = f"""
    route_flights AS (SELECT * FROM InventoryLeg WHERE CarrierCode = '{CARRIER}' AND Status NOT IN (2, 3) AND Lid > 50)"""
_MADE = f"""
    sold AS (
        SELECT BookingID, RecordLocator, CAST(CreatedUTC AS DATE) AS CreatedUTC FROM Booking
        WHERE ChannelType = {CHANNEL} AND CreatedUTC BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
    ),
    made AS (SELECT BookingID, CreatedUTC, PassengerID, FirstName, RecordLocator FROM sold JOIN BookingPassenger USING (BookingID))"""
# Classes of the wanted compartment first, then the flights that offer them, then who sat there.
_LEGS = f"""
    offered AS (
        SELECT InventoryLegID, ClassOfService, TravelClassCode AS Compartment
        FROM InventoryLegNest JOIN InventoryLegClass USING (InventoryLegID, ClassNest) WHERE TravelClassCode = '{CLASS}'
    ),
    flown AS (
        SELECT f.*, ClassOfService, Compartment,
               (SELECT o.DepartureStatus FROM InventoryLegOp o WHERE o.InventoryLegID = f.InventoryLegID) AS DepartureStatus
        FROM offered JOIN route_flights f USING (InventoryLegID)
    ),
    route_legs AS (
        SELECT InventoryLegID, leg.PassengerID, leg.SegmentID, Compartment, ClassOfService, STDUTC, STAUTC, STD, STA, leg.LegNumber,
               FlightNumber, OperatingFlightNumber, flown.Status, DepartureStatus, DepartureStation AS DepartureStationLeg,
               ArrivalStation AS ArrivalStationLeg, CarrierCode, leg.BookingStatus, leg.LiftStatus, Capacity, AdjustedCapacity, Lid
        FROM flown JOIN PassengerJourneyLeg leg USING (InventoryLegID)
    )"""
_BOOKED = """
    booked AS (
        SELECT s.*, l.* EXCLUDE (PassengerID, SegmentID, ClassOfService), b.* EXCLUDE (PassengerID)
        FROM PassengerJourneySegment s JOIN route_legs l
          ON s.SegmentID = l.SegmentID AND s.PassengerID = l.PassengerID AND l.ClassOfService = s.ClassOfService
        JOIN made b ON b.PassengerID = s.PassengerID
    ),
    lite AS (SELECT PassengerID, SegmentID, InventoryLegID FROM booked)"""
_EXTRACT = "WITH" + SOURCES + "," + _FLIGHTS + "," + _MADE + "," + _LEGS + "," + _BOOKED


def _extract(spark, sf_dir):
    return revenue.extract(sources(spark, sf_dir), CARRIER, None, None, FIRST, LAST, CLASS, CHANNEL)


@query("a1_route_inventory", "WITH" + SOURCES + "," + _FLIGHTS + """
    SELECT InventoryLegID, DepartureStation, ArrivalStation, Status, Lid FROM route_flights""")
def a1(spark, sf_dir):
    flights = assembly.route_inventory(sources(spark, sf_dir), CARRIER, None, None)
    return flights.select("InventoryLegID", "DepartureStation", "ArrivalStation", "Status", "Lid")


@query("a2_bookings_in_window", "WITH" + SOURCES + "," + _MADE + "SELECT * FROM made")
def a2(spark, sf_dir):
    return assembly.bookings_between(sources(spark, sf_dir), CHANNEL, FIRST, LAST)


@query("a3_legs_on_route", "WITH" + SOURCES + "," + _FLIGHTS + "," + _LEGS + """
    SELECT InventoryLegID, PassengerID, SegmentID, Compartment, ClassOfService, STD, DepartureStatus, Lid FROM route_legs""")
def a3(spark, sf_dir):
    tables = sources(spark, sf_dir)
    legs = assembly.legs_on_route(tables, assembly.route_inventory(tables, CARRIER, None, None), CLASS)
    return legs.select(
        "InventoryLegID", "PassengerID", "SegmentID", "Compartment", "ClassOfService", "STD", "DepartureStatus", "Lid"
    )


@query("a4_booked_legs", _EXTRACT + "SELECT * FROM booked")
def a4(spark, sf_dir):
    return _extract(spark, sf_dir)["bookings"]


@query("a4_leg_keys", _EXTRACT + "SELECT * FROM lite")
def a4_lite(spark, sf_dir):
    return assembly.leg_keys(_extract(spark, sf_dir)["bookings"])


@query("a5_described_charges", _EXTRACT + """,
    fee_name AS (SELECT map_from_entries(list((FeeCode, Description))) AS of_code FROM Fee)
    SELECT charge.*, of_code[ChargeCode] AS ChargeCodeDescription, of_code[TicketCode] AS TicketCodeDescription, InventoryLegID
    FROM lite JOIN PassengerJourneyCharge charge USING (PassengerID, SegmentID), fee_name""")
def a5(spark, sf_dir):
    return _extract(spark, sf_dir)["charges"]


@query("a6_described_fees", _EXTRACT + """,
    fee_line AS (
        SELECT fee.*, line.ChargeNumber, line.ChargeType, line.ChargeDetail, line.ChargeAmount, line.CurrencyCode
        FROM PassengerFeeCharge line RIGHT JOIN PassengerFee fee USING (PassengerID, FeeNumber)
    ),
    fee_name AS (SELECT map_from_entries(list((FeeCode, Description))) AS of_code FROM Fee),
    service AS (SELECT map_from_entries(list((SSRCode, Name))) AS of_code FROM SSR)
    SELECT fee_line.* EXCLUDE (ChargeNumber, ChargeType, ChargeDetail, ChargeAmount, CurrencyCode), SegmentID,
           fee_name.of_code[FeeCode] AS FeeCodeDescription, service.of_code[SSRCode] AS SSRCodeDescription,
           ChargeNumber, ChargeType, ChargeDetail, ChargeAmount, CurrencyCode
    FROM lite JOIN fee_line USING (PassengerID, InventoryLegID), fee_name, service""")
def a6(spark, sf_dir):
    return _extract(spark, sf_dir)["fees"]


# Categories and amounts -----------------------------------------------------------------------------

_RATES = """
    rates AS (
        SELECT FromCurrencyCode, ToCurrencyCode, max(ConversionRate) AS ConversionRate
        FROM (SELECT *, rank() OVER (PARTITION BY FromCurrencyCode, ToCurrencyCode ORDER BY CreatedDate DESC) AS r
              FROM history WHERE ToCurrencyCode = 'AUD') WHERE r = 1 GROUP BY 1, 2
    )"""
_CODES = "codes(AncilType, ContextDescription, ContextCode) AS (VALUES " + ", ".join(
    f"('{kind}', '{category}', '{code}')"
    for kind, by_category in codes.ANCILLARY_CODES.items()
    for category, listed in by_category.items()
    for code in listed
) + ")"


def _in_one_currency(name):
    return f"""
    {name}_aud AS (
        SELECT x.* EXCLUDE (ChargeAmount, CurrencyCode), ChargeAmount * ConversionRate AS ChargeAmount
        FROM {name} x LEFT JOIN rates r ON x.CurrencyCode = r.FromCurrencyCode
    )"""


def _class_sql(kind):
    tax = "FeeType" if kind == "Bundles" else "ChargeType"
    minimum = f"WHERE ChargeAmount > {ancillary.MINIMUM[kind]}" if kind in ancillary.MINIMUM else ""
    from_charges = f"""
            UNION ALL
            SELECT PassengerID, SegmentID, InventoryLegID, ChargeCode, ChargeAmount, 'Charges'
            FROM charges_aud WHERE ChargeCode IN (SELECT ContextCode FROM codes WHERE AncilType = '{kind}')"""
    return f"""
        SELECT i.*, coalesce(c.ContextDescription, 'NotHandled') AS ContextDescription, '{kind}' AS AncilType
        FROM (
            SELECT PassengerID, SegmentID, InventoryLegID, FeeCode AS ContextCode, sum(ChargeAmount) AS ChargeAmount, 'Fees' AS SOURCE
            FROM fees_aud WHERE FeeCode IN (SELECT ContextCode FROM codes WHERE AncilType = '{kind}') AND {tax} NOT IN (3, 5)
            GROUP BY PassengerID, SegmentID, InventoryLegID, FeeCode, FeeType
            {from_charges if kind in ("Bundles", "Bags") else ""}
        ) i LEFT JOIN codes c ON c.AncilType = '{kind}' AND c.ContextCode = i.ContextCode
        {minimum}"""


# Sums of no amount at all count as zero.
def _zeroed(sql):
    return sql.replace("sum(ChargeAmount)", "coalesce(sum(ChargeAmount), 0)")


_BASE_FARE = """
        SELECT PassengerID, SegmentID, InventoryLegID, ChargeCode AS ContextCode, ChargeAmount, 'Charges' AS SOURCE,
               'BaseFare' AS ContextDescription, 'BaseFare' AS AncilType
        FROM charges_aud WHERE ChargeType = 0"""
_PRICED = "WITH" + SALES + "," + _RATES + "," + _CODES + "," + _in_one_currency("charges") + "," + _in_one_currency("fees")
_ITEMS = _PRICED + ", items AS (" + " UNION ALL ".join(
    [_zeroed(_class_sql(kind)) for kind in codes.ANCILLARY_CODES] + [_BASE_FARE]
) + ")"


def _priced(spark, sf_dir):
    rates = ancillary.latest_rates(rate_history(spark, sf_dir), one_per_pair=True)
    return [ancillary.to_one_currency(lines(spark, sf_dir), rates) for lines in (charges, fees)]


_cents = lambda c="ChargeAmount": F.round(c, 2).alias(c)
_ITEM_SQL = """SELECT PassengerID, SegmentID, InventoryLegID, ContextCode, round(ChargeAmount, 2) AS ChargeAmount, SOURCE,
           ContextDescription, AncilType FROM items"""


def _shown(items):
    return items.select(
        *ancillary.LEG, "ContextCode", _cents(), "SOURCE", "ContextDescription", "AncilType"
    )


@query("a7_latest_rates", "WITH" + SALES + """
    SELECT FromCurrencyCode, ToCurrencyCode, ConversionRate
    FROM (SELECT *, rank() OVER (PARTITION BY FromCurrencyCode, ToCurrencyCode ORDER BY CreatedDate DESC) AS r
          FROM history WHERE ToCurrencyCode = 'AUD') WHERE r = 1""")
def a7(spark, sf_dir):
    return ancillary.latest_rates(rate_history(spark, sf_dir))


@query("a7_one_rate_per_pair", "WITH" + SALES + "," + _RATES + "SELECT * FROM rates")
def a7_one(spark, sf_dir):
    return ancillary.latest_rates(rate_history(spark, sf_dir), one_per_pair=True)


@query("a8_currency_conversion", _PRICED + """
    SELECT PassengerID, SegmentID, InventoryLegID, ChargeType, ChargeCode, round(ChargeAmount, 2) AS ChargeAmount FROM charges_aud""")
def a8(spark, sf_dir):
    return _priced(spark, sf_dir)[0].select(*ancillary.LEG, "ChargeType", "ChargeCode", _cents())


@query("a9_category_lookup", "WITH" + SALES + "," + _CODES + """
    SELECT PassengerID, SegmentID, InventoryLegID, ChargeCode AS ContextCode,
           coalesce(ContextDescription, 'NotHandled') AS ContextDescription
    FROM charges LEFT JOIN codes ON AncilType = 'Bags' AND ContextCode = ChargeCode""")
def a9(spark, sf_dir):
    rows = charges(spark, sf_dir).select(*ancillary.LEG, F.col("ChargeCode").alias("ContextCode"))
    return ancillary.with_category(rows, "Bags")


@query("a10_charge_items", _PRICED + """
    SELECT PassengerID, SegmentID, InventoryLegID, ChargeCode AS ContextCode, ChargeType AS ContextType,
           round(ChargeAmount, 2) AS ChargeAmount, 'Charges' AS SOURCE, AncilType
    FROM charges_aud JOIN codes ON ContextCode = ChargeCode WHERE AncilType IN ('Bundles', 'Bags')""")
def a10(spark, sf_dir):
    priced = _priced(spark, sf_dir)[0]
    both = [ancillary.charge_items(priced, kind).withColumn("AncilType", F.lit(kind)) for kind in ("Bundles", "Bags")]
    return both[0].unionByName(both[1]).select(
        *ancillary.LEG, "ContextCode", "ContextType", _cents(), "SOURCE", "AncilType"
    )


@query("a11_fee_items", _PRICED + """
    SELECT PassengerID, SegmentID, InventoryLegID, FeeCode AS ContextCode, FeeType AS ContextType,
           round(coalesce(sum(ChargeAmount), 0), 2) AS ChargeAmount, 'Fees' AS SOURCE, AncilType
    FROM fees_aud JOIN codes ON ContextCode = FeeCode
    WHERE CASE WHEN AncilType = 'Bundles' THEN FeeType ELSE ChargeType END NOT IN (3, 5)
    GROUP BY PassengerID, SegmentID, InventoryLegID, FeeCode, FeeType, AncilType""")
def a11(spark, sf_dir):
    priced = _priced(spark, sf_dir)[1]
    kinds = [ancillary.fee_items(priced, kind).withColumn("AncilType", F.lit(kind)) for kind in codes.ANCILLARY_CODES]
    return reduce(lambda a, b: a.unionByName(b), kinds).select(
        *ancillary.LEG, "ContextCode", "ContextType", _cents(), "SOURCE", "AncilType"
    )


@query("a12_minimum_amount", _PRICED + f"""
    SELECT PassengerID, SegmentID, InventoryLegID, FeeCode AS ContextCode, round(ChargeAmount, 2) AS ChargeAmount, kind
    FROM fees_aud, (VALUES ('Bags', {ancillary.MINIMUM['Bags']}), ('Seats', {ancillary.MINIMUM['Seats']}), ('Bundles', -1)) AS m(kind, least)
    WHERE kind = 'Bundles' OR ChargeAmount > least""")
def a12(spark, sf_dir):
    rows = _priced(spark, sf_dir)[1].select(*ancillary.LEG, F.col("FeeCode").alias("ContextCode"), "ChargeAmount")
    kinds = [ancillary.above_minimum(rows, kind).withColumn("kind", F.lit(kind)) for kind in ("Bags", "Seats", "Bundles")]
    return reduce(lambda a, b: a.unionByName(b), kinds).withColumn("ChargeAmount", F.round("ChargeAmount", 2))


_LIST_SQL = """
    SELECT PassengerID, SegmentID, InventoryLegID, AncilType, CAST(count(*) AS BIGINT) AS items,
           string_agg(ContextCode || ':' || ContextDescription || ':' || SOURCE, '|'
                      ORDER BY ContextCode, ContextDescription, ChargeAmount NULLS FIRST, SOURCE) AS listed,
           round(coalesce(sum(ChargeAmount), 0), 2) AS TotalCharge
    FROM items {where} GROUP BY PassengerID, SegmentID, InventoryLegID, AncilType"""


def _listed(items):
    text = F.transform("items", lambda i: F.concat_ws(":", i["ContextCode"], i["ContextDescription"], i["SOURCE"]))
    return ancillary.leg_aggregate(items).select(
        *ancillary.LEG, "AncilType", F.size("items").cast("bigint").alias("items"),
        F.array_join(text, "|").alias("listed"), _cents("TotalCharge"),
    )


@query("a13_ancillary_aggregate", _ITEMS + _LIST_SQL.format(where="WHERE AncilType <> 'BaseFare'"))
def a13(spark, sf_dir):
    priced = _priced(spark, sf_dir)
    return _listed(ancillary.all_items(*priced).where(F.col("AncilType") != "BaseFare"))


@query("a13_large_legs", _ITEMS + """
    SELECT AncilType, CAST(count(*) AS BIGINT) AS items,
           md5(string_agg(ContextCode || ':' || ContextDescription || ':' || SOURCE, '|'
                          ORDER BY ContextCode, ContextDescription, ChargeAmount NULLS FIRST, SOURCE)) AS listed,
           round(coalesce(sum(ChargeAmount), 0), 1) AS TotalCharge
    FROM items GROUP BY AncilType""")
def a13_large(spark, sf_dir):
    """All items of a class on one leg."""
    items = ancillary.all_items(*_priced(spark, sf_dir)).withColumns({c: F.lit(0) for c in ancillary.LEG})
    text = F.concat_ws(":", "ContextCode", "ContextDescription", "SOURCE")
    return ancillary.leg_digests(items, text).select(
        "AncilType", "items", F.col("digest").alias("listed"), F.round("TotalCharge", 1).alias("TotalCharge")
    )


@query("a14_base_fare_aggregate", _ITEMS + _LIST_SQL.format(where="WHERE AncilType = 'BaseFare'"))
def a14(spark, sf_dir):
    return _listed(ancillary.base_fare_items(_priced(spark, sf_dir)[0]))


@query("a15_union_of_aggregates", _ITEMS + _ITEM_SQL)
def a15(spark, sf_dir):
    return _shown(ancillary.all_items(*_priced(spark, sf_dir)))


@query("a16_booking_dates", _ITEMS + """
    SELECT CreatedUTC, ContextDescription, CAST(count(*) AS BIGINT) AS rows, round(coalesce(sum(ChargeAmount), 0), 2) AS amount
    FROM items JOIN bookings USING (PassengerID) GROUP BY 1, 2""")
def a16(spark, sf_dir):
    dated = ancillary.with_booking_date(ancillary.all_items(*_priced(spark, sf_dir)), sale_bookings(spark, sf_dir))
    amount = F.round(F.coalesce(F.sum("ChargeAmount"), F.lit(0)), 2)
    return dated.groupBy("CreatedUTC", "ContextDescription").agg(F.count("*").alias("rows"), amount.alias("amount"))


@query("a16_booking_dates_once", _ITEMS + """
    SELECT CreatedUTC, ContextDescription, round(coalesce(sum(ChargeAmount), 0), 2) AS amount
    FROM items JOIN (SELECT DISTINCT * FROM bookings) USING (PassengerID) GROUP BY 1, 2""")
def a16_once(spark, sf_dir):
    items = ancillary.all_items(*_priced(spark, sf_dir))
    daily = ancillary.daily_category_sums(items, sale_bookings(spark, sf_dir), dedupe_bookings=True)
    return daily.withColumn("amount", F.round("amount", 2))


@query("a17_parallel_explode", _ITEMS + _ITEM_SQL)
def a17(spark, sf_dir):
    listed = ancillary.listed_columns(ancillary.leg_aggregate(ancillary.all_items(*_priced(spark, sf_dir))))
    return _shown(ancillary.explode_lists(listed))


_PIVOT = """
    daily AS (SELECT CreatedUTC, ContextDescription, coalesce(sum(ChargeAmount), 0) AS amount
              FROM items JOIN bookings USING (PassengerID) GROUP BY 1, 2),
    pivoted AS (SELECT CreatedUTC, """ + ", ".join(
    f"sum(amount) FILTER (WHERE ContextDescription = '{c}') AS {c}" for c in codes.categories()
) + " FROM daily GROUP BY CreatedUTC)"


def _pivoted(spark, sf_dir):
    items = ancillary.all_items(*_priced(spark, sf_dir))
    return ancillary.pivot_categories(ancillary.daily_category_sums(items, sale_bookings(spark, sf_dir)))


@query("a18_pivot_sum", _ITEMS + "," + _PIVOT + "SELECT CreatedUTC, " + ", ".join(
    f"round({c}, 2) AS {c}" for c in codes.categories()) + " FROM pivoted")
def a18(spark, sf_dir):
    return _pivoted(spark, sf_dir).select("CreatedUTC", *[_cents(c) for c in codes.categories()])


def _plus(names):
    return " + ".join(f"coalesce({n}, 0)" for n in names)


_KEPT = [codes.BASE_FARE, *codes.BUNDLE_REVENUE, *codes.BAGGAGE_REVENUE]


@query("a19_daily_revenue", _ITEMS + "," + _PIVOT + f""",
    totals AS (
        SELECT *, round({_plus(codes.BUNDLE_REVENUE)}, 2) AS BundleRevenue, round({_plus(codes.BAGGAGE_REVENUE)}, 2) AS BaggageRevenue,
               round(STF, 2) AS SeatRevenue FROM pivoted
    )
    SELECT CreatedUTC, {', '.join(f'round({c}, 2) AS {c}' for c in _KEPT)}, BundleRevenue, BaggageRevenue, SeatRevenue,
           round({_plus(["BundleRevenue", "BaggageRevenue", "SeatRevenue"])}, 2) AS AncilRevenue,
           round({_plus(["BundleRevenue", "BaggageRevenue", "SeatRevenue", codes.BASE_FARE])}, 2) AS TotalRevenue
    FROM totals""")
def a19(spark, sf_dir):
    rates = ancillary.latest_rates(rate_history(spark, sf_dir), one_per_pair=True)
    daily = revenue.daily_revenue(
        charges(spark, sf_dir), fees(spark, sf_dir), sale_bookings(spark, sf_dir), rates
    )
    return daily.withColumns({c: F.round(c, 2) for c in _KEPT})
