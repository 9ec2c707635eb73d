"""Airline tables derived from the given tables, once for Spark and once as SQL.

orders are passengers, customers are bookings, order lines are legs, charges or fees, parts are
flights, events are the offer log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from fareline.operators import journeys
from fareline.session import broadcast_if_small, new_path, spread
from fareline.sources.sinks import cached_extract

# Offer log ------------------------------------------------------------------------------------------


def log_days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last day of the event log (answered from file statistics)."""
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    return span.lo.date(), span.hi.date()


SPINE = """
    spine AS (
        SELECT CAST(d AS DATE) AS day, CAST(d AS TIMESTAMP) AS start
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
                                            INTERVAL 1 DAY)) AS d FROM events)
    )"""

BOUNDS = SPINE + """,
    before AS (
        SELECT s.day, e.event_id, e.ts FROM spine s
        ASOF LEFT JOIN events e ON s.start - INTERVAL 1 HOUR >= e.ts
    ),
    after AS (
        SELECT s.day, e.event_id, e.ts FROM spine s
        ASOF LEFT JOIN events e ON s.start + INTERVAL 25 HOUR - INTERVAL 1 MICROSECOND <= e.ts
    ),
    bounds AS (
        SELECT s.start AS date, s.start AS start,
               s.start + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS end_time,
               b.event_id AS logged_start_id, b.ts AS logged_start_datetime,
               a.event_id AS logged_end_id, a.ts AS logged_end_datetime
        FROM spine s JOIN before b USING (day) JOIN after a USING (day)
    )"""


def log_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five log tables: every event is a treatment with two products."""
    events = table(spark, sf_dir, "events")
    products = events.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
    return {
        "Treatment": events.select(
            F.col("event_id").alias("TreatmentID"), F.col("event_type").alias("ClientCode"),
            F.col("value").alias("SamplingRandomNumber"), F.col("ts").alias("LoggedUTC"),
            F.col("props").alias("ExternalBookingID"),
            F.col("user_id").cast("int").alias("NumberOfPassengers"),
        ),
        "TreatmentDistinctRanked": events.select(
            F.col("event_id").alias("MinTreatmentID"), F.col("value").alias("SamplingRandomNumber"),
            F.col("ts").alias("MinLoggedUTC"), F.col("props").alias("ExternalBookingID"),
            F.lit(1).alias("Stage"), F.col("event_type").alias("PaxType"),
        ),
        "TreatmentProduct": products.select(
            F.col("event_id").alias("TreatmentID"), F.col("seq").alias("TreatmentProductSequence"),
            F.col("event_type").alias("OfferCode"), F.col("value").alias("Cost"),
        ),
        "TreatmentProductRanked": products.select(
            F.col("event_id").alias("TreatmentIDLook"), F.col("seq").alias("TreatmentProductSequence"),
            F.col("event_type").alias("ProductName"), F.col("value").alias("Amount"),
        ),
        "TreatmentProductInputParameterPivot": products.select(
            F.col("event_id").alias("TreatmentID"), F.col("seq").alias("TreatmentProductSequence"),
            F.col("event_type").alias("FareClass"),
        ),
    }


# Passenger legs -------------------------------------------------------------------------------------

# Suppliers with their region, two short columns, that every task may hold: some 40 MB at most.
SUPPLIERS_HELD = 500_000
# Order lines in a task that makes legs of them: a leg is some ten times as wide in memory as its line in the shuffle.
LINES_A_TASK = 500_000


def _percent(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("int")


def _hours(n: int) -> Column:
    return F.expr(f"interval {n} hours")


def leg_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that the legs are placed in by passenger."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "lineitem").count() // LINES_A_TASK))


def raw_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as passenger legs between the regions of supplier and customer.

    The legs are placed by PassengerID, so that what groups them by passenger or journey needs no further shuffle.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    places = broadcast_if_small(places)
    suppliers = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("r_name").alias("from")
    )
    customers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("r_name").alias("to")
    )
    # The far more numerous lines meet orders that know their customer, so that they are not shuffled for it.
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    lineitem = table(spark, sf_dir, "lineitem")
    tasks = leg_tasks(spark, sf_dir)
    # The key of both sides is the passenger as the legs name it, since Spark keeps track of no place by a number it is made of.
    by_passenger = lambda df, key: df.withColumn("PassengerID", F.col(key).cast("string")).repartition(tasks, "PassengerID")
    lines = (
        by_passenger(lineitem, "l_orderkey")
        .join(by_passenger(orders, "o_orderkey"), "PassengerID")
        .join(broadcast_if_small(suppliers, SUPPLIERS_HELD), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    n = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int")
    lead = F.dayofyear("l_shipdate") + 5 * n - 25
    month = F.trunc(F.date_add(F.to_date("o_orderdate"), lead), "month").cast("timestamp_ntz")
    number = F.concat(F.lit(" "), quantity.cast("string"), F.when(_percent("l_tax") == 8, "X").otherwise(""))
    status = (
        F.when(n == 3, 1).when(n == 4, 5).when(n == 5, 3).when(n == 6, 2).when(n == 7, 4).otherwise(0)
    )
    timed = lines.withColumn("STD", month + F.make_dt_interval(mins=20 * quantity))
    return timed.select(
        F.col("o_custkey").cast("string").alias("BookingID"),
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("RecordLocator"),
        "PassengerID",
        F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("SegmentID"),
        F.col("l_linestatus").alias("Compartment"),
        F.concat(F.lit("F"), _percent("l_discount").cast("string")).alias("FareBasis"),
        _percent("l_discount").cast("string").alias("ClassOfService"),
        F.col("o_orderpriority").alias("SourceOrganizationCode"),
        F.col("from").alias("DepartureStation"), F.col("to").alias("ArrivalStation"),
        F.col("from").alias("DepartureStationLeg"), F.col("to").alias("ArrivalStationLeg"),
        F.when(n <= 4, 1).otherwise(2).alias("TripNumber"),
        F.when(n <= 2, 1).when(n <= 4, 2).when(n <= 6, 3).otherwise(4).alias("JourneyNumber"),
        F.when(n.isin(2, 4, 6), 2).otherwise(1).alias("SegmentNumber"),
        F.lit(1).alias("LegNumber"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=n)).alias("CreatedUTC"),
        "STD", (F.col("STD") - _hours(10)).alias("STDUTC"),
        (F.col("STD") + _hours(2)).alias("STA"), (F.col("STD") - _hours(8)).alias("STAUTC"),
        F.col("l_returnflag").alias("CarrierCode"), number.alias("FlightNumber"),
        status.alias("Status"), F.least(n - 1, F.lit(5)).alias("DepartureStatus"),
        F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("LiftStatus"),
        F.col("o_orderstatus").alias("BookingStatus"),
        (quantity + 150).alias("Capacity"), (quantity + 140).alias("AdjustedCapacity"), (quantity + 145).alias("Lid"),
    )


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys.with_status_names(journeys.with_keys(raw_legs(spark, sf_dir)))


def kept_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legs written once, as the views that use them several times keep their extract, still placed by passenger.

    Their keys, the longest of their columns, are made of the others again by those who read them.
    """
    path = new_path(spark, "legs")
    pull = lambda: legs(spark, sf_dir).drop(*journeys.KEYS)
    return journeys.with_keys(cached_extract(spark, path, pull, by="PassengerID", parts=leg_tasks(spark, sf_dir)))


RAW_LEGS = r"""
    raw_legs0 AS (
        SELECT *, CAST(l_quantity AS INTEGER) AS q, CAST(round(l_discount * 100) AS INTEGER) AS disc,
               CAST(round(l_tax * 100) AS INTEGER) AS tax, sr.r_name AS from_name, cr.r_name AS to_name,
               date_trunc('month', o_orderdate + to_days(CAST(dayofyear(l_shipdate) + 5 * l_linenumber - 25 AS INTEGER)))
                   + to_minutes(20 * CAST(l_quantity AS INTEGER)) AS dep
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
    ),
    raw_legs AS (
        SELECT CAST(o_custkey AS VARCHAR) AS BookingID, 'R' || CAST(o_custkey AS VARCHAR) AS RecordLocator,
               CAST(l_orderkey AS VARCHAR) AS PassengerID,
               CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS SegmentID,
               l_linestatus AS Compartment, 'F' || CAST(disc AS VARCHAR) AS FareBasis,
               CAST(disc AS VARCHAR) AS ClassOfService, o_orderpriority AS SourceOrganizationCode,
               from_name AS DepartureStation, to_name AS ArrivalStation,
               from_name AS DepartureStationLeg, to_name AS ArrivalStationLeg,
               CASE WHEN l_linenumber <= 4 THEN 1 ELSE 2 END AS TripNumber,
               CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2
                    WHEN l_linenumber <= 6 THEN 3 ELSE 4 END AS JourneyNumber,
               CASE WHEN l_linenumber IN (2, 4, 6) THEN 2 ELSE 1 END AS SegmentNumber, 1 AS LegNumber,
               o_orderdate + to_hours(l_linenumber) AS CreatedUTC,
               dep AS STD, dep - INTERVAL 10 HOUR AS STDUTC, dep + INTERVAL 2 HOUR AS STA,
               dep - INTERVAL 8 HOUR AS STAUTC, l_returnflag AS CarrierCode,
               ' ' || CAST(q AS VARCHAR) || CASE WHEN tax = 8 THEN 'X' ELSE '' END AS FlightNumber,
               CASE l_linenumber WHEN 3 THEN 1 WHEN 4 THEN 5 WHEN 5 THEN 3 WHEN 6 THEN 2 WHEN 7 THEN 4
                    ELSE 0 END AS Status,
               least(l_linenumber - 1, 5) AS DepartureStatus,
               CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END AS LiftStatus,
               o_orderstatus AS BookingStatus, q + 150 AS Capacity, q + 140 AS AdjustedCapacity, q + 145 AS Lid
        FROM raw_legs0
    )"""

KEYED_LEGS = RAW_LEGS + r""",
    coded_legs AS (
        SELECT *, regexp_replace(CarrierCode || FlightNumber, '^\s+|\s+$', '', 'g') AS FlightCode FROM raw_legs
    ),
    keyed_legs AS (
        SELECT *,
               BookingID || PassengerID || SegmentID || CAST(TripNumber AS VARCHAR) || CAST(JourneyNumber AS VARCHAR)
                   || CAST(SegmentNumber AS VARCHAR) || CAST(LegNumber AS VARCHAR) AS Key,
               BookingID || PassengerID || CAST(TripNumber AS VARCHAR) || CAST(JourneyNumber AS VARCHAR) AS JourneyKey,
               strftime(STDUTC, '%Y-%m-%d %H:%M:%S.%f') || '.' || DepartureStationLeg || '.' || ArrivalStationLeg
                   || '.' || FlightCode AS FlightKey
        FROM coded_legs
    )"""

STATUS_NAMES = """
    lift_names AS (SELECT * FROM (VALUES (0, 'Pending'), (1, 'CheckedIn'), (2, 'Boarded'), (3, 'NoShow'))
                   AS t(LiftStatus, PassengerStatus)),
    departure_names AS (SELECT * FROM (VALUES (0, 'Default'), (1, 'Cancelled'), (2, 'Boarding'), (3, 'SeeAgent'),
                   (4, 'Delayed'), (5, 'Departed')) AS t(DepartureStatus, FlightStatus)),
    inventory_names AS (SELECT * FROM (VALUES (0, 'Normal'), (1, 'Closed'), (2, 'Canceled'), (3, 'Suspended'),
                   (5, 'ClosedPending')) AS t(Status, InventoryStatus))"""

LEGS = KEYED_LEGS + "," + STATUS_NAMES + """,
    legs AS (
        SELECT * FROM keyed_legs JOIN lift_names USING (LiftStatus)
        JOIN departure_names USING (DepartureStatus) JOIN inventory_names USING (Status)
    )"""


def inventory(own: DataFrame) -> DataFrame:
    """Capacities of the flights of the legs, one row per leg as pulled.

    Flights of one lid are stocked under another compartment, so that some legs find no capacity.
    """
    first = F.col("Compartment") == "F"
    size = F.col("Lid")
    return own.select(
        "FlightKey", F.when(size == 150, "Z").otherwise(F.col("Compartment")).alias("Compartment"), "AdjustedCapacity", "STD", "STA", "Capacity", "Lid",
        F.when(first, size - 100).otherwise(size - 90).cast("string").alias("ClassLid"),
        F.when(first, size - 110).otherwise(size - 95).cast("string").alias("ClassAdjustedCapacity"),
    )


INVENTORY = """
    inventory AS (
        SELECT FlightKey, CASE WHEN Lid = 150 THEN 'Z' ELSE Compartment END AS Compartment, AdjustedCapacity, STD, STA, Capacity, Lid,
               CAST(CASE WHEN Compartment = 'F' THEN Lid - 100 ELSE Lid - 90 END AS VARCHAR) AS ClassLid,
               CAST(CASE WHEN Compartment = 'F' THEN Lid - 110 ELSE Lid - 95 END AS VARCHAR) AS ClassAdjustedCapacity
        FROM legs
    )"""


# Normalised source tables ---------------------------------------------------------------------------


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part, lineitem = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    orders, supplier = table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    size = F.col("p_size")
    flight = F.col("p_partkey").alias("InventoryLegID")
    std = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=20 * size)
    classes = F.sequence(F.lit(0), F.lit(10))
    segment = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("SegmentID")
    passenger = F.col("l_orderkey").alias("PassengerID")
    brand = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    sold = lineitem.join(brand, "l_partkey")
    return {
        "InventoryLeg": part.withColumn("STD", std).select(
            flight, F.col("p_type").alias("CarrierCode"), F.col("p_brand").alias("DepartureStation"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("ArrivalStation"),
            F.concat(F.lit(" "), size.cast("string")).alias("FlightNumber"),
            F.lit(None).cast("string").alias("OperatingFlightNumber"),
            "STD", (F.col("STD") - _hours(10)).alias("STDUTC"),
            (F.col("STD") + _hours(2)).alias("STA"), (F.col("STD") - _hours(8)).alias("STAUTC"),
            F.when(size <= 5, 2).when(size <= 8, 3).when(size <= 10, 1).otherwise(0).alias("Status"),
            F.lit(180).alias("Capacity"), F.lit(170).alias("AdjustedCapacity"), (size * 4).alias("Lid"),
        ),
        "InventoryLegOp": part.where(size != 50).select(flight, F.least(size, F.lit(5)).alias("DepartureStatus")),
        "InventoryLegClass": part.select(flight, F.explode(classes).alias("c")).select(
            "InventoryLegID", F.col("c").cast("string").alias("ClassOfService"),
            F.when(F.col("c") < 5, 1).otherwise(2).alias("ClassNest"),
        ),
        "InventoryLegNest": part.select(flight, size, F.explode(F.array(F.lit(1), F.lit(2))).alias("ClassNest")).select(
            "InventoryLegID", "ClassNest", F.when(F.col("ClassNest") == 1, "Y").otherwise("J").alias("TravelClassCode"),
            F.concat(F.lit("N"), F.col("ClassNest").cast("string")).alias("NestType"),
            (size * 2).cast("string").alias("Lid"), (size * 2 - 1).cast("string").alias("AdjustedCapacity"),
        ),
        "PassengerJourneyLeg": lineitem.select(
            passenger, segment, F.col("l_partkey").alias("InventoryLegID"), F.lit(1).alias("LegNumber"),
            F.col("l_linestatus").alias("BookingStatus"),
            F.when(F.col("l_returnflag") == "A", 2).otherwise(0).alias("LiftStatus"),
        ),
        "PassengerJourneySegment": lineitem.groupBy("l_orderkey", "l_linenumber").agg(
            F.min(_percent("l_discount")).cast("string").alias("ClassOfService"),
            F.min("l_suppkey").cast("string").alias("SourceOrganizationCode"),
            F.min("l_quantity").cast("int").cast("string").alias("SourceDomainCode"),
            F.min("l_returnflag").alias("DepartureStation"), F.max("l_returnflag").alias("ArrivalStation"),
        ).select(
            passenger, segment, "ClassOfService", "SourceOrganizationCode", "SourceDomainCode",
            F.concat(F.lit("F"), "ClassOfService").alias("FareBasis"), "DepartureStation", "ArrivalStation",
            F.lit(1).alias("TripNumber"), F.col("l_linenumber").alias("JourneyNumber"),
            F.lit(1).alias("SegmentNumber"), F.lit("SYS").alias("CreatedLocationCode"),
        ),
        "BookingPassenger": orders.select(
            F.col("o_custkey").alias("BookingID"), F.col("o_orderkey").alias("PassengerID"),
            F.col("o_orderstatus").alias("FirstName"),
        ),
        "Booking": orders.groupBy(F.col("o_custkey").alias("BookingID")).agg(
            F.min("o_orderdate").alias("BookingUTC"), F.max("o_orderdate").alias("CreatedUTC"),
            F.min(F.substring("o_orderpriority", 1, 1).cast("int")).alias("ChannelType"),
        ).withColumn("RecordLocator", F.concat(F.lit("R"), F.col("BookingID").cast("string"))),
        "Organization": supplier.select(
            F.col("s_suppkey").cast("string").alias("OrganizationCode"), F.col("s_name").alias("OrganizationName")
        ),
        "Domain": nation.select(
            F.col("n_nationkey").cast("string").alias("DomainCode"), F.col("n_name").alias("DomainName")
        ),
        "PassengerJourneyCharge": sold.select(
            F.col("l_shipdate").alias("CreatedUTC"), passenger, segment, F.col("l_linenumber").alias("ChargeNumber"),
            _percent("l_tax").alias("ChargeType"), F.col("p_brand").alias("ChargeCode"),
            F.col("p_type").alias("TicketCode"), F.col("l_extendedprice").alias("ChargeAmount"),
            F.col("l_returnflag").alias("CurrencyCode"),
        ),
        "PassengerFee": sold.select(
            F.col("l_shipdate").alias("CreatedUTC"), passenger, F.col("l_linenumber").alias("FeeNumber"),
            F.col("p_brand").alias("FeeCode"), F.lit("d").alias("FeeDetail"), _percent("l_discount").alias("FeeType"),
            F.lit(0).alias("FeeOverride"), F.col("l_returnflag").alias("SSRCode"), F.lit(1).alias("SSRNumber"),
            F.col("l_partkey").alias("InventoryLegID"), F.lit("A").alias("ArrivalStation"),
            F.lit("D").alias("DepartureStation"),
        ),
        "PassengerFeeCharge": lineitem.groupBy(passenger, F.col("l_linenumber").alias("FeeNumber")).agg(
            F.max("l_quantity").alias("ChargeAmount"), F.max(_percent("l_tax")).alias("ChargeType"),
            F.max("l_returnflag").alias("CurrencyCode"),
        ).select(
            "*", F.lit(1).alias("ChargeNumber"), F.lit("line").alias("ChargeDetail"),
        ),
        "Fee": part.select(F.col("p_brand").alias("FeeCode")).distinct().select(
            "FeeCode", F.concat(F.lit("Fee "), "FeeCode").alias("Description")
        ),
        "SSR": lineitem.where(F.col("l_returnflag") != "R").select(F.col("l_returnflag").alias("SSRCode")).distinct().select(
            "SSRCode", F.concat(F.lit("Service "), "SSRCode").alias("Name")
        ),
    }


SOURCES = """
    InventoryLeg AS (
        SELECT *, STD - INTERVAL 10 HOUR AS STDUTC, STD + INTERVAL 2 HOUR AS STA, STD - INTERVAL 8 HOUR AS STAUTC
        FROM (SELECT p_partkey AS InventoryLegID, p_type AS CarrierCode, p_brand AS DepartureStation,
                     split_part(p_name, ' ', 2) AS ArrivalStation, ' ' || CAST(p_size AS VARCHAR) AS FlightNumber,
                     CAST(NULL AS VARCHAR) AS OperatingFlightNumber,
                     TIMESTAMP '1998-01-01' + to_days(20 * p_size) AS STD,
                     CASE WHEN p_size <= 5 THEN 2 WHEN p_size <= 8 THEN 3 WHEN p_size <= 10 THEN 1 ELSE 0 END AS Status,
                     180 AS Capacity, 170 AS AdjustedCapacity, p_size * 4 AS Lid FROM part)
    ),
    InventoryLegOp AS (SELECT p_partkey AS InventoryLegID, least(p_size, 5) AS DepartureStatus FROM part WHERE p_size <> 50),
    InventoryLegClass AS (
        SELECT InventoryLegID, CAST(c AS VARCHAR) AS ClassOfService, CASE WHEN c < 5 THEN 1 ELSE 2 END AS ClassNest
        FROM (SELECT p_partkey AS InventoryLegID, unnest(range(11)) AS c FROM part)
    ),
    InventoryLegNest AS (
        SELECT InventoryLegID, ClassNest, CASE WHEN ClassNest = 1 THEN 'Y' ELSE 'J' END AS TravelClassCode,
               'N' || CAST(ClassNest AS VARCHAR) AS NestType, CAST(p_size * 2 AS VARCHAR) AS Lid,
               CAST(p_size * 2 - 1 AS VARCHAR) AS AdjustedCapacity
        FROM (SELECT p_partkey AS InventoryLegID, p_size, unnest([1, 2]) AS ClassNest FROM part)
    ),
    PassengerJourneyLeg AS (
        SELECT l_orderkey AS PassengerID, l_orderkey * 10 + l_linenumber AS SegmentID, l_partkey AS InventoryLegID,
               1 AS LegNumber, l_linestatus AS BookingStatus, CASE WHEN l_returnflag = 'A' THEN 2 ELSE 0 END AS LiftStatus
        FROM lineitem
    ),
    PassengerJourneySegment AS (
        SELECT l_orderkey AS PassengerID, l_orderkey * 10 + l_linenumber AS SegmentID,
               CAST(min(CAST(round(l_discount * 100) AS INTEGER)) AS VARCHAR) AS ClassOfService,
               CAST(min(l_suppkey) AS VARCHAR) AS SourceOrganizationCode,
               CAST(CAST(min(l_quantity) AS INTEGER) AS VARCHAR) AS SourceDomainCode,
               'F' || CAST(min(CAST(round(l_discount * 100) AS INTEGER)) AS VARCHAR) AS FareBasis,
               min(l_returnflag) AS DepartureStation, max(l_returnflag) AS ArrivalStation, 1 AS TripNumber,
               l_linenumber AS JourneyNumber, 1 AS SegmentNumber, 'SYS' AS CreatedLocationCode
        FROM lineitem GROUP BY l_orderkey, l_linenumber
    ),
    BookingPassenger AS (SELECT o_custkey AS BookingID, o_orderkey AS PassengerID, o_orderstatus AS FirstName FROM orders),
    Booking AS (
        SELECT o_custkey AS BookingID, min(o_orderdate) AS BookingUTC, max(o_orderdate) AS CreatedUTC,
               min(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS ChannelType,
               'R' || CAST(o_custkey AS VARCHAR) AS RecordLocator FROM orders GROUP BY o_custkey
    ),
    Organization AS (SELECT CAST(s_suppkey AS VARCHAR) AS OrganizationCode, s_name AS OrganizationName FROM supplier),
    Domain AS (SELECT CAST(n_nationkey AS VARCHAR) AS DomainCode, n_name AS DomainName FROM nation),
    PassengerJourneyCharge AS (
        SELECT l_shipdate AS CreatedUTC, l_orderkey AS PassengerID, l_orderkey * 10 + l_linenumber AS SegmentID,
               l_linenumber AS ChargeNumber, CAST(round(l_tax * 100) AS INTEGER) AS ChargeType, p_brand AS ChargeCode,
               p_type AS TicketCode, l_extendedprice AS ChargeAmount, l_returnflag AS CurrencyCode
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ),
    PassengerFee AS (
        SELECT l_shipdate AS CreatedUTC, l_orderkey AS PassengerID, l_linenumber AS FeeNumber, p_brand AS FeeCode,
               'd' AS FeeDetail, CAST(round(l_discount * 100) AS INTEGER) AS FeeType, 0 AS FeeOverride,
               l_returnflag AS SSRCode, 1 AS SSRNumber, l_partkey AS InventoryLegID, 'A' AS ArrivalStation,
               'D' AS DepartureStation
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ),
    PassengerFeeCharge AS (
        SELECT l_orderkey AS PassengerID, l_linenumber AS FeeNumber, max(l_quantity) AS ChargeAmount,
               max(CAST(round(l_tax * 100) AS INTEGER)) AS ChargeType, max(l_returnflag) AS CurrencyCode,
               1 AS ChargeNumber, 'line' AS ChargeDetail
        FROM lineitem GROUP BY l_orderkey, l_linenumber
    ),
    Fee AS (SELECT DISTINCT p_brand AS FeeCode, 'Fee ' || p_brand AS Description FROM part),
    SSR AS (SELECT DISTINCT l_returnflag AS SSRCode, 'Service ' || l_returnflag AS Name FROM lineitem WHERE l_returnflag <> 'R')"""


# Charges and fees -----------------------------------------------------------------------------------

# One real code for each of the 25 brands and nations; ZZZZ is in no list.
SALE_CODES = [
    "STRT", "STPL", "FLEX", "FLXN", "FPLS", "MAX", "BIZZ", "PLUS", "STF", "BF20", "XB10", "CB07", "CBX3",
    "CBA3", "CBG7", "EXB", "OB01", "OBAP", "CHML", "MA01", "ML01", "MFAU", "MN01", "MO01", "ZZZZ",
]


def _code(position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in SALE_CODES]), position)


def _currency() -> Column:
    flag = F.col("l_returnflag")
    known = F.when(flag == "A", "AUD").when(flag == "N", "NZD").otherwise("JPY")
    return F.when((flag == "R") & (F.col("l_linestatus") == "F"), "XXX").otherwise(known)


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as journey charges; the code goes by the part's brand."""
    brand = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("b")
    )
    return spread(table(spark, sf_dir, "lineitem")).join(brand, "l_partkey").select(
        F.col("l_orderkey").alias("PassengerID"), F.col("l_linenumber").alias("SegmentID"),
        F.col("l_suppkey").alias("InventoryLegID"), _percent("l_tax").alias("ChargeType"),
        _code(F.col("b")).alias("ChargeCode"), F.col("l_extendedprice").alias("ChargeAmount"),
        _currency().alias("CurrencyCode"),
    )


def fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as fees; the code goes by the supplier's nation, the amount by quantity and discount."""
    nation = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") + 1).alias("b")
    )
    return spread(table(spark, sf_dir, "lineitem")).join(nation, "l_suppkey").select(
        F.col("l_orderkey").alias("PassengerID"), F.col("l_linenumber").alias("SegmentID"),
        F.col("l_suppkey").alias("InventoryLegID"), _code(F.col("b")).alias("FeeCode"),
        _percent("l_discount").alias("FeeType"), _percent("l_tax").alias("ChargeType"),
        (F.col("l_quantity") * F.col("l_discount")).alias("ChargeAmount"), _currency().alias("CurrencyCode"),
    )


def sale_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One booking row per order line, so that passengers repeat."""
    orders = table(spark, sf_dir, "orders")
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("PassengerID"), F.to_date("o_orderdate").alias("CreatedUTC")
    )


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as whole-numbered rates per day; many of one day tie."""
    kind = F.col("event_type")
    source = F.when(kind == "click", "AUD").when(kind == "view", "NZD").when(kind == "error", "JPY")
    return table(spark, sf_dir, "events").select(
        source.otherwise("USD").alias("FromCurrencyCode"), F.lit("AUD").alias("ToCurrencyCode"),
        F.ceil("value").cast("double").alias("ConversionRate"), F.to_date("ts").alias("CreatedDate"),
    )


_CODES_SQL = "[" + ", ".join(f"'{c}'" for c in SALE_CODES) + "]"
_CURRENCY_SQL = """CASE WHEN l_returnflag = 'A' THEN 'AUD' WHEN l_returnflag = 'N' THEN 'NZD'
                    WHEN l_linestatus = 'F' THEN 'XXX' ELSE 'JPY' END"""

SALES = f"""
    charges AS (
        SELECT l_orderkey AS PassengerID, l_linenumber AS SegmentID, l_suppkey AS InventoryLegID,
               CAST(round(l_tax * 100) AS INTEGER) AS ChargeType,
               {_CODES_SQL}[CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER)] AS ChargeCode,
               l_extendedprice AS ChargeAmount, {_CURRENCY_SQL} AS CurrencyCode
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ),
    fees AS (
        SELECT l_orderkey AS PassengerID, l_linenumber AS SegmentID, l_suppkey AS InventoryLegID,
               {_CODES_SQL}[s_nationkey + 1] AS FeeCode, CAST(round(l_discount * 100) AS INTEGER) AS FeeType,
               CAST(round(l_tax * 100) AS INTEGER) AS ChargeType, l_quantity * l_discount AS ChargeAmount,
               {_CURRENCY_SQL} AS CurrencyCode
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    ),
    bookings AS (
        SELECT o_orderkey AS PassengerID, CAST(o_orderdate AS DATE) AS CreatedUTC
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ),
    history AS (
        SELECT CASE event_type WHEN 'click' THEN 'AUD' WHEN 'view' THEN 'NZD' WHEN 'error' THEN 'JPY' ELSE 'USD' END
                   AS FromCurrencyCode, 'AUD' AS ToCurrencyCode, ceil(value) AS ConversionRate,
               CAST(ts AS DATE) AS CreatedDate
        FROM events
    )"""
