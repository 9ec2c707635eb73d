"""Passenger legs, bookings, charges and fees put together from normalised source tables.

Small dimensions are joined without hints: the optimizer broadcasts them by their size. Tables with rows for each flight
are joined by a shuffle: estimates from compressed files are far below what they hold, most of all after an explode.
Tables are passed by name in a mapping: InventoryLeg, InventoryLegOp, InventoryLegClass,
InventoryLegNest, PassengerJourneyLeg, PassengerJourneySegment, BookingPassenger, Booking,
Organization, Domain, PassengerJourneyCharge, PassengerFee, PassengerFeeCharge, Fee, SSR.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.codes import NOT_OPERATING
from fareline.session import broadcast_if_small, keep_places, pin

Tables = Mapping[str, DataFrame]

# Least lid of the flights whose ancillary revenue is looked at (exclusive).
LID_FLOOR = 50
# Months looked at around a date range when inventory is pulled.
INVENTORY_MARGIN_MONTHS = 14
# Flights of a route, as bare IDs, that every task may hold: some 50 MB at most.
ROUTE_FLIGHTS = 500_000


def _at(value) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _flights(tables: Tables, origin: str | None, destination: str | None, low: Column, high: Column) -> DataFrame:
    flights = tables["InventoryLeg"].where(F.col("STD").between(low, high))
    if origin is not None:
        flights = flights.where(F.col("DepartureStation") == origin)
    if destination is not None:
        flights = flights.where(F.col("ArrivalStation") == destination)
    return flights.select("InventoryLegID")


def _flyers(tables: Tables, flights: DataFrame) -> DataFrame:
    legs = tables["PassengerJourneyLeg"]
    return legs.join(broadcast_if_small(flights, ROUTE_FLIGHTS, trust_estimate=False), "InventoryLegID", "left_semi").select("PassengerID")


def route_passengers(
    tables: Tables, origin: str | None, destination: str | None, start: dt.date, end: dt.date
) -> DataFrame:
    """Distinct passengers with a leg on the route that departs from a day before to a day after."""
    low = _at(F.date_sub(F.lit(start), 1))
    high = _at(F.date_add(F.lit(end), 1))
    return _flyers(tables, _flights(tables, origin, destination, low, high)).distinct()


def booked_passengers(tables: Tables) -> DataFrame:
    """Passengers with their booking's time and locator."""
    passengers = tables["BookingPassenger"].select("BookingID", "PassengerID", "FirstName")
    bookings = tables["Booking"].select(
        "BookingID", F.col("BookingUTC").alias("CreatedUTC"), "RecordLocator"
    )
    return passengers.join(bookings, "BookingID", "inner")


def named_segments(tables: Tables) -> DataFrame:
    """Segments with the names of their source organisation and domain."""
    organizations = tables["Organization"].select(
        F.col("OrganizationCode").alias("SourceOrganizationCode"),
        F.col("OrganizationName").alias("SourceOrganizationName"),
    )
    domains = tables["Domain"].select(
        F.col("DomainCode").alias("SourceDomainCode"), F.col("DomainName").alias("SourceDomainName")
    )
    return (
        tables["PassengerJourneySegment"]
        .join(organizations, "SourceOrganizationCode", "left")
        .join(domains, "SourceDomainCode", "left")
    )


_FLIGHT_COLUMNS = [
    "STDUTC", "STAUTC", "STD", "STA", "FlightNumber", "OperatingFlightNumber", "Status",
    "CarrierCode", "Capacity", "AdjustedCapacity", "Lid",
]
_PASSENGER_LEG_COLUMNS = ["PassengerID", "SegmentID", "LegNumber", "BookingStatus", "LiftStatus"]


def _shuffled(per_flight: DataFrame) -> DataFrame:
    """A table with rows for each flight, never broadcast on an estimate; adaptive execution still splits skew."""
    return per_flight.hint("merge")


def _operations(tables: Tables) -> DataFrame:
    return _shuffled(tables["InventoryLegOp"].select("InventoryLegID", "DepartureStatus"))


def _classes_of_flights(tables: Tables, flights: DataFrame, placed: bool = False) -> DataFrame:
    """Flights with one row per class of service and its nest, which meet before the wide flights do.

    `placed`: by flight once, so that no join by flight shuffles them again where places are kept (`session.keep_places`).
    """
    classes = tables["InventoryLegClass"].select("InventoryLegID", "ClassOfService", "ClassNest")
    if placed:
        classes = classes.repartition("InventoryLegID")
    nests = tables["InventoryLegNest"].select(
        "InventoryLegID", "ClassNest", F.col("TravelClassCode").alias("Compartment")
    )
    nested = classes.join(_shuffled(nests), ["InventoryLegID", "ClassNest"], "left").drop("ClassNest")
    wide = flights.select(
        "InventoryLegID", *_FLIGHT_COLUMNS,
        F.col("DepartureStation").alias("DepartureStationLeg"),
        F.col("ArrivalStation").alias("ArrivalStationLeg"),
    )
    return _shuffled(wide.join(_shuffled(nested), "InventoryLegID", "left"))


def described_legs(tables: Tables) -> DataFrame:
    """Passenger legs with flight, departure status, class and nest; one row per class of the flight.

    The flight side is joined up before the far larger passenger side meets it once.
    """
    legs = tables["PassengerJourneyLeg"].select("InventoryLegID", *_PASSENGER_LEG_COLUMNS)
    return legs.join(
        _classes_of_flights(tables, tables["InventoryLeg"]), "InventoryLegID", "left"
    ).join(_operations(tables), "InventoryLegID", "left")


_SEGMENT_KEYS = ["SegmentID", "PassengerID", "ClassOfService"]
_SEGMENT_COLUMNS = [
    *_SEGMENT_KEYS, "FareBasis", "SourceDomainCode", "SourceOrganizationCode", "DepartureStation",
    "ArrivalStation", "TripNumber", "JourneyNumber", "SegmentNumber", "CreatedLocationCode",
]


def legs_in_class(tables: Tables, segments: DataFrame, placed: bool = False) -> DataFrame:
    """The `described_legs` that some segment flies in its class of service.

    A leg meets its segments before its flight's classes, so that it joins the one class it needs and
    never spreads over all classes of the flight. Segments may be `placed` by passenger already, where places are kept.
    """
    # Placed by the join keys once, segment keys are de-duplicated and joined without a further shuffle.
    keys = segments.select(*_SEGMENT_KEYS)
    flown = (keys if placed else keys.repartition("SegmentID", "PassengerID")).distinct()
    legs = tables["PassengerJourneyLeg"].select("InventoryLegID", *_PASSENGER_LEG_COLUMNS)
    classes = _classes_of_flights(tables, tables["InventoryLeg"], placed)
    return (
        legs.join(flown, ["SegmentID", "PassengerID"], "inner")
        .join(classes, ["InventoryLegID", "ClassOfService"], "inner")
        .join(_operations(tables), "InventoryLegID", "left")
    )


def journey_legs(tables: Tables, segments: DataFrame | None = None) -> DataFrame:
    """Segments with their legs flown in the segment's class of service."""
    segments = named_segments(tables) if segments is None else segments
    segments = segments.select(*_SEGMENT_COLUMNS, "SourceOrganizationName", "SourceDomainName")
    legs = legs_in_class(tables, tables["PassengerJourneySegment"]).drop("InventoryLegID")
    return segments.join(legs, _SEGMENT_KEYS, "left")


def passenger_legs(
    tables: Tables, origin: str | None, destination: str | None, start: dt.date, end: dt.date
) -> DataFrame:
    """All journey legs, with booking, of the passengers who fly the route around the dates.

    The passenger list cuts every large table before it takes part in a join.
    """
    wanted = route_passengers(tables, origin, destination, start, end)
    cut = dict(tables)
    for name in ("PassengerJourneySegment", "PassengerJourneyLeg", "BookingPassenger"):
        cut[name] = tables[name].join(wanted, "PassengerID", "left_semi")
    return journey_legs(cut).join(booked_passengers(cut), "PassengerID", "left")


def placed_passenger_legs(
    tables: Tables, origin: str | None, destination: str | None, start: dt.date, end: dt.date, parts: int
) -> DataFrame:
    """`passenger_legs` with PassengerID as text, placed by it in `parts`.

    All of a passenger meets in one place: legs leave it once, as few columns, to meet their flights, and come back with
    them; segments and bookings stay.
    """
    by = "PassengerID"
    as_text = {name: df.withColumn(by, F.col(by).cast("string")) for name, df in tables.items() if by in df.columns}
    cut = dict(tables) | as_text
    keep_places(tables["PassengerJourneyLeg"].sparkSession)
    wanted = pin(route_passengers(cut, origin, destination, start, end).repartition(parts, by), by, parts)
    for name in ("PassengerJourneySegment", "PassengerJourneyLeg", "BookingPassenger"):
        cut[name] = as_text[name].join(wanted.hint("merge"), by, "left_semi")
    # Read twice, for their keys and whole: grouped once.
    segments = pin(cut["PassengerJourneySegment"].select(*_SEGMENT_COLUMNS), by, parts)
    named = named_segments({**cut, "PassengerJourneySegment": segments})
    legs = legs_in_class(cut, segments, placed=True).drop("InventoryLegID")
    # The join that comes last keeps the place, whatever the ones before it became.
    bookings = booked_passengers(cut).repartition(parts, by).hint("merge")
    return named.join(legs.hint("merge"), _SEGMENT_KEYS, "left").join(bookings, by, "left")


def inventory_legs(
    tables: Tables, origin: str | None, destination: str | None, start: dt.date, end: dt.date
) -> DataFrame:
    """Legs with flight, departure status and all nests, of the route's booked passengers.

    Dates reach 14 months to both sides. A passenger who matches several times counts once.
    """
    low = _at(F.add_months(F.lit(start), -INVENTORY_MARGIN_MONTHS))
    high = _at(F.add_months(F.lit(end), INVENTORY_MARGIN_MONTHS))
    flyers = _flyers(tables, _flights(tables, origin, destination, low, high))
    wanted = tables["BookingPassenger"].join(flyers, "PassengerID", "left_semi").select("PassengerID")
    nests = tables["InventoryLegNest"].select(
        "InventoryLegID", F.col("TravelClassCode").alias("Compartment"),
        F.col("NestType").alias("TravelClassCode"), F.col("Lid").alias("ClassLid"),
        F.col("AdjustedCapacity").alias("ClassAdjustedCapacity"),
    )
    flights = tables["InventoryLeg"].select(
        "InventoryLegID", *_FLIGHT_COLUMNS, "DepartureStation", "ArrivalStation"
    )
    legs = tables["PassengerJourneyLeg"].select("InventoryLegID", *_PASSENGER_LEG_COLUMNS)
    return (
        legs.join(wanted, "PassengerID", "left_semi")
        .join(_shuffled(flights), "InventoryLegID", "left")
        .join(_operations(tables), "InventoryLegID", "left")
        .join(_shuffled(nests), "InventoryLegID", "left")
        .drop("InventoryLegID")
    )


# Ancillary extract ----------------------------------------------------------------------------------


def route_inventory(
    tables: Tables, carrier: str, origin: str | None, destination: str | None, lid_floor: int = LID_FLOOR
) -> DataFrame:
    """Operating flights of a carrier on a route whose lid is above the floor."""
    flights = tables["InventoryLeg"].where(
        (F.col("CarrierCode") == carrier)
        & ~F.col("Status").isin(NOT_OPERATING)
        & (F.col("Lid") > lid_floor)
    )
    if origin is not None:
        flights = flights.where(F.col("DepartureStation") == origin)
    if destination is not None:
        flights = flights.where(F.col("ArrivalStation") == destination)
    return flights


def bookings_between(tables: Tables, channel: int, first: dt.date, last: dt.date) -> DataFrame:
    """Passengers of one channel's bookings made from `first` to midnight of `last`, both included."""
    made = F.col("CreatedUTC")
    bookings = (
        tables["Booking"]
        .where((F.col("ChannelType") == channel) & made.between(_at(first), _at(last)))
        .select("BookingID", F.to_date(made).alias("CreatedUTC"), "RecordLocator")
    )
    passengers = tables["BookingPassenger"].select("BookingID", "PassengerID", "FirstName")
    return passengers.join(bookings, "BookingID", "inner")


def legs_on_route(tables: Tables, flights: DataFrame, travel_class: str) -> DataFrame:
    """Passenger legs on chosen flights, for the classes of service of one travel class."""
    legs = tables["PassengerJourneyLeg"].select("InventoryLegID", *_PASSENGER_LEG_COLUMNS)
    wanted = _classes_of_flights(tables, flights).where(F.col("Compartment") == travel_class)
    return legs.join(wanted, "InventoryLegID", "inner").join(
        _operations(tables), "InventoryLegID", "left"
    )


def booked_legs(tables: Tables, legs: DataFrame, bookings: DataFrame) -> DataFrame:
    """Segments, their legs and their bookings; rows without one of the three are left out."""
    segments = tables["PassengerJourneySegment"].select(*_SEGMENT_COLUMNS)
    return segments.join(legs, _SEGMENT_KEYS, "inner").join(bookings, "PassengerID", "inner")


def leg_keys(booked: DataFrame) -> DataFrame:
    return booked.select("PassengerID", "SegmentID", "InventoryLegID")


def described_charges(tables: Tables, keys: DataFrame) -> DataFrame:
    """Charges of the booked legs, with the descriptions of charge code and ticket code."""
    fee = tables["Fee"]
    charge_names = fee.select(
        F.col("FeeCode").alias("ChargeCode"), F.col("Description").alias("ChargeCodeDescription")
    )
    ticket_names = fee.select(
        F.col("FeeCode").alias("TicketCode"), F.col("Description").alias("TicketCodeDescription")
    )
    return (
        tables["PassengerJourneyCharge"]
        .join(keys, ["PassengerID", "SegmentID"], "inner")
        .join(charge_names, "ChargeCode", "left")
        .join(ticket_names, "TicketCode", "left")
    )


def described_fees(tables: Tables, keys: DataFrame) -> DataFrame:
    """Fees of the booked legs with their charge lines and the names of fee and service codes."""
    fee_names = tables["Fee"].select("FeeCode", F.col("Description").alias("FeeCodeDescription"))
    service_names = tables["SSR"].select("SSRCode", F.col("Name").alias("SSRCodeDescription"))
    lines = tables["PassengerFeeCharge"].select(
        "PassengerID", "FeeNumber", "ChargeNumber", "ChargeType", "ChargeDetail", "ChargeAmount",
        "CurrencyCode",
    )
    return (
        tables["PassengerFee"]
        .join(keys, ["PassengerID", "InventoryLegID"], "inner")
        .join(fee_names, "FeeCode", "left")
        .join(lines, ["PassengerID", "FeeNumber"], "left")
        .join(service_names, "SSRCode", "left")
    )
