"""Legs to journeys with quality flags, valid trips and the booking-line view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import codes
from fareline.functions.nulls import all_true, any_true, join_text, strip_space, timestamp_text
from fareline.functions.ordered import digest_in_order, distinct_ahead, look_ahead, number_all_rows, number_rows
from fareline.session import broadcast_if_small, pin

JOURNEY = ["JourneyKey", "BookingID", "PassengerID", "TripNumber", "JourneyNumber"]
# The leg columns a journey is made of; legs equal in all of them count once.
JOURNEY_LEG_COLUMNS = [
    "JourneyKey", "Key", "BookingID", "PassengerID", "SegmentID", "Compartment", "ClassOfService",
    "DepartureStation", "ArrivalStation", "TripNumber", "JourneyNumber", "STDUTC", "STAUTC",
    "PassengerStatus", "FlightStatus", "InventoryStatus", "BookingStatus", "CarrierCode",
    "FlightCode", "SourceOrganizationCode",
]
# Order of the legs of a journey: by departure, then by all else, so that it is a total order.
LEG_ORDER = [
    "STDUTC", "STAUTC", "SegmentID", "Key", "DepartureStation", "ArrivalStation", "Compartment",
    "ClassOfService", "CarrierCode", "FlightCode", "PassengerStatus", "FlightStatus",
    "InventoryStatus", "BookingStatus", "SourceOrganizationCode",
]
# Flight numbers of scheduled flights, and a date far in the future.
SCHEDULED_NUMBER = r"^\d{1,3}$"
FAR_DATE = dt.date(2088, 8, 8)
LONGEST_LEAD_DAYS = 365


@dataclass(frozen=True)
class TripRules:
    """Which journeys count. Switches add a condition each; the hop bound always holds."""

    was_serviced: bool = False
    fully_serviced: bool = False
    booked_via_airline_channels: bool = False
    journey_standard_airline_fares: bool = False
    filter_group_bookings: bool = False
    flight_standard_airline_fares: bool = False
    hop_upper_bound: int = 1
    group_booking_lower_bound: int = 9


# Keys and status names ------------------------------------------------------------------------------

# What `with_keys` adds.
KEYS = ["FlightCode", "FlightKey", "Key", "JourneyKey"]


def with_flight_keys(legs: DataFrame, departure: str = "DepartureStationLeg", arrival: str = "ArrivalStationLeg") -> DataFrame:
    """Add FlightCode and FlightKey; a missing part makes the key null."""
    legs = legs.withColumn("FlightCode", strip_space(join_text("CarrierCode", "FlightNumber")))
    key = join_text(timestamp_text("STDUTC"), departure, arrival, "FlightCode", separator=".")
    return legs.withColumn("FlightKey", strip_space(key))


def with_keys(legs: DataFrame) -> DataFrame:
    """Add FlightCode, Key (the leg), JourneyKey and FlightKey."""
    journey = ["BookingID", "PassengerID", "TripNumber", "JourneyNumber"]
    leg = ["BookingID", "PassengerID", "SegmentID", "TripNumber", "JourneyNumber", "SegmentNumber", "LegNumber"]
    return with_flight_keys(legs).withColumns(
        {"Key": strip_space(join_text(*leg)), "JourneyKey": strip_space(join_text(*journey))}
    )


def with_status_names(legs: DataFrame, how: str = "inner") -> DataFrame:
    """Add the names of the three status codes.

    With `how="inner"` rows whose code is missing or unnamed are lost, with "left" they keep null.
    """
    spark = legs.sparkSession
    for names, code, name in (
        (codes.LIFT_STATUS, "LiftStatus", "PassengerStatus"),
        (codes.DEPARTURE_STATUS, "DepartureStatus", "FlightStatus"),
        (codes.INVENTORY_STATUS, "Status", "InventoryStatus"),
    ):
        legs = legs.join(F.broadcast(codes.status_table(spark, names, code, name)), code, how)
    return legs


# Journeys -------------------------------------------------------------------------------------------


def indirect_journeys(legs: DataFrame) -> DataFrame:
    """Distinct (PassengerID, JourneyNumber) of journeys with more than one leg, flagged."""
    later = F.col("SegmentNumber") + F.col("LegNumber") > 2
    return legs.where(later).select("PassengerID", "JourneyNumber").distinct().withColumn("Indirect", F.lit(True))


def group_bookings(legs: DataFrame, lower_bound: int) -> DataFrame:
    """Bookings of more than `lower_bound` passengers, flagged."""
    passengers = legs.groupBy("BookingID").agg(F.countDistinct("PassengerID").alias("n"))
    return passengers.where(F.col("n") > lower_bound).select("BookingID", F.lit(True).alias("GroupBooking"))


def distinct_legs(legs: DataFrame) -> DataFrame:
    return legs.select(*JOURNEY_LEG_COLUMNS).distinct()


def leg_links(legs: DataFrame, **limits) -> DataFrame:
    """Distinct legs with `links`: whether the arrival station is where the journey's next leg departs.

    Null for the last leg and where a station is missing.
    """
    legs = legs.select(*JOURNEY_LEG_COLUMNS)
    ahead = look_ahead(legs, JOURNEY, LEG_ORDER, {"__next": "DepartureStation"}, distinct=True, **limits)
    return ahead.withColumn("links", F.col("__next") == F.col("ArrivalStation")).drop("__next")


def journey_profile(
    legs: DataFrame, airline: str, organizations: Sequence[str], non_standard: Sequence[str],
    strict_standard: bool = False, **limits,
) -> DataFrame:
    """One row per journey: first departure, last arrival, hops and quality flags.

    Legs equal in all leg columns count once. All results are scalars; the legs themselves stay rows
    (see `leg_lists`). De-duplication, look-ahead and flags share one sort and one shuffle, and need no shuffle where the legs
    are placed by passenger already. By default a journey has standard fares unless all its classes are non-standard;
    `strict_standard` asks that none is.
    """
    airline_leg = F.col("CarrierCode") == airline
    non_standard_leg = F.col("ClassOfService").isin(list(non_standard))
    standard = ~any_true(non_standard_leg) if strict_standard else ~all_true(non_standard_leg)
    order = F.struct(*LEG_ORDER)
    return leg_links(legs, **limits).groupBy(*JOURNEY).agg(
        all_true(F.col("links")).alias("ValidJourneyChain"),
        F.min_by("DepartureStation", order).alias("JourneyStart"),
        F.min_by("STDUTC", order).alias("JourneyStartUTC"),
        F.max_by("ArrivalStation", order).alias("JourneyEnd"),
        F.max_by("STAUTC", order).alias("JourneyEndUTC"),
        (F.count("DepartureStation") - 1).alias("hops"),
        any_true(airline_leg).alias("Serviced"),
        all_true(airline_leg).alias("Fulfilled"),
        all_true(F.col("SourceOrganizationCode").isin(list(organizations))).alias("BookedViaAirline"),
        standard.alias("JourneyStandardAirlineFares"),
    )


def leg_positions(legs: DataFrame, **limits) -> DataFrame:
    """The distinct legs as rows with their `position` (1, 2, ..) inside their journey."""
    return number_rows(
        legs.select(*JOURNEY_LEG_COLUMNS), JOURNEY, LEG_ORDER, "position", distinct=True, **limits
    )


def leg_lists(legs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct legs of each journey as one ordered array of structs, whatever its length.

    Ties in the order are broken by the other columns. `leg_positions` gives the same as rows.
    """
    rest = [c for c in JOURNEY_LEG_COLUMNS if c not in JOURNEY] if columns is None else list(columns)
    others = [c for c in JOURNEY_LEG_COLUMNS if c not in JOURNEY and c not in LEG_ORDER]
    ordered = F.array_sort(F.collect_list(F.struct(*LEG_ORDER, *others)))
    # Placed by journey once, if they are not yet, legs are de-duplicated and listed without a further shuffle.
    return (
        distinct_ahead(legs.select(*JOURNEY_LEG_COLUMNS), JOURNEY, LEG_ORDER, {})
        .groupBy(*JOURNEY)
        .agg(ordered.alias("legs"))
        .withColumn("legs", F.transform("legs", lambda leg: F.struct(*[leg[c].alias(c) for c in rest])))
    )


def leg_digests(legs: DataFrame, text: Column, **limits) -> DataFrame:
    """Per journey the number `n` of distinct legs and the MD5 of their texts joined by "|", however long it is."""
    return digest_in_order(legs.select(*JOURNEY_LEG_COLUMNS), JOURNEY, LEG_ORDER, text, distinct=True, **limits)


def with_journey_flags(profile: DataFrame, indirect: DataFrame, groups: DataFrame) -> DataFrame:
    """Add Indirect and GroupBooking, false where the lookups have no row."""
    return (
        profile.join(indirect, ["PassengerID", "JourneyNumber"], "left")
        .join(groups, "BookingID", "left")
        .withColumns(
            {
                "Indirect": F.coalesce("Indirect", F.lit(False)),
                "GroupBooking": F.coalesce("GroupBooking", F.lit(False)),
            }
        )
    )


# Valid trips ----------------------------------------------------------------------------------------


def journey_condition(rules: TripRules) -> Column:
    """The conditions that are switched on, and the bound on hops."""
    switched = [
        (rules.was_serviced, F.col("Serviced")),
        (rules.fully_serviced, F.col("Fulfilled")),
        (rules.booked_via_airline_channels, F.col("BookedViaAirline")),
        (rules.journey_standard_airline_fares, F.col("JourneyStandardAirlineFares")),
        (rules.filter_group_bookings, ~F.col("GroupBooking")),
    ]
    conditions = [condition for on, condition in switched if on]
    return reduce(lambda a, b: a & b, [*conditions, F.col("hops") < rules.hop_upper_bound])


def trip_legs(
    legs: DataFrame, origin: str | None, destination: str | None, start, end, airline: str | None = None
) -> DataFrame:
    """Legs of scheduled, operating flights of a route that depart from start to end.

    A route end or airline of None leaves that test out.
    """
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    out = legs.where(
        F.col("STDUTC").between(low, high)
        & ~F.col("Status").isin(codes.NOT_OPERATING)
        & F.trim("FlightNumber").rlike(SCHEDULED_NUMBER)
    )
    for column, value in (("DepartureStation", origin), ("ArrivalStation", destination), ("CarrierCode", airline)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out


def standard_fares_only(legs: DataFrame, non_standard: Sequence[str]) -> DataFrame:
    return legs.where(~F.col("ClassOfService").isin(list(non_standard)))


def keys_of_journeys(legs: DataFrame, journeys: DataFrame) -> DataFrame:
    """Distinct leg keys of the given journeys, whose legs are rows of `legs`."""
    # A leg with a missing journey column has no key, so plain equality loses nothing.
    keyed = legs.where(F.col("Key").isNotNull()).select(*JOURNEY, "Key")
    return keyed.join(journeys.select(*JOURNEY), JOURNEY, "left_semi").select("Key").distinct()


def legs_with_keys(legs: DataFrame, keys: DataFrame) -> DataFrame:
    return legs.join(keys, "Key", "left_semi")


def lid_adjustment(legs: DataFrame, keys: DataFrame) -> DataFrame:
    """Per flight, the number of legs whose key is not among `keys`."""
    others = legs.where(F.col("Key").isNotNull()).join(keys, "Key", "left_anti")
    return others.groupBy("FlightKey").agg(F.count("FlightKey").alias("LidAdjustment"))


FLIGHT_COLUMNS = [
    "FlightKey", "STDUTC", "STD", "STAUTC", "STA", "DepartureStationLeg", "ArrivalStationLeg", "FlightNumber", "Lid",
]


def adjusted_lids(legs: DataFrame, adjustment: DataFrame) -> DataFrame:
    """Distinct flights with their lid less the number of other legs; null where there are none."""
    flights = legs.select(*FLIGHT_COLUMNS).distinct()
    joined = flights.join(adjustment, "FlightKey", "left")
    return joined.withColumn("AdjustedLid", F.col("Lid") - F.col("LidAdjustment"))


def valid_trips(
    legs: DataFrame, flagged: DataFrame, rules: TripRules, origin, destination, start, end,
    non_standard: Sequence[str] = (),
) -> DataFrame:
    """Trip legs that belong to journeys which pass the rules: their key is that of a leg of such a journey.

    A trip of a passing journey has its key there itself, which legs placed by passenger tell without a shuffle. The key of any
    other is found there only if other parts make the same text: such keys meet as hashes first, so that few legs move.
    """
    trips = trip_legs(legs, origin, destination, start, end)
    if rules.flight_standard_airline_fares:
        trips = standard_fares_only(trips, non_standard)
    trips = trips.where(F.col("Key").isNotNull())
    passing = pin(flagged.where(journey_condition(rules)).select(*JOURNEY))
    own, others = (trips.join(passing, JOURNEY, how) for how in ("left_semi", "left_anti"))
    of_key = F.xxhash64("Key").alias("__of_key")
    known = legs.where(F.col("Key").isNotNull()).join(passing, JOURNEY, "left_semi").select(of_key)
    shared = pin(others.select(of_key).distinct().join(known.hint("merge"), "__of_key", "left_semi"))
    if shared.isEmpty():
        return own
    shared = broadcast_if_small(shared, trust_estimate=False)
    maybe = lambda df: df.withColumn("__of_key", of_key).join(shared, "__of_key", "left_semi").drop("__of_key")
    return own.unionByName(legs_with_keys(maybe(others), keys_of_journeys(maybe(legs), passing)))


# Booking lines --------------------------------------------------------------------------------------

# Total order of booking lines, for row ids.
LINE_ORDER = [
    "BookingID", "PassengerID", "TripNumber", "JourneyNumber", "SegmentNumber", "LegNumber",
    "STDUTC", "SegmentID", "CarrierCode", "FlightNumber", "Compartment", "ClassOfService",
    "FareBasis", "CreatedUTC",
]
# What a booking line shows beside the order.
_SHOWN = ["RecordLocator", "DepartureStationLeg", "ArrivalStationLeg", "STD", "DepartureStation", "ArrivalStation"]


def passenger_numbers(legs: DataFrame, **limits) -> DataFrame:
    """Distinct (BookingID, PassengerID) with passenger_id 0, 1, 2, .. inside each booking."""
    pairs = legs.select("BookingID", "PassengerID").distinct()
    numbered = number_rows(pairs, ["BookingID"], ["PassengerID"], "passenger_id", **limits)
    return numbered.withColumn("passenger_id", F.col("passenger_id") - 1)


def booking_lines(legs: DataFrame, airline: str, time_format: str = "HHmm", **limits) -> DataFrame:
    """One booking line per leg: 24 columns, before the lead-time filter.

    `time_format="HHss"` prints hour and second, for consumers used to that.
    """
    # Row ids pin the legs; the passenger numbers then start from the pinned rows, not from scratch.
    # Only the columns of a line are joined, pinned and sorted.
    shown = legs.where(F.col("PassengerID").isNotNull()).select(*LINE_ORDER, *_SHOWN)
    rows = number_all_rows(shown, LINE_ORDER, "id")
    numbers = passenger_numbers(rows, **limits).withColumnsRenamed({"BookingID": "b", "PassengerID": "p"})
    same = F.col("BookingID").eqNullSafe(F.col("b")) & (F.col("PassengerID") == F.col("p"))
    return rows.join(numbers, same, "inner").select(
        "id",
        F.col("RecordLocator").alias("pnr_record_locator"),
        F.col("CarrierCode").alias("airline"),
        F.col("FlightNumber").alias("flight_number"),
        F.col("DepartureStationLeg").alias("origin"),
        F.col("ArrivalStationLeg").alias("destination"),
        F.to_date("STD").alias("departure_date"),
        F.col("Compartment").alias("compartment"),
        F.date_format("STD", time_format).alias("departure_time"),
        F.col("ClassOfService").alias("class"),
        F.lit(airline).alias("point_of_sale"),
        F.to_date("CreatedUTC").alias("creation_date"),
        F.lit(FAR_DATE).alias("expiry_date"),
        F.lit(0).alias("fare"),
        F.col("FareBasis").alias("fare_basis_code"),
        F.col("Compartment").alias("travelled_compartment"),
        (F.col("JourneyNumber") - 1).alias("segment_id"),
        "passenger_id",
        F.col("DepartureStation").alias("trip_origin"),
        F.col("ArrivalStation").alias("trip_destination"),
        F.lit(airline).alias("marketing_airline"),
        F.col("FlightNumber").alias("marketing_flight_number"),
        F.lit(True).alias("is_direct"),
        F.lit(True).alias("is_confirmed"),
    )


def lead_time_filter(lines: DataFrame, start: dt.date, longest: int = LONGEST_LEAD_DAYS) -> DataFrame:
    """Lines booked at most `longest` days before departure and before the range; numbers as int."""
    lead = F.date_diff("departure_date", "creation_date")
    kept = lines.where(
        lead.between(0, longest) & (F.col("creation_date") >= F.date_sub(F.lit(start), longest))
    )
    as_int = {c: F.trim(c).cast("int") for c in ("flight_number", "marketing_flight_number")}
    return kept.withColumns(as_int)
