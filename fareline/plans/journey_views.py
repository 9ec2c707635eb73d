"""A route's booking-line view and flight forecast, from passenger and inventory legs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.operators import assembly, curve, journeys
from fareline.operators.export import conform
from fareline.operators.journeys import TripRules
from fareline.schemas import struct_of
from fareline.sources.sinks import cached_extract, extract_path, is_written

# Passenger legs in a task that holds all of a passenger.
LEGS_A_TASK = 500_000


@dataclass(frozen=True)
class RouteStudy:
    """What is studied: an airline on a route between two dates, and which journeys count.

    Origin, destination or both may be None for all routes.
    """

    airline: str
    non_standard_fares: Sequence[str]
    organizations: Sequence[str]
    origin: str | None
    destination: str | None
    start: dt.date
    end: dt.date
    rules: TripRules = field(default_factory=TripRules)

    # Inputs -----------------------------------------------------------------------------------------

    def pull_legs(self, tables: Mapping[str, DataFrame], parts: int | None = None) -> DataFrame:
        """Passenger legs from source tables, with keys and status names, under the declared schema.

        With `parts` they are placed by passenger in as many.
        """
        route = (self.origin, self.destination, self.start, self.end)
        legs = assembly.placed_passenger_legs(tables, *route, parts) if parts else assembly.passenger_legs(tables, *route)
        typed = conform(legs, struct_of("passenger_legs"))
        return conform(journeys.with_status_names(journeys.with_keys(typed)), struct_of("enriched_passenger_legs"))

    def pull_inventory(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Inventory legs from source tables, with flight keys and status names, under the declared schema."""
        legs = assembly.inventory_legs(tables, self.origin, self.destination, self.start, self.end)
        typed = conform(legs, struct_of("inventory_legs"))
        keyed = journeys.with_flight_keys(typed, "DepartureStation", "ArrivalStation")
        return conform(journeys.with_status_names(keyed), struct_of("enriched_inventory_legs"))

    def load(
        self, spark: SparkSession, tables: Mapping[str, DataFrame], root: str, force: bool = False,
        save: bool = True,
    ) -> tuple[DataFrame, DataFrame]:
        """Legs and inventory, kept below `root` and read from there the next time; legs that are kept now lie by passenger.

        Their keys, the longest of their columns, are not kept but made of the others again.
        """
        where = (root, self.origin or "any", self.destination or "any", self.start, self.end)
        parts = 0
        if save and (force or not is_written(spark, extract_path(*where))):
            parts = max(spark.sparkContext.defaultParallelism, -(-tables["PassengerJourneyLeg"].count() // LEGS_A_TASK))
        legs = cached_extract(
            spark, extract_path(*where), lambda: self.pull_legs(tables, parts).drop(*journeys.KEYS), force=force,
            save=save, by="PassengerID", parts=parts,
        )
        inventory = cached_extract(
            spark, extract_path(*where, prefix="inventory_"), lambda: self.pull_inventory(tables).drop(*journeys.KEYS),
            force=force, save=save,
        )
        keyed = journeys.with_flight_keys(inventory, "DepartureStation", "ArrivalStation")
        return (
            conform(journeys.with_keys(legs), struct_of("enriched_passenger_legs")),
            conform(keyed, struct_of("enriched_inventory_legs")),
        )

    # Views ------------------------------------------------------------------------------------------

    def groups(self, legs: DataFrame) -> DataFrame:
        return journeys.group_bookings(legs, self.rules.group_booking_lower_bound)

    def profile(self, legs: DataFrame, **limits) -> DataFrame:
        """Journeys with all flags, from legs that are kept as an extract, best one placed by passenger."""
        plain = journeys.journey_profile(
            legs, self.airline, self.organizations, self.non_standard_fares, **{"pinned": True, **limits}
        )
        return journeys.with_journey_flags(plain, journeys.indirect_journeys(legs), self.groups(legs))

    def trips(self, legs: DataFrame) -> DataFrame:
        """Legs of the route that belong to journeys which pass the rules."""
        return journeys.valid_trips(
            legs, self.profile(legs), self.rules, self.origin, self.destination, self.start,
            self.end, self.non_standard_fares,
        )

    def booking_lines(self, legs: DataFrame, time_format: str = "HHmm") -> DataFrame:
        lines = journeys.booking_lines(self.trips(legs), self.airline, time_format)
        return journeys.lead_time_filter(lines, self.start)

    def flight_curve(self, legs: DataFrame) -> DataFrame:
        """Daily counts and running totals of each flight without gaps."""
        flown = journeys.trip_legs(
            legs, self.origin, self.destination, self.start, self.end, self.airline
        )
        daily = curve.daily_with_departure(curve.with_group_flag(flown, self.groups(legs)))
        totals = curve.running_totals(daily)
        longest = curve.LONGEST_LEAD_DAYS
        needed = F.greatest(F.date_sub(F.to_date("STD"), longest), F.date_sub(F.lit(self.start), longest))
        filled = curve.upsample_days(totals, first_needed=needed)
        carried = ["FlightKey", "Compartment", "STDUTC", "bookings_cum", "group_bookings_cum"]
        return curve.forward_fill(filled, carried).drop("STDUTC")

    def forecast(self, legs: DataFrame, inventory: DataFrame, time_format: str = "HH:mm") -> DataFrame:
        whole = curve.with_capacity(self.flight_curve(legs), inventory)
        columns = curve.forecast_columns(
            whole, self.airline, self.origin, self.destination, time_format
        )
        return curve.forecast_filter(columns, self.start)
