"""Ancillary revenue: from source tables to extracts, from extracts to daily revenue."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from fareline.operators import ancillary, assembly
from fareline.operators.export import conform
from fareline.schemas import struct_of
from fareline.session import pin


def extract(
    tables: Mapping[str, DataFrame], carrier: str, origin: str | None, destination: str | None,
    first: dt.date, last: dt.date, travel_class: str = "Y", channel: int = 2,
) -> dict[str, DataFrame]:
    """Bookings, charges and fees of a route; all three rest on one set of booked legs."""
    flights = assembly.route_inventory(tables, carrier, origin, destination)
    legs = assembly.legs_on_route(tables, flights, travel_class)
    made = assembly.bookings_between(tables, channel, first, last)
    # One set of booked legs for all three outputs: the joins before it run once.
    booked = pin(assembly.booked_legs(tables, legs, made))
    keys = assembly.leg_keys(booked)
    return {
        "bookings": booked,
        "charges": assembly.described_charges(tables, keys),
        "fees": assembly.described_fees(tables, keys),
    }


#: The declared schema of each extract.
SCHEMAS = {"bookings": "bookings", "charges": "journey_charges", "fees": "journey_fees"}


def typed_extract(pulled: Mapping[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    """Extracts under their declared schemas; a value that does not fit fails the job, or becomes null if not `strict`."""
    return {name: conform(pulled[name], struct_of(schema), strict) for name, schema in SCHEMAS.items()}


def revenue_of_route(
    tables: Mapping[str, DataFrame], history: DataFrame, carrier: str, origin: str | None, destination: str | None,
    first: dt.date, last: dt.date, travel_class: str = "Y", channel: int = 2, one_rate_per_pair: bool = False,
    dedupe_bookings: bool = False,
) -> DataFrame:
    """Daily revenue of a route from source tables: extracts, typed, then converted, categorised and pivoted."""
    pulled = typed_extract(extract(tables, carrier, origin, destination, first, last, travel_class, channel))
    rates = conform(ancillary.latest_rates(history, one_per_pair=one_rate_per_pair), struct_of("currency_conversion"))
    return daily_revenue(pulled["charges"], pulled["fees"], pulled["bookings"], rates, dedupe_bookings)


def daily_revenue(
    charges: DataFrame, fees: DataFrame, bookings: DataFrame, rates: DataFrame,
    dedupe_bookings: bool = False,
) -> DataFrame:
    """Daily revenue by category and in total, in one currency, by booking date."""
    rates = pin(rates)  # a row or few for each pair; charges, fees and their counts read it again
    items = ancillary.all_items(
        ancillary.to_one_currency(charges, rates), ancillary.to_one_currency(fees, rates)
    )
    daily = ancillary.daily_category_sums(items, bookings, dedupe_bookings)
    return ancillary.revenue_columns(ancillary.pivot_categories(daily))
