import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareline.operators import curve
from fareline.plans.journey_views import RouteStudy
from tests.conftest import rows
from tests.test_journeys import DEFAULTS, enriched, make_legs  # noqa: F401

STD = dt.datetime(2024, 3, 10, 9, 30)
ROW = "CreatedUTC timestamp_ntz, FlightKey string, Compartment string, CarrierCode string, FlightNumber string, STD timestamp_ntz, STDUTC timestamp_ntz, Booking int, GroupBooking int"


def booked(day, hour=5, compartment="Y", group=0, number="1", std=STD):
    return (dt.datetime(2024, 3, day, hour), f"K{number}", compartment, "XY", number, std, std, 1, group)


def d(day):
    return dt.date(2024, 3, day)


@pytest.fixture
def made(frame):
    return lambda *bookings: frame(ROW, *bookings)


def brief(df, *extra):
    return rows(df.select("CreatedUTC", "Compartment", "bookings", "group_bookings", *extra), "CreatedUTC", "Compartment")


def test_group_flag(enriched, frame):  # noqa: F811
    legs = enriched({}, dict(BookingID="B2"), dict(BookingID=None))
    got = curve.with_group_flag(legs, frame("BookingID string, GroupBooking boolean", ("B2", True)))
    assert rows(got.select("BookingID", "GroupBooking", "Booking"), "BookingID") == [(None, 0, 1), ("B1", 0, 1), ("B2", 1, 1)]


def test_days_and_sentinels(made):
    rows_in = made(booked(1), booked(1, 23, group=1), booked(3, compartment="J"), booked(10))
    daily = curve.daily_counts(rows_in)
    assert brief(daily) == [(d(1), "Y", 2, 1), (d(3), "J", 1, 0), (d(10), "Y", 1, 0)]
    last = curve.departure_rows(daily)
    assert brief(last) == [(d(10), "J", 0, 0), (d(10), "Y", 0, 0)]
    both = curve.add_up(daily, last)
    assert brief(both) == [(d(1), "Y", 2, 1), (d(3), "J", 1, 0), (d(10), "J", 0, 0), (d(10), "Y", 1, 0)]
    assert brief(curve.daily_with_departure(rows_in)) == brief(both)


def test_running_totals_end_at_the_sum(made):
    got = curve.running_totals(curve.daily_with_departure(made(booked(1), booked(1, compartment="J", group=1), booked(4), booked(12))))
    assert brief(got, "bookings_cum", "group_bookings_cum") == [
        (d(1), "J", 1, 1, 1, 1), (d(1), "Y", 1, 0, 2, 1), (d(4), "Y", 1, 0, 3, 1), (d(10), "J", 0, 0, 3, 1),
        (d(10), "Y", 0, 0, 3, 1), (d(12), "Y", 1, 0, 4, 1),
    ]


CARRIED = ["FlightKey", "Compartment", "STDUTC", "bookings_cum", "group_bookings_cum"]


def test_no_day_is_missing_and_values_carry_on(made):
    totals = curve.running_totals(curve.daily_with_departure(made(booked(6), booked(6, compartment="J"), booked(9), booked(8, number="2"))))
    gaps = curve.upsample_days(totals)
    one = gaps.where("FlightNumber = '1'")
    assert rows(one.select("CreatedUTC", "Compartment", "bookings", "bookings_cum", "filled"), "CreatedUTC", "Compartment") == [
        (d(6), "J", 1, 1, False), (d(6), "Y", 1, 2, False), (d(7), None, None, None, True), (d(8), None, None, None, True),
        (d(9), "Y", 1, 3, False), (d(10), "J", 0, 3, False), (d(10), "Y", 0, 3, False),
    ]
    filled = curve.forward_fill(gaps, CARRIED)
    assert brief(filled.where("FlightNumber = '1'"), "bookings_cum") == [
        (d(6), "J", 1, 0, 1), (d(6), "Y", 1, 0, 2), (d(7), "Y", 0, 0, 2), (d(8), "Y", 0, 0, 2), (d(9), "Y", 1, 0, 3),
        (d(10), "J", 0, 0, 3), (d(10), "Y", 0, 0, 3),
    ]
    two = [r.CreatedUTC for r in filled.where("FlightNumber = '2'").orderBy("CreatedUTC").collect()]
    assert two == [d(8), d(9), d(10)]


def test_windowed_fill_agrees(made):
    totals = curve.running_totals(curve.daily_with_departure(made(booked(1), booked(5), booked(5, compartment="J"), booked(14, number="2"))))
    gaps = curve.upsample_days(totals)
    by_window = curve.fill_gaps(gaps, ["bookings_cum", "group_bookings_cum"], order=["CreatedUTC", "Compartment"])
    columns = ["FlightNumber", "CreatedUTC", "bookings_cum", "group_bookings_cum"]
    assert rows(by_window.select(*columns), *columns) == rows(curve.forward_fill(gaps, CARRIED).select(*columns), *columns)


def test_days_before_the_needed_ones_are_not_made(made):
    totals = curve.running_totals(curve.daily_with_departure(made(booked(1), booked(9))))
    some = curve.upsample_days(totals, first_needed=F.lit(d(7)))
    assert [r.CreatedUTC for r in some.orderBy("CreatedUTC").collect()] == [d(1), d(7), d(8), d(9), d(10)]
    late = curve.upsample_days(totals, first_needed=F.lit(dt.date(2025, 1, 1)))
    assert [r.CreatedUTC for r in late.orderBy("CreatedUTC").collect()] == [d(1), d(9), d(10)]


def test_forecast(enriched, frame):  # noqa: F811
    std = DEFAULTS["STD"]
    before = lambda n: dict(CreatedUTC=std - dt.timedelta(days=n))
    legs = enriched(before(2), dict(PassengerID="P2", **before(2)), dict(BookingID="B2", PassengerID="P3", **before(0)),
                    dict(BookingID="B3", PassengerID="P4", **before(400)), dict(BookingID="B4", CarrierCode="ZZ"), dict(BookingID="B5", FlightNumber="A12"))
    stock = "FlightKey string, Compartment string, AdjustedCapacity int, STD timestamp_ntz, STA timestamp_ntz, Capacity int, Lid int, ClassLid string, ClassAdjustedCapacity string"
    key = legs.where("BookingID = 'B1'").first().FlightKey
    one = (key, "Y", 170, std, std + dt.timedelta(hours=2), 180, 175, "60", "55")
    study = RouteStudy("XY", [], [], "AAA", "BBB", dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    view = study.forecast(legs, frame(stock, one, one))
    assert len(view.columns) == 20
    # The booking of 400 days before counts, its own days are cut off.
    assert view.count() == 366
    last = rows(view.where("days_prior_dep <= 3").select("days_prior_dep", "ttl_bkd", "ttl_bkd_with_grp", "capture_date"), "days_prior_dep")
    assert [r[:3] for r in last] == [(0, 4, 4), (1, 3, 3), (2, 3, 3), (3, 1, 1)]
    top = view.where("days_prior_dep = 0").first()
    assert (top.oprg_flt_no, top.adj_cap, top.phy_cap, top.au, top.leg_dep_time_locl, top.leg_arvl_time_locl) == ("823", 55, "60", "60", "09:30", "11:30")
    assert (top.flt_dep_date_locl, top.cmpt_code, top.bid_price) == ("2024-03-10", "Y", 0)
    bare = study.forecast(legs, frame(stock)).where("days_prior_dep = 0").first()
    assert (bare.adj_cap, bare.leg_arvl_time_locl, bare.ttl_bkd) == (None, None, 4)


def test_latest_capture(frame):
    t = frame("f string, day date, c string, n int", ("a", d(1), "Y", 1), ("a", d(2), "J", 2), ("a", d(2), "Y", 3), ("b", d(1), "Y", 4))
    assert rows(curve.latest_capture(t, ["f"], "day", ["c"]), "f") == [("a", d(2), "Y", 3), ("b", d(1), "Y", 4)]
