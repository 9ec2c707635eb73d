import datetime as dt
import random

import pytest

from fareline import codes
from fareline.operators import ancillary
from fareline.plans import revenue
from tests.conftest import rows

CHARGES = "PassengerID int, SegmentID int, InventoryLegID int, ChargeType int, ChargeCode string, ChargeAmount double"
FEES = "PassengerID int, SegmentID int, InventoryLegID int, FeeCode string, FeeType int, ChargeType int, ChargeAmount double"
RATES = "FromCurrencyCode string, ToCurrencyCode string, ConversionRate double, CreatedDate date"
DAY = dt.date(2024, 5, 1)


def test_no_code_is_in_two_categories():
    listed = [c for kind in codes.ANCILLARY_CODES for c in codes.codes_of(kind)]
    assert len(listed) == len(set(listed)) == 319
    assert {k: len(v) for k, v in codes.ANCILLARY_CODES.items()} == {"Bundles": 7, "Seats": 1, "Bags": 9, "Meals": 9}


def test_latest_rates(frame):
    old, new = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    history = frame(RATES, ("NZD", "AUD", 0.8, old), ("NZD", "AUD", 0.9, new), ("NZD", "AUD", 0.95, new), ("JPY", "AUD", 0.01, old), ("NZD", "USD", 7.0, new), ("AUD", "AUD", 1.0, old))
    assert rows(ancillary.latest_rates(history), "FromCurrencyCode", "ConversionRate") == [
        ("AUD", "AUD", 1.0), ("JPY", "AUD", 0.01), ("NZD", "AUD", 0.9), ("NZD", "AUD", 0.95)
    ]
    assert rows(ancillary.latest_rates(history, one_per_pair=True), "FromCurrencyCode")[-1] == ("NZD", "AUD", 0.95)


def test_conversion(frame):
    rates = frame("FromCurrencyCode string, ToCurrencyCode string, ConversionRate double", ("NZD", "AUD", 0.5), ("AUD", "AUD", 1.0))
    lines = frame("n int, ChargeAmount double, CurrencyCode string", (1, 10.0, "NZD"), (2, 10.0, "AUD"), (3, 10.0, "XXX"), (4, 10.0, None))
    assert rows(ancillary.to_one_currency(lines, rates), "n") == [(1, 5.0), (2, 10.0), (3, None), (4, None)]


def test_category(frame):
    t = frame("ContextCode string", ("BF20",), ("FLEX",), ("????",), (None,))
    got = {r.ContextCode: r.ContextDescription for r in ancillary.with_category(t, "Bags").collect()}
    assert got == {"BF20": "PRE_PAID_CHECK_IN", "FLEX": "NotHandled", "????": "NotHandled", None: "NotHandled"}


def test_tax_lines(frame):
    fees = frame(FEES, *[(1, 1, 1, code, fee, charge, 1.0) for code in ("FLEX", "BF20", "STF", "MA01") for fee in (1, 3, 5) for charge in (1, 3, 5)])
    # Bundles look at FeeType, all else at ChargeType; groups go by FeeType.
    assert rows(ancillary.fee_items(fees, "Bundles")) == [(1, 1, 1, "FLEX", 1, 3.0, "Fees")]
    for kind in ("Bags", "Seats", "Meals"):
        assert {(r.ContextType, r.ChargeAmount) for r in ancillary.fee_items(fees, kind).collect()} == {(1, 1.0), (3, 1.0), (5, 1.0)}


@pytest.mark.parametrize("kind, kept", [("Bags", [0.51]), ("Seats", [0.02, 0.5, 0.51]), ("Meals", [0.02, 0.5, 0.51]), ("Bundles", [None, 0.01, 0.02, 0.5, 0.51])])
def test_minimum(frame, kind, kept):
    t = frame("ChargeAmount double", (None,), (0.01,), (0.02,), (0.5,), (0.51,))
    assert [r[0] for r in rows(ancillary.above_minimum(t, kind), "ChargeAmount")] == kept


def _random_lines(seed=3, n=600):
    rng = random.Random(seed)
    pool = ["STRT", "FLEX", "MAX2", "BF20", "XB10", "CBG7", "STF", "MA01", "MFTT", "CHML", "none"]
    amount = lambda: rng.choice([None, 0.0, 0.01, 0.3, 0.5, 0.51, 2.0, 9.5])
    key = lambda: (rng.choice([1, 1, 1, rng.randint(2, 30)]), rng.randint(1, 3), rng.randint(1, 2))
    charges = [(*key(), rng.randint(0, 5), rng.choice(pool), amount()) for _ in range(n)]
    fees = [(*key(), rng.choice(pool), rng.choice([1, 3, 5, None]), rng.choice([1, 3, 5, None]), amount()) for _ in range(n)]
    return charges, fees


def test_reading_once_equals_class_by_class(frame):
    charges, fees = _random_lines()
    charges, fees = frame(CHARGES, *charges), frame(FEES, *fees)
    one_by_one = ancillary.base_fare_items(charges)
    for kind in codes.ANCILLARY_CODES:
        one_by_one = one_by_one.unionByName(ancillary.class_items(charges, fees, kind))
    together = ancillary.all_items(charges, fees)
    assert sorted(map(repr, rows(together.select(*one_by_one.columns)))) == sorted(map(repr, rows(one_by_one)))


def test_aggregate_and_explode(frame):
    charges, fees = _random_lines()
    items = ancillary.all_items(frame(CHARGES, *charges), frame(FEES, *fees))
    listed = ancillary.leg_aggregate(items)
    back = ancillary.explode_lists(ancillary.listed_columns(listed)).select(*items.columns)
    assert sorted(map(repr, rows(back))) == sorted(map(repr, rows(items)))
    placed = ancillary.item_positions(items, rows=5).groupBy(*ancillary.LEG, "AncilType").agg({"position": "max"})
    sizes = {tuple(r)[:4]: len(r["items"]) for r in listed.collect()}
    assert {tuple(r)[:4]: r[4] for r in placed.collect()} == sizes
    assert {tuple(r)[:4]: r["items"] for r in ancillary.leg_totals(items).collect()} == sizes


def test_a_large_leg_is_one_row(frame):
    fees = [(1, 1, 1, "XB10", 1, k, 1.0) for k in range(2500)]
    items = frame("PassengerID int, SegmentID int, InventoryLegID int, ContextCode string, n int, k int, ChargeAmount double", *fees)
    items = items.selectExpr("*", "'Fees' AS SOURCE", "'Bag' AS ContextDescription", "'Bags' AS AncilType")
    row, = ancillary.leg_aggregate(items).collect()
    assert (len(row["items"]), row.TotalCharge) == (2500, 2500.0)
    assert tuple(ancillary.leg_totals(items).first())[4:] == (2500, 2500.0)


@pytest.mark.parametrize("dedupe", [False, True])
def test_sums_before_the_join_equal_sums_after(frame, dedupe):
    charges, fees = _random_lines()
    items = ancillary.all_items(frame(CHARGES, *charges), frame(FEES, *fees))
    rng = random.Random(1)
    bookings = frame("PassengerID int, CreatedUTC date", *[(rng.randint(1, 20), DAY + dt.timedelta(days=rng.randint(0, 3))) for _ in range(80)])
    slow = ancillary.with_booking_date(items, bookings, dedupe).groupBy("CreatedUTC", "ContextDescription").agg(ancillary.sum_or_zero("ChargeAmount").alias("amount"))
    fast = ancillary.daily_category_sums(items, bookings, dedupe)
    as_map = lambda df: {(r[0], r[1]): r[2] for r in df.collect()}
    a, b = as_map(slow), as_map(fast)
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    pivoted = ancillary.pivot_categories(fast).collect()
    assert sum(r[c] or 0 for r in pivoted for c in codes.categories()) == pytest.approx(sum(a.values()))


def test_daily_revenue(frame):
    charges = frame(CHARGES + ", CurrencyCode string", (1, 1, 1, 0, "FARE", 100.0, "AUD"), (1, 1, 1, 1, "FLEX", 20.0, "NZD"), (1, 1, 1, 1, "STRT", 5.0, "AUD"), (1, 1, 1, 1, "BF20", 0.5, "AUD"))
    fees = frame(FEES + ", CurrencyCode string", (1, 1, 1, "STF", 1, 1, 7.005, "AUD"), (1, 1, 1, "XB10", 1, 1, 30.0, "AUD"), (1, 1, 1, "MA01", 1, 1, 12.0, "AUD"))
    rates = frame("FromCurrencyCode string, ToCurrencyCode string, ConversionRate double", ("NZD", "AUD", 0.5), ("AUD", "AUD", 1.0))
    bookings = frame("PassengerID int, CreatedUTC date", (1, DAY), (1, DAY), (9, DAY))
    twice = revenue.daily_revenue(charges, fees, bookings, rates).first()
    once = revenue.daily_revenue(charges, fees, bookings, rates, dedupe_bookings=True).first()
    assert (twice.BaseFare, twice.FLEX, twice.POST_PAID_CHECK_IN) == (200.0, 20.0, 60.0)
    # Meals and the starter bundle are in no total; a category without rows stays null.
    assert (once.BundleRevenue, once.BaggageRevenue, once.SeatRevenue) == (10.0, 30.0, 7.01)
    assert (once.AncilRevenue, once.TotalRevenue) == (47.01, 147.01)
    assert once.MAX is None and once.PRE_PAID_CHECK_IN is None
    assert len(twice.asDict()) == 22
