import datetime as dt

import pytest

from fareline.operators import journeys
from fareline.operators.journeys import TripRules
from fareline.plans.journey_views import RouteStudy
from tests.conftest import rows

STAMP = dt.datetime(2024, 3, 10, 9, 30, 15)
DEFAULTS = dict(
    FirstName="x", CreatedUTC=dt.datetime(2024, 1, 1, 5), BookingID="B1", RecordLocator="R", PassengerID="P1", SegmentID="S1",
    Compartment="Y", FareBasis="F", ClassOfService="H", SourceOrganizationCode="ORG", DepartureStation="AAA", ArrivalStation="BBB",
    DepartureStationLeg="AAA", ArrivalStationLeg="BBB", TripNumber=1, JourneyNumber=1, SegmentNumber=1, LegNumber=1, STDUTC=STAMP,
    STD=STAMP, STAUTC=STAMP + dt.timedelta(hours=2), STA=STAMP + dt.timedelta(hours=2), CarrierCode="XY", FlightNumber=" 823",
    Status=0, DepartureStatus=0, LiftStatus=0, BookingStatus="C", Capacity=180, AdjustedCapacity=170, Lid=175,
)


@pytest.fixture
def make_legs(spark):
    from fareline import schemas
    from fareline.operators.export import conform

    schema = schemas.struct_of("passenger_legs")

    def make(*changes):
        full = [{**{n: None for n in schema.names}, **DEFAULTS, **c} for c in changes]
        return conform(spark.createDataFrame([tuple(r[n] for n in schema.names) for r in full], schema), schema)

    return make


@pytest.fixture
def enriched(make_legs):
    return lambda *changes: journeys.with_status_names(journeys.with_keys(make_legs(*changes)))


def later(hours):
    return dict(STDUTC=STAMP + dt.timedelta(hours=hours), STAUTC=STAMP + dt.timedelta(hours=hours + 2))


def test_keys(make_legs):
    got = journeys.with_keys(make_legs({})).first()
    assert got.FlightCode == "XY 823"
    assert got.Key == "B1P1S11111" and got.JourneyKey == "B1P111"
    assert got.FlightKey == "2024-03-10 09:30:15.000000.AAA.BBB.XY 823"
    stripped = journeys.with_keys(make_legs(dict(CarrierCode="\tXY", FlightNumber="8 \n"))).first()
    assert stripped.FlightCode == "XY8"


@pytest.mark.parametrize("missing, null_keys", [
    ("BookingID", {"Key", "JourneyKey"}), ("SegmentID", {"Key"}), ("LegNumber", {"Key"}), ("STDUTC", {"FlightKey"}),
    ("ArrivalStationLeg", {"FlightKey"}), ("FlightNumber", {"FlightCode", "FlightKey"}),
])
def test_a_missing_part_makes_the_key_null(make_legs, missing, null_keys):
    got = journeys.with_keys(make_legs({missing: None})).first()
    assert {k for k in ("FlightCode", "Key", "JourneyKey", "FlightKey") if got[k] is None} == null_keys


def test_status_names(make_legs):
    legs = make_legs({}, dict(Status=4), dict(LiftStatus=None), dict(Status=5, DepartureStatus=5, LiftStatus=3))
    names = ["PassengerStatus", "FlightStatus", "InventoryStatus"]
    assert rows(journeys.with_status_names(legs).select(*names), "Status") == [("Pending", "Default", "Normal"), ("NoShow", "Departed", "ClosedPending")]
    assert journeys.with_status_names(legs, "left").count() == 4


def test_indirect_and_groups(enriched):
    legs = enriched({}, dict(PassengerID="P2", SegmentNumber=2), dict(PassengerID="P2", LegNumber=2), dict(BookingID="B2", PassengerID="P3"), dict(PassengerID=None))
    assert rows(journeys.indirect_journeys(legs)) == [("P2", 1, True)]
    assert rows(journeys.group_bookings(legs, 1)) == [("B1", True)]
    assert rows(journeys.group_bookings(legs, 2)) == []
    assert rows(journeys.group_bookings(legs, 0), "BookingID") == [("B1", True), ("B2", True)]


def profile(legs, **kw):
    return journeys.journey_profile(legs, "XY", ["ORG"], ["H"], **kw)


@pytest.mark.parametrize("limits", [{}, {"rows": 1}])
def test_profile(enriched, limits):
    legs = enriched(
        dict(PassengerID="one"),
        dict(PassengerID="good", ArrivalStation="MID"), dict(PassengerID="good", SegmentID="S2", DepartureStation="MID", **later(3)),
        dict(PassengerID="gap", ArrivalStation="MID"), dict(PassengerID="gap", SegmentID="S2", DepartureStation="OTH", CarrierCode="ZZ", ClassOfService="Q", **later(3)),
        dict(PassengerID="twice"), dict(PassengerID="twice"),
        dict(PassengerID="nocarrier", CarrierCode=None, SourceOrganizationCode="else"),
    )
    got = {r.PassengerID: r for r in profile(legs, **limits).collect()}
    assert {p: r.ValidJourneyChain for p, r in got.items()} == {"one": True, "good": True, "gap": False, "twice": True, "nocarrier": True}
    assert {p: r.hops for p, r in got.items()} == {"one": 0, "good": 1, "gap": 1, "twice": 0, "nocarrier": 0}
    assert (got["good"].JourneyStart, got["good"].JourneyEnd) == ("AAA", "BBB")
    assert got["good"].JourneyEndUTC == STAMP + dt.timedelta(hours=5)
    assert (got["gap"].Serviced, got["gap"].Fulfilled) == (True, False)
    # Nothing known of the carrier: not served by the airline, yet no leg speaks against it.
    assert (got["nocarrier"].Serviced, got["nocarrier"].Fulfilled) == (False, True)
    assert not got["nocarrier"].BookedViaAirline and got["one"].BookedViaAirline
    assert {p: r.JourneyStandardAirlineFares for p, r in got.items() if p in ("one", "gap")} == {"one": False, "gap": True}
    strict = {r.PassengerID: r for r in profile(legs, strict_standard=True).collect()}
    assert not strict["gap"].JourneyStandardAirlineFares


def test_leg_lists_are_ordered(enriched):
    legs = enriched(*[dict(SegmentID=f"S{n}", **later(-n)) for n in range(5)])
    whole = journeys.leg_lists(legs, ["SegmentID"]).collect()
    assert [leg.SegmentID for leg in whole[0].legs] == ["S4", "S3", "S2", "S1", "S0"]
    placed = journeys.leg_positions(legs, rows=1).orderBy("position").collect()
    assert [(r.position, r.SegmentID) for r in placed] == [(k + 1, f"S{4 - k}") for k in range(5)]


def test_a_long_journey_is_one_row(enriched):
    legs = enriched(*[dict(SegmentID=f"S{n}", **later(n)) for n in range(1500)])
    row, = journeys.leg_lists(legs, ["SegmentID"]).collect()
    assert [leg.SegmentID for leg in row.legs] == [f"S{n}" for n in range(1500)]


def test_each_switch(frame):
    flags = "Serviced boolean, Fulfilled boolean, BookedViaAirline boolean, JourneyStandardAirlineFares boolean, GroupBooking boolean, hops int"
    best = [True, True, True, True, False, 0]
    switches = ["was_serviced", "fully_serviced", "booked_via_airline_channels", "journey_standard_airline_fares", "filter_group_bookings"]
    for position, switch in enumerate(switches):
        worse = list(best)
        worse[position] = not worse[position]
        t = frame(flags, tuple(best), tuple(worse))
        assert t.where(journeys.journey_condition(TripRules())).count() == 2
        assert t.where(journeys.journey_condition(TripRules(**{switch: True}))).count() == 1
    t = frame(flags, tuple(best), (*best[:5], 1))
    assert t.where(journeys.journey_condition(TripRules(hop_upper_bound=1))).count() == 1


@pytest.mark.parametrize("number, kept", [("7", True), (" 823", True), ("1234", False), ("A12", False), ("", False), (None, False)])
def test_scheduled_numbers(enriched, number, kept):
    legs = enriched(dict(FlightNumber=number))
    assert journeys.trip_legs(legs, "AAA", "BBB", STAMP, STAMP).count() == kept


def test_trip_legs(enriched):
    legs = enriched({}, dict(Status=2), dict(Status=3), dict(Status=1), dict(DepartureStation="ZZZ"), dict(CarrierCode="ZZ"), later(1))
    assert journeys.trip_legs(legs, "AAA", "BBB", STAMP, STAMP).count() == 3
    assert journeys.trip_legs(legs, None, None, STAMP, STAMP).count() == 4
    assert journeys.trip_legs(legs, "AAA", "BBB", STAMP, STAMP, "XY").count() == 2
    assert journeys.standard_fares_only(legs, ["H"]).count() == 0


def test_lid_adjustment(enriched, frame):
    legs = enriched({}, dict(PassengerID="P2"), dict(PassengerID="P3"), dict(BookingID=None, PassengerID="P4"))
    keys = frame("Key string", ("B1P1S11111",))
    others = journeys.lid_adjustment(legs, keys)
    assert [r.LidAdjustment for r in others.collect()] == [2]
    assert [r.AdjustedLid for r in journeys.adjusted_lids(legs, others).collect()] == [173]


@pytest.mark.parametrize("limits", [{}, {"rows": 1}])
def test_passenger_numbers_do_not_multiply_legs(enriched, limits):
    legs = enriched(dict(PassengerID="P9"), dict(PassengerID="P2"), dict(PassengerID="P2", LegNumber=2), dict(BookingID="B2", PassengerID="P5"))
    assert rows(journeys.passenger_numbers(legs, **limits), "BookingID", "PassengerID") == [("B1", "P2", 0), ("B1", "P9", 1), ("B2", "P5", 0)]
    lines = journeys.booking_lines(legs, "XY", **limits)
    assert len(lines.columns) == 24
    assert rows(lines.select("id", "passenger_id"), "id") == [(0, 0), (1, 0), (2, 1), (3, 0)]


def test_booking_line_values(enriched):
    line = journeys.booking_lines(enriched({}), "XY").first()
    assert (line.departure_date, line.departure_time, line.creation_date) == (dt.date(2024, 3, 10), "0930", dt.date(2024, 1, 1))
    assert (line.expiry_date, line.fare, line.segment_id) == (dt.date(2088, 8, 8), 0, 0)
    assert journeys.booking_lines(enriched({}), "XY", "HHss").first().departure_time == "0915"


@pytest.mark.parametrize("days_before, kept", [(-1, False), (0, True), (365, True), (366, False)])
def test_lead_time(enriched, days_before, kept):
    lines = journeys.booking_lines(enriched(dict(CreatedUTC=STAMP - dt.timedelta(days=days_before))), "XY")
    assert journeys.lead_time_filter(lines, dt.date(2024, 3, 1)).count() == kept


def test_lead_time_before_range(enriched):
    lines = journeys.booking_lines(enriched(dict(CreatedUTC=STAMP - dt.timedelta(days=300))), "XY")
    assert journeys.lead_time_filter(lines, dt.date(2024, 3, 10)).first().flight_number == 823
    assert journeys.lead_time_filter(lines, dt.date(2026, 3, 10)).count() == 0


def test_whole_view(enriched):
    study = RouteStudy("XY", ["Q"], ["ORG"], "AAA", "BBB", dt.date(2024, 3, 1), dt.date(2024, 3, 31),
                       TripRules(fully_serviced=True, filter_group_bookings=True, flight_standard_airline_fares=True, group_booking_lower_bound=2))
    legs = enriched(
        dict(PassengerID="P1"), dict(PassengerID="P2", CarrierCode="ZZ"), dict(BookingID="B2", PassengerID="P3", ClassOfService="Q"),
        *[dict(BookingID="B3", PassengerID=f"G{n}") for n in range(3)],
        dict(BookingID="B4", PassengerID="P8"), dict(BookingID="B4", PassengerID="P8", SegmentID="S2", DepartureStation="BBB", ArrivalStation="CCC", **later(4)),
    )
    assert rows(study.booking_lines(legs).select("id", "passenger_id", "flight_number")) == [(0, 0, 823)]
    assert {r.PassengerID for r in study.trips(legs).collect()} == {"P1"}


def test_a_key_that_other_parts_make_too_is_found(enriched):
    study = RouteStudy("XY", [], [], None, None, dt.date(2024, 3, 1), dt.date(2024, 3, 31), TripRules(was_serviced=True))
    alike = dict(BookingID="B11", PassengerID="P", CarrierCode="ZZ")
    legs = enriched(
        dict(BookingID="B1", PassengerID="1P"), alike, alike, dict(BookingID="B9", PassengerID="P9", CarrierCode="ZZ"),
        dict(PassengerID="P5", SegmentID=None), dict(PassengerID="P6"), dict(PassengerID="P6"),
    )
    assert rows(study.trips(legs).select("BookingID", "PassengerID"), "PassengerID") == [("B1", "1P"), ("B11", "P"), ("B11", "P"), ("B1", "P6"), ("B1", "P6")]


def test_load_keeps_the_extract(spark, path):
    from checks import standins

    tables = standins.sources(spark, "/root/testdata/sf0.001")
    study = RouteStudy("ECONOMY", [], [], None, None, dt.date(1998, 1, 1), dt.date(2001, 1, 1))
    root = path("extracts")
    legs, inventory = study.load(spark, tables, root)
    again, _ = study.load(spark, {}, root)
    assert legs.count() == again.count() > 0 and inventory.count() > 0
    from fareline import schemas

    assert set(legs.columns) == set(schemas.struct_of("enriched_passenger_legs").names)
    assert set(inventory.columns) == set(schemas.struct_of("enriched_inventory_legs").names)
