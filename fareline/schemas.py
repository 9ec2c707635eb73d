"""Declared table schemas.

Type words: `cat` is text with few distinct values (exempt from control-character cleaning),
`u16`/`u32` are unsigned in the source and carry a range check, `ts` is a timestamp without zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "u16": T.IntegerType(), "u32": T.LongType(),
    "double": T.DoubleType(), "float": T.FloatType(), "str": T.StringType(), "cat": T.StringType(),
    "bool": T.BooleanType(), "ts": T.TimestampNTZType(), "date": T.DateType(),
}
_UNSIGNED_MAX = {"u16": 65_535, "u32": 4_294_967_295}

# Column names, order and types of the tables this library reads and writes.
_DECLARED = {
    "Treatment": """
        TreatmentID long, ClientCode cat, SamplingRandomNumber double, LoggedUTC ts, SourceCode cat,
        TripFirstTravelDate ts, PaxType cat, ChannelID cat, RoleName cat, TripOriginLocationCode cat,
        TripDestinationLocationCode cat, ExternalBookingID str, NumberOfPassengers int,
        TotalItineraryPrice double, FareClass cat, TripType int, Stage int, ValueType cat,
        RequestedCurrency cat, SessionStartDateTime ts""",
    "TreatmentProductRanked": """
        TreatmentIDLook long, TreatmentProductSequence int, TreatmentRanked u16, TreatmentIDBook long,
        QuantityBooked int, FinalStage u16, ProductID u16, ProductName cat, AmountReport double,
        CurrencyCodeReport cat, Amount double, OriginalPrice float, CurrencyCode cat,
        QuantityAvailable int, CalculatedFrom int, GroupCode cat, TreatmentOrdinal u16,
        TreatmentIDLookByProduct long, OfferCode cat, OptimizedPoints int, MinLoggedUTC ts""",
    "TreatmentProduct": """
        TreatmentProductSequence u32, ProductID u16, Amount float, OriginalPrice float,
        CurrencyCode cat, QuantityAvailable int, CalculatedFrom u16, GroupCode cat,
        TreatmentOrdinal u16, OfferCode cat, OptimizedPoints u16, TreatmentID long, ClientCode cat,
        QuantityRequested u32, SegmentProductRatio float, Cost double, LoggedUTC ts""",
    "TreatmentProductInputParameterPivot": """
        TreatmentProductSequence int, TreatmentID long, FareClass cat,
        JourneyFareClassOfServiceList str, FareClassID int, ProbabilityMatch double,
        BookingWeekday cat, output_label1ID u16, BookingWeekdayID u16, LabelMatch cat,
        LineOfBusiness cat, output_label1 str, output_probability1 float, output_probability2 float,
        LoggedUTC ts""",
    "TreatmentDistinctRanked": """
        MinTreatmentID long, SamplingRandomNumber double, MinLoggedUTC ts, MaxLoggedUTC ts,
        MaxExternalBookingID str, ExternalBookingID str, Stage u16, TripReturnTravelDate ts,
        TripFirstTravelDate ts, PaxType cat, ChannelID str, RoleName cat, TripOriginLocationCode cat,
        TripDestinationLocationCode cat, NumberOfPassengers u16, MinTotalItineraryPrice double,
        FareClass cat, TripType u16, TreatmentRank u16, AgentID long, CustomerHomeCity str,
        MarketingCarrierCode cat, OperatingCarrierCode cat, ResidentCountryCode cat,
        SegmentDestinationCountryCode cat, SegmentOriginLocationCodeTimeZoneOffsetMinutes int,
        SegmentTravelTime ts, ServiceBundleCode cat, TotalFareWithoutFeeAndTax double,
        TravelBooked bool, TripDestinationCountryCode cat, TripOriginCountryCode cat,
        IsInServiceBundle str, JourneyTravelTime str, SegmentDestinationLocationCode str,
        SegmentFirstTravelDate ts, SegmentOriginCountryCode cat, SegmentOriginLocationCode cat,
        TotalFare double, TripOriginLocationCodeTimeZoneOffsetMinutes int,
        ContryDestinationLocationCode cat, ContryOriginLocationCode cat, FirstPassengerHomeCity str,
        TestName str, OverrideSamplingRandomNumber str, PromotionCode str, CustomDiscountCode str,
        AssignableSeatsCount str, SegmentEquipmentSalesConfiguration str, CjDiscountCode str,
        LoyaltyFilter str, PricingDate str, JourneyDestinationLocationCode cat,
        JourneyDestinationCountryCode cat, JourneyOriginCountryCode cat, JourneyOriginLocationCode cat,
        JourneyMarketingCarrierCodeList str, JourneyOperatingCarrierCodeList str,
        JourneyOperatingFlightNumberList str, JourneyMarketingFlightNumberList str,
        JourneyFlightType cat, WebSessionID str, JourneySoldLegByTravelClassList str,
        JourneyConnectingStationsList str, MMB str, SessionStartDateTime str, Workflow cat,
        ApplyCjDiscount str, ClientName str, SegmentEquipmentType cat, SegmentEquipmentTypeSuffix cat,
        TotalFareAdjustment str, TotalFarePoints str, TotalFarePointsAdjustment str,
        TotalOriginalFare double, SourceOrganizationCode cat""",
    "day_bounds": """
        date ts, start ts, end ts, logged_start_id long, logged_start_datetime ts,
        logged_end_id long, logged_end_datetime ts""",
    "passenger_legs": """
        FirstName str, CreatedUTC ts, BookingID str, RecordLocator str, PassengerID str, SegmentID str,
        Compartment str, FareBasis str, ClassOfService str, SourceDomainName str, SourceDomainCode str,
        SourceOrganizationName str, SourceOrganizationCode str, DepartureStation str,
        ArrivalStation str, TripNumber int, JourneyNumber int, SegmentNumber int,
        CreatedLocationCode str, LegNumber int, STDUTC ts, STD ts, STAUTC ts, STA ts, CarrierCode str,
        FlightNumber str, OperatingFlightNumber str, Status int, DepartureStatus int,
        DepartureStationLeg str, ArrivalStationLeg str, BookingStatus str, LiftStatus int,
        Capacity int, AdjustedCapacity int, Lid int""",
    "inventory_legs": """
        PassengerID str, SegmentID str, Compartment str, STDUTC ts, STD ts, STAUTC ts, STA ts,
        LegNumber int, FlightNumber str, OperatingFlightNumber str, Status int, DepartureStatus int,
        DepartureStation str, ArrivalStation str, CarrierCode str, BookingStatus str, LiftStatus int,
        Capacity int, AdjustedCapacity int, Lid int, TravelClassCode str, ClassLid str,
        ClassAdjustedCapacity str""",
    "bookings": """
        FirstName str, CreatedUTC date, BookingID int, RecordLocator str, InventoryLegID int,
        PassengerID int, SegmentID int, Compartment str, FareBasis str, ClassOfService str,
        SourceDomainCode str, SourceOrganizationCode str, DepartureStation str, ArrivalStation str,
        TripNumber int, JourneyNumber int, SegmentNumber int, CreatedLocationCode str, LegNumber int,
        STDUTC ts, STD ts, STAUTC ts, STA ts, CarrierCode str, FlightNumber str,
        OperatingFlightNumber str, Status int, DepartureStatus int, DepartureStationLeg str,
        ArrivalStationLeg str, BookingStatus str, LiftStatus int, Capacity int, AdjustedCapacity int,
        Lid int""",
    "journey_charges": """
        CreatedUTC ts, ChargeCodeDescription str, TicketCodeDescription str, PassengerID int,
        SegmentID int, InventoryLegID int, ChargeNumber int, ChargeType int, ChargeCode str,
        TicketCode str, ChargeAmount float, CurrencyCode str""",
    "journey_fees": """
        CreatedUTC ts, PassengerID int, SegmentID int, FeeNumber int, FeeCode str,
        FeeCodeDescription str, FeeDetail str, FeeType int, FeeOverride int, SSRCode str,
        SSRNumber int, InventoryLegID int, ArrivalStation str, DepartureStation str,
        ChargeNumber int, ChargeType int, ChargeDetail str, ChargeAmount float, CurrencyCode str""",
    "currency_conversion": "FromCurrencyCode str, ToCurrencyCode str, ConversionRate float",
}
# Columns the consumers of an extract expect although no source fills them.
CONSTANT_NULL = {
    "TreatmentProductInputParameterPivot": [
        "JourneyFareClassOfServiceList", "FareClassID", "ProbabilityMatch", "BookingWeekday",
        "output_label1ID", "BookingWeekdayID", "LabelMatch", "LineOfBusiness", "output_label1",
        "output_probability1", "output_probability2",
    ],
    "TreatmentDistinctRanked": [
        "ContryDestinationLocationCode", "ContryOriginLocationCode", "CustomDiscountCode",
        "AssignableSeatsCount", "CjDiscountCode", "WebSessionID", "JourneySoldLegByTravelClassList",
        "JourneyConnectingStationsList", "MMB", "ApplyCjDiscount", "ClientName",
        "SourceOrganizationCode",
    ],
}
# The derived columns of the enriched leg tables.
_STATUS_NAMES = "PassengerStatus str, FlightStatus str, InventoryStatus str"
_DECLARED["enriched_passenger_legs"] = (
    _DECLARED["passenger_legs"]
    + f", FlightCode str, Key str, JourneyKey str, FlightKey str, {_STATUS_NAMES}"
)
_DECLARED["enriched_inventory_legs"] = (
    _DECLARED["inventory_legs"] + f", FlightCode str, FlightKey str, {_STATUS_NAMES}"
)


def declared(table: str) -> list[tuple[str, str]]:
    """(column, type word) pairs in declared order."""
    return [tuple(part.split()) for part in _DECLARED[table].split(",")]


def struct_of(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[word]) for name, word in declared(table)])


def categorical_columns(table: str) -> list[str]:
    return [name for name, word in declared(table) if word == "cat"]


def unsigned_limits(table: str) -> dict[str, int]:
    """Largest allowed value of each unsigned column."""
    return {name: _UNSIGNED_MAX[word] for name, word in declared(table) if word in _UNSIGNED_MAX}
