"""Status names and ancillary code lists, as plain values and as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _numbered(prefix: str, last: int, first: int = 1) -> list[str]:
    return [f"{prefix}{number:02d}" for number in range(first, last + 1)]


# Status code names. Inventory status 4 has no name.
LIFT_STATUS = {0: "Pending", 1: "CheckedIn", 2: "Boarded", 3: "NoShow"}
DEPARTURE_STATUS = {
    0: "Default", 1: "Cancelled", 2: "Boarding", 3: "SeeAgent", 4: "Delayed", 5: "Departed",
}
INVENTORY_STATUS = {0: "Normal", 1: "Closed", 2: "Canceled", 3: "Suspended", 5: "ClosedPending"}
# Inventory status codes of flights that do not operate.
NOT_OPERATING = [2, 3]
# Tax line types.
TAX_TYPES = [3, 5]

# Ancillary class -> category -> codes. No code stands in two categories.
ANCILLARY_CODES = {
    "Bundles": {
        "STARTER": ["STRT"],
        "STARTER_PLUS": ["STPL"],
        "FLEX": ["FLEX", "FLXN"],
        "FLEX_PLUS": ["FPLS"],
        "MAX": ["MAX", "MAX2"],
        "BUSINESS": ["BIZZ", "BMAX", "BMXN", "BUS", "BMA"],
        "BUSINESS_PLUS": ["PLUS", "PLS"],
    },
    "Seats": {"STF": ["STF"]},
    "Bags": {
        "PRE_PAID_CHECK_IN": [
            "BF10", "BF15", "BF20", "BF23", "BF25", "BF30", "BF40", "BG05", "BG10", "BG15", "BG20",
            "BG23", "BG25", "BG30", "BG32", "BG35", "BG40", "BG45", "BG46", "BG60",
        ],
        "POST_PAID_CHECK_IN": [
            "XB05", "XB10", "XB15", "XB20", "XB25", "XB30", "XB35", "XB40", "XB50", "XB60", "XB70",
            "XB80",
        ],
        "PRE_PAID_CABIN": ["CB03", "CB07", "CB10", "CB14", "CB20"],
        "POST_PAID_CABIN": ["CBX3", "CBX7"],
        "COUNTER_CABIN": ["CBA3", "CBA7"],
        "GATE_CABIN": ["CBG3", "CBG7"],
        "EXCESS": ["EXB", "X05", "X10", "X20", "XBGT", "XBPU", "XBF", "XBU"],
        "PRE_PAID_OVERSIZED": ["OB01", "OB02"],
        "COUNTER_OVERSIZED": ["OBAP"],
    },
    "Meals": {
        "CHILDREN": ["CHMI", "CHML", "CHMV"],
        "STANDARD": [
            *_numbered("MA", 32), "MABF", "MF", *_numbered("MU", 4), *_numbered("MV", 32),
        ],
        "SERVICE": _numbered("ML", 2),
        "AU_DOMESTIC": ["MFAU", *_numbered("MFAU", 4)],
        "NZ_DOMESTIC": ["MFNZ", *_numbered("MFNZ", 4), *_numbered("MN", 32)],
        "MO": _numbered("MO", 32),
        "TRANS_TASMAN": ["MFTT", *_numbered("MFTT", 4), *_numbered("MT", 32)],
        "JETSTAR_JAPAN": _numbered("MJ", 32),
        "JESTAR_ASIA": _numbered("MS", 32),
    },
}
# The categories each revenue column adds up.
BUNDLE_REVENUE = ["STARTER_PLUS", "FLEX", "FLEX_PLUS", "BUSINESS", "BUSINESS_PLUS", "MAX"]
BAGGAGE_REVENUE = [
    "PRE_PAID_CHECK_IN", "PRE_PAID_CABIN", "PRE_PAID_OVERSIZED", "POST_PAID_CHECK_IN",
    "POST_PAID_CABIN", "COUNTER_OVERSIZED", "COUNTER_CABIN", "GATE_CABIN", "EXCESS",
]
SEAT_REVENUE = "STF"
BASE_FARE = "BaseFare"
NOT_HANDLED = "NotHandled"


def codes_of(ancillary_class: str) -> list[str]:
    return [code for codes in ANCILLARY_CODES[ancillary_class].values() for code in codes]


def categories() -> list[str]:
    """Every category an ancillary row can carry, in declared order."""
    listed = [c for by_category in ANCILLARY_CODES.values() for c in by_category]
    return [BASE_FARE, *listed, NOT_HANDLED]


def _table(spark: SparkSession, rows: list[tuple], *columns: str) -> DataFrame:
    """Few constant rows as an inline table, whose size the optimizer knows."""
    literals = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {literals} AS t({', '.join(columns)})")


def category_table(spark: SparkSession) -> DataFrame:
    """(AncilType, ContextDescription, ContextCode): one row per code, some 290 in all."""
    rows = [
        (ancillary_class, category, code)
        for ancillary_class, by_category in ANCILLARY_CODES.items()
        for category, codes in by_category.items()
        for code in codes
    ]
    return _table(spark, rows, "AncilType", "ContextDescription", "ContextCode")


def status_table(spark: SparkSession, names: dict[int, str], code: str, name: str) -> DataFrame:
    return _table(spark, list(names.items()), code, name)
