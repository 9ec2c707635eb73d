"""Charges and fees in one currency, categorised, listed per leg and pivoted to daily revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import codes
from fareline.functions.nulls import row_sum, sum_or_zero
from fareline.functions.ordered import digest_in_order, number_rows
from fareline.session import broadcast_if_small, pin

LEG = ["PassengerID", "SegmentID", "InventoryLegID"]
ITEM = [*LEG, "ContextCode", "ChargeAmount", "SOURCE"]
# Smallest amounts (exclusive) that count per ancillary class.
MINIMUM = {"Bags": 0.50, "Seats": 0.01, "Meals": 0.01}


def latest_rates(
    history: DataFrame, to_currency: str = "AUD", one_per_pair: bool = False,
    source: str = "FromCurrencyCode", target: str = "ToCurrencyCode", rate: str = "ConversionRate",
    created: str = "CreatedDate",
) -> DataFrame:
    """The newest rate of each currency pair.

    Several rates of the newest date all stay, unless `one_per_pair` takes the highest of them. The
    newest date is a partial aggregate, so a pair with a long history never fills one task.
    """
    pairs = history.where(F.col(target) == to_currency)
    if one_per_pair:
        newest = F.max(F.struct(created, rate))[rate]
        return pairs.groupBy(source, target).agg(newest.alias(rate))
    newest = pairs.groupBy(source, target).agg(F.max(created).alias(created))
    kept = pairs.join(broadcast_if_small(newest), [source, target, created], "left_semi")
    return kept.select(source, target, rate)


def to_one_currency(
    lines: DataFrame, rates: DataFrame, amount: str = "ChargeAmount", currency: str = "CurrencyCode"
) -> DataFrame:
    """Multiply amounts by their currency's rate (null without one) and drop the currency.

    One currency may hold most lines: the rate table, a row or few per currency, goes to the lines.
    """
    rate = rates.select(
        F.col("FromCurrencyCode").alias(currency), F.col("ConversionRate").alias("__rate")
    )
    return (
        lines.join(broadcast_if_small(rate), currency, "left")
        .withColumn(amount, F.col(amount) * F.col("__rate"))
        .drop("__rate", currency)
    )


def with_category(items: DataFrame, ancillary_class: str) -> DataFrame:
    """Add ContextDescription: the category of ContextCode within a class, else NotHandled."""
    table = codes.category_table(items.sparkSession)
    table = table.where(F.col("AncilType") == ancillary_class).drop("AncilType")
    joined = items.join(F.broadcast(table), "ContextCode", "left")
    return joined.withColumn(
        "ContextDescription", F.coalesce("ContextDescription", F.lit(codes.NOT_HANDLED))
    )


def charge_items(charges: DataFrame, ancillary_class: str) -> DataFrame:
    """Journey charges of a class, in the common shape."""
    return charges.where(F.col("ChargeCode").isin(codes.codes_of(ancillary_class))).select(
        *LEG, F.col("ChargeCode").alias("ContextCode"), F.col("ChargeType").alias("ContextType"),
        "ChargeAmount", F.lit("Charges").alias("SOURCE"),
    )


def fee_items(fees: DataFrame, ancillary_class: str) -> DataFrame:
    """Fees of a class without tax lines, summed per leg, fee code and fee type.

    Tax is told by FeeType for bundles and by ChargeType for all else.
    """
    tax_column = "FeeType" if ancillary_class == "Bundles" else "ChargeType"
    wanted = fees.where(
        F.col("FeeCode").isin(codes.codes_of(ancillary_class))
        & ~F.col(tax_column).isin(codes.TAX_TYPES)
    )
    return (
        wanted.groupBy(*LEG, "FeeCode", "FeeType")
        .agg(sum_or_zero("ChargeAmount").alias("ChargeAmount"))
        .select(
            *LEG, F.col("FeeCode").alias("ContextCode"), F.col("FeeType").alias("ContextType"),
            "ChargeAmount", F.lit("Fees").alias("SOURCE"),
        )
    )


def above_minimum(items: DataFrame, ancillary_class: str) -> DataFrame:
    """Leave out amounts too small to count (and missing ones), where the class has a minimum."""
    if ancillary_class not in MINIMUM:
        return items
    return items.where(F.col("ChargeAmount") > MINIMUM[ancillary_class])


def base_fare_items(charges: DataFrame) -> DataFrame:
    """Charges of type 0, the base fare, in the common shape with category and class."""
    return charges.where(F.col("ChargeType") == 0).select(
        *LEG, F.col("ChargeCode").alias("ContextCode"), "ChargeAmount",
        F.lit("Charges").alias("SOURCE"),
        F.lit(codes.BASE_FARE).alias("ContextDescription"),
        F.lit(codes.BASE_FARE).alias("AncilType"),
    )


def class_items(charges: DataFrame, fees: DataFrame, ancillary_class: str) -> DataFrame:
    """All counted items of one class with category and class; bundles and bags also from charges."""
    items = fee_items(fees, ancillary_class)
    if ancillary_class in ("Bundles", "Bags"):
        items = items.unionByName(charge_items(charges, ancillary_class))
    counted = above_minimum(items, ancillary_class).select(*ITEM)
    return with_category(counted, ancillary_class).withColumn("AncilType", F.lit(ancillary_class))


def all_items(charges: DataFrame, fees: DataFrame) -> DataFrame:
    """Items of the four classes and the base fare, one row per item.

    Same rows as `class_items` of each class and `base_fare_items` together, but charges and fees are
    each read once: a code belongs to one class, and the class decides which tests apply. A charge can
    be an item of its class and of the base fare.
    """
    known = F.broadcast(codes.category_table(charges.sparkSession))
    tax = F.when(F.col("AncilType") == "Bundles", F.col("FeeType")).otherwise(F.col("ChargeType"))
    group = [*LEG, "ContextCode", "FeeType", "ContextDescription", "AncilType"]
    from_fees = (
        fees.withColumnRenamed("FeeCode", "ContextCode")
        .join(known, "ContextCode", "inner")
        .where(~tax.isin(codes.TAX_TYPES))
        .groupBy(*group)
        .agg(sum_or_zero("ChargeAmount").alias("ChargeAmount"))
        .select(*ITEM[:-1], F.lit("Fees").alias("SOURCE"), "ContextDescription", "AncilType")
    )
    charged = known.where(F.col("AncilType").isin("Bundles", "Bags"))
    base_fare = F.lit(codes.BASE_FARE)
    roles = F.array(
        F.struct(F.col("ContextDescription").alias("d"), F.col("AncilType").alias("a")),
        F.when(F.col("ChargeType") == 0, F.struct(base_fare.alias("d"), base_fare.alias("a"))),
    )
    from_charges = (
        charges.withColumnRenamed("ChargeCode", "ContextCode")
        .join(charged, "ContextCode", "left")
        .select(*ITEM[:-1], F.lit("Charges").alias("SOURCE"), F.inline(roles))
        .where(F.col("a").isNotNull())
        .withColumnsRenamed({"d": "ContextDescription", "a": "AncilType"})
    )
    least = F.lit(None)
    for ancillary_class, amount in MINIMUM.items():
        least = F.when(F.col("AncilType") == ancillary_class, amount).otherwise(least)
    return from_fees.unionByName(from_charges).where(
        ~F.col("AncilType").isin(list(MINIMUM)) | (F.col("ChargeAmount") > least)
    )


_LISTED = ["ContextCode", "ContextDescription", "ChargeAmount", "SOURCE"]


def leg_totals(items: DataFrame) -> DataFrame:
    """Number and sum of the items of each leg and class: partial sums, whatever the size of a leg."""
    return items.groupBy(*LEG, "AncilType").agg(
        F.count("*").alias("items"), sum_or_zero("ChargeAmount").alias("TotalCharge")
    )


def item_positions(items: DataFrame, **limits) -> DataFrame:
    """The items as rows with their `position` (1, 2, ..) inside their leg and class."""
    return number_rows(items, [*LEG, "AncilType"], _LISTED, "position", **limits)


def leg_digests(items: DataFrame, text: Column) -> DataFrame:
    """`leg_totals` with the MD5 of the leg's item texts, in the order of `item_positions`, joined by "|"."""
    items = pin(items)
    group = [*LEG, "AncilType"]
    digests = digest_in_order(items, group, _LISTED, text, pinned=True).withColumnsRenamed({c: f"__{c}" for c in group})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group]
    return leg_totals(items).join(digests, same).drop("n", *[f"__{c}" for c in group])


def leg_aggregate(items: DataFrame) -> DataFrame:
    """Per leg and class, one row whatever its size: the items as an array of structs (so their fields stay
    aligned) and their sum.

    The list is the last step, for readers that want it in a row; `leg_totals` and `item_positions`
    give the same without one.
    """
    return items.groupBy(*LEG, "AncilType").agg(
        F.array_sort(F.collect_list(F.struct(*_LISTED))).alias("items"),
        sum_or_zero("ChargeAmount").alias("TotalCharge"),
    )


def unite(*aggregates: DataFrame) -> DataFrame:
    out = aggregates[0]
    for aggregate in aggregates[1:]:
        out = out.unionByName(aggregate)
    return out


def listed_columns(aggregate: DataFrame) -> DataFrame:
    """The array of structs as one parallel array per field."""
    arrays = {c: F.col("items")[c] for c in _LISTED}
    return aggregate.withColumns(arrays).drop("items")


def explode_lists(listed: DataFrame, columns: Sequence[str] = tuple(_LISTED)) -> DataFrame:
    """Parallel arrays back to one row per element."""
    kept = [c for c in listed.columns if c not in columns]
    return listed.select(*kept, F.inline(F.arrays_zip(*columns)))


def with_booking_date(items: DataFrame, bookings: DataFrame, dedupe_bookings: bool = False) -> DataFrame:
    """Attach booking dates by passenger: n booking rows give each item n times, or once per date
    with `dedupe_bookings`."""
    dates = bookings.select("PassengerID", "CreatedUTC")
    if dedupe_bookings:
        dates = dates.distinct()
    return items.join(dates, "PassengerID", "inner")


def daily_category_sums(items: DataFrame, bookings: DataFrame, dedupe_bookings: bool = False) -> DataFrame:
    """(CreatedUTC, ContextDescription, amount), as attaching dates to all items and summing would give.

    Both sides shrink before they meet: items to a sum per passenger and category, bookings to a count
    per passenger and date. The join then holds few rows per passenger, however many items or booking
    rows one has.
    """
    sums = items.groupBy("PassengerID", "ContextDescription").agg(
        sum_or_zero("ChargeAmount").alias("amount")
    )
    dates = bookings.groupBy("PassengerID", "CreatedUTC").agg(F.count("*").alias("times"))
    times = F.lit(1) if dedupe_bookings else F.col("times")
    return (
        sums.join(dates, "PassengerID", "inner")
        .groupBy("CreatedUTC", "ContextDescription")
        .agg(F.sum(F.col("amount") * times).alias("amount"))
    )


def pivot_categories(daily: DataFrame, amount: str = "amount") -> DataFrame:
    """Dates by categories. The category list is fixed, so absent ones come out null."""
    return (
        daily.groupBy("CreatedUTC")
        .pivot("ContextDescription", codes.categories())
        .agg(sum_or_zero(amount))
    )


def revenue_columns(pivoted: DataFrame) -> DataFrame:
    """The daily revenue table: base fare, categories and their totals, by date."""
    cents = lambda c: F.round(c, 2)
    totals = pivoted.withColumns(
        {
            "BundleRevenue": cents(row_sum(*codes.BUNDLE_REVENUE)),
            "BaggageRevenue": cents(row_sum(*codes.BAGGAGE_REVENUE)),
            "SeatRevenue": cents(F.col(codes.SEAT_REVENUE)),
        }
    )
    parts = ["BundleRevenue", "BaggageRevenue", "SeatRevenue"]
    return (
        totals.select(
            "CreatedUTC", codes.BASE_FARE, *codes.BUNDLE_REVENUE, "BundleRevenue",
            *codes.BAGGAGE_REVENUE, "BaggageRevenue", "SeatRevenue",
        )
        .withColumns(
            {
                "AncilRevenue": cents(row_sum(*parts)),
                "TotalRevenue": cents(row_sum(*parts, codes.BASE_FARE)),
            }
        )
        .orderBy("CreatedUTC")
    )
