"""Trip fact: silver trips with their dimension keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import FACT_ATTRIBUTES, FACT_KEYS, FACT_MEASURES, FACT_PARTITIONS


@dataclass(frozen=True)
class StarDims:
    """Dimension frames; Spark knows the size of stored ones.

    ``date`` may be None when the date dimension is derived from the same trips: it
    then has every date, and the fact takes the dates without a join.
    """

    date: DataFrame | None
    location: DataFrame
    customer: DataFrame
    vendor: DataFrame
    ratecode: DataFrame
    payment_type: DataFrame


def fact_trips(
    trips: DataFrame,
    dims: StarDims,
    year: int,
    month: int,
    shuffled: bool = False,
) -> DataFrame:
    """Left star join; an id missing from its dimension gives a NULL key, the row stays.

    Only the key of each dimension is joined, so no dimension text travels. Literal
    dimensions are broadcast, their rows being written in this package, and so are
    dates, a calendar's days: Spark's estimate of dates that are yet to be derived from
    trips is that of the trips. Locations go by Spark's size estimate: with stored ones
    the star is one map-only stage. ``shuffled`` asks for shuffled joins of dates and
    locations, each of which moves all trips; adaptive execution splits their hot keys.
    """

    def location(role: str) -> DataFrame:
        ids = dims.location.select(F.col("location_id").alias(role))
        return ids.hint("merge") if shuffled else ids

    def days(role: str) -> DataFrame:
        dates = dims.date.select(F.col("date").alias(role))
        return dates.hint("merge") if shuffled else F.broadcast(dates)

    # Distinct keys let the optimizer drop the join where the key is not used; one
    # partition, so that this takes no exchange.
    vendor = dims.vendor.coalesce(1).select("vendor_id").distinct()
    rate = F.col("ratecode_id").cast("double").alias("rate")
    ratecode = dims.ratecode.coalesce(1).groupBy(rate).agg(
        F.min("ratecode_id").alias("ratecode_id")
    )
    payment = dims.payment_type.coalesce(1).select("payment_type_id").distinct()

    # lookup, value in the trip, column of the lookup it must equal
    roles = [
        (location("pickup_location_id"), F.col("PULocationID"), "pickup_location_id"),
        (location("dropoff_location_id"), F.col("DOLocationID"), "dropoff_location_id"),
        (F.broadcast(vendor), F.col("VendorID"), "vendor_id"),
        (F.broadcast(ratecode), F.col("RatecodeID"), "rate"),
        (F.broadcast(payment), F.col("payment_type"), "payment_type_id"),
    ]
    dates = {
        "pickup_date": F.to_date("pickup_datetime"),
        "dropoff_date": F.to_date("dropoff_datetime"),
    }
    keyed = trips
    if dims.date is None:
        keyed = keyed.withColumns(dates)
    else:
        roles += [(days(role), day, role) for role, day in dates.items()]
    for lookup, value, lookup_key in roles:
        keyed = keyed.join(lookup, value == F.col(lookup_key), "left")

    # One row per phone: the join keeps every trip once, and the optimizer, seeing
    # that, drops it with the customer scan and its shuffle.
    phones = dims.customer.select("phonenumber").distinct()
    keyed = keyed.join(phones, "phonenumber", "left")

    return keyed.withColumns({"year": F.lit(year), "month": F.lit(month)}).select(
        *FACT_KEYS, *FACT_MEASURES, *FACT_ATTRIBUTES, *FACT_PARTITIONS
    )


def unmatched_keys(fact: DataFrame) -> DataFrame:
    """How many trips have no row in each dimension."""
    looked_up = [name for name in FACT_KEYS if name != "phonenumber"]
    return fact.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in looked_up])
