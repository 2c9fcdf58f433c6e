"""The six dimensions of the star schema."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import PAYMENT_TYPES, RATECODES, VENDORS


def dim_date(trips: DataFrame) -> DataFrame:
    """Every date on which a trip starts or ends, with its calendar parts.

    This is UNION of the two date columns, read in one pass: both dates of a row
    are exploded and the distinct combines on the map side.
    """
    both = F.array(F.to_date("pickup_datetime"), F.to_date("dropoff_datetime"))
    return trips.select(F.explode(both).alias("date")).distinct().select("date", *_calendar())


def _calendar() -> list[Column]:
    date = F.col("date")
    return [
        F.dayofmonth(date).alias("day"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.dayofweek(date).alias("day_of_week"),
    ]


def dim_location(zone_lookup: DataFrame) -> DataFrame:
    """Zone lookup under the names of the star schema."""
    return zone_lookup.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def literal_dim(
    spark: SparkSession, rows: tuple[tuple[int, str], ...], id_name: str, text_name: str
) -> DataFrame:
    """Literal relation. An Arrow table becomes a local relation, whose size Spark knows."""
    ids, texts = zip(*rows)
    return spark.createDataFrame(
        pa.table({id_name: pa.array(ids, pa.int64()), text_name: pa.array(texts, pa.string())})
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, VENDORS, "vendor_id", "vendor_name")


def dim_ratecode(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, RATECODES, "ratecode_id", "ratecode_description")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, PAYMENT_TYPES, "payment_type_id", "payment_type_description")


def customer_names(trips: DataFrame) -> DataFrame:
    """Distinct (phone, name) pairs; a phone seen under two names has two rows."""
    return trips.select("phonenumber", "full_name").distinct()


def dim_customer(trips: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per phone; the name in ``existing`` wins, and its phones all stay.

    Trips without a phone are no one customer: each of their names keeps a row with a
    NULL phone. With ``existing`` this is a full outer merge on the phone, written as one
    aggregation over both inputs: a phone with very many trips shrinks to its distinct
    names before the shuffle on the phone, since ``min`` over text would have to sort
    the raw trips.
    """
    no_name = F.lit(None).cast("string")
    names = customer_names(trips).select(
        "phonenumber", no_name.alias("known_name"), F.col("full_name").alias("seen_name")
    )
    if existing is not None:
        known = existing.select(
            "phonenumber", F.col("full_name").alias("known_name"), no_name.alias("seen_name")
        )
        names = names.unionByName(known)
    nameless_phone = F.when(
        F.col("phonenumber").isNull(), F.coalesce("known_name", "seen_name")
    ).alias("own_name")
    merged = names.groupBy("phonenumber", nameless_phone).agg(
        F.min("known_name").alias("known_name"), F.min("seen_name").alias("seen_name")
    )
    return merged.select("phonenumber", F.coalesce("known_name", "seen_name").alias("full_name"))
