"""Trip events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import bounded_distance, event_time_text, id_text, whole_number
from tripmart.schemas import EVENT_TYPES


def encode_events(trips: DataFrame) -> DataFrame:
    """One JSON ``value`` per silver trip: ids as text, times formatted."""
    payload = F.struct(
        id_text(F.col("VendorID")).alias("VendorID"),
        event_time_text(F.col("pickup_datetime")).alias("tpep_pickup_datetime"),
        id_text(F.col("passenger_count")).alias("passenger_count"),
        bounded_distance(F.col("trip_distance")).alias("trip_distance"),
        id_text(F.col("RatecodeID")).alias("RatecodeID"),
        F.col("store_and_fwd_flag"),
        id_text(F.col("PULocationID")).alias("PULocationID"),
        id_text(F.col("DOLocationID")).alias("DOLocationID"),
        F.col("phonenumber"),
    )
    return trips.select(F.to_json(payload).alias("value"))


def decode_json(messages: DataFrame, body: str, ddl: str, *keep: str) -> DataFrame:
    """Fields of the JSON in ``body``; text that is not JSON gives NULL fields.

    The parsed struct goes through a one-element ``explode``: filters on its fields
    then stay above the parse, where otherwise each would parse the text once more.
    """
    parsed = F.array(F.from_json(F.col(body).cast("string"), ddl))
    return messages.select(*keep, F.explode(parsed).alias("d")).select(*keep, "d.*")


def decode_events(messages: DataFrame, *fields: str) -> DataFrame:
    """Fields of each trip event message, all or only those named; others are not parsed."""
    ddl = ", ".join(f"{name} {EVENT_TYPES[name]}" for name in fields or EVENT_TYPES)
    return decode_json(messages, "value", ddl)


def pickups(messages: DataFrame) -> DataFrame:
    """Pickup time and zone id of each trip event message."""
    return decode_events(messages, "tpep_pickup_datetime", "PULocationID").withColumn(
        "PULocationID", whole_number(F.col("PULocationID"), "int")
    )
