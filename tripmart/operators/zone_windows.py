"""Trips per zone over sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import SLIDE_MINUTES, WINDOW_MINUTES

EVENT_TIME = "tpep_pickup_datetime"


def zone_names(zone_lookup: DataFrame) -> DataFrame:
    """Zone id and name, as the window counts need them."""
    return zone_lookup.select(F.col("LocationID").alias("zone_id"), F.col("Zone").alias("zone"))


def zone_enrich(
    events: DataFrame,
    zones: DataFrame,
    *keep: str,
    shuffled: bool = False,
) -> DataFrame:
    """Add the zone name of ``PULocationID``; events of unknown zones are dropped.

    ``zones`` must be a batch frame; ``events`` may be a stream. Spark broadcasts zones by
    its size estimate; ``shuffled`` asks for a shuffled join instead, whose hot zones
    adaptive execution splits.
    """
    lookup = zones.hint("merge") if shuffled else zones
    named = events.join(lookup, F.col("PULocationID") == F.col("zone_id"), "left")
    return named.filter(F.col("zone").isNotNull()).select(*keep, "zone")


def zone_counts(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per zone in every 15-minute window, one window every 5 minutes.

    Streams and batches give the same counts, but for events that a stream drops as too
    late; each takes a plan that it can run.
    """
    return sliding_counts(events, zones) if events.isStreaming else bucket_counts(events, zones)


def sliding_counts(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Every event enters all its windows in one aggregation.

    This is the plan of a stream, which may hold one stateful step in update mode.
    """
    sliding = F.window(EVENT_TIME, f"{WINDOW_MINUTES} minutes", f"{SLIDE_MINUTES} minutes")
    counted = zone_enrich(events, zones, EVENT_TIME).groupBy(sliding, "zone").count()
    return counted.selectExpr(
        "window.start AS window_start", "window.end AS window_end", "zone", "count AS trip_count"
    )


def bucket_counts(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Every event is counted once, in its slide-long bucket of its zone id.

    Map-side combining absorbs busy zones. Only the bucket counts meet the zone names
    and are copied into the windows that cover their bucket, which needs a window to
    be a whole number of slides.
    """
    bucket_start = F.window(EVENT_TIME, f"{SLIDE_MINUTES} minutes")["start"]
    per_bucket = (
        events.select(bucket_start.alias("bucket_start"), "PULocationID")
        .groupBy("bucket_start", "PULocationID")
        .agg(F.count("*").alias("events"))
    )
    named = zone_enrich(per_bucket, zones, "bucket_start", "events")
    starts = F.expr(
        f"sequence(bucket_start - INTERVAL {WINDOW_MINUTES - SLIDE_MINUTES} MINUTES, "
        f"bucket_start, INTERVAL {SLIDE_MINUTES} MINUTES)"
    )
    return (
        named.select(F.explode(starts).alias("window_start"), "zone", "events")
        .groupBy("window_start", "zone")
        .agg(F.sum("events").alias("trip_count"))
        .selectExpr(
            "window_start",
            f"window_start + INTERVAL {WINDOW_MINUTES} MINUTES AS window_end",
            "zone",
            "trip_count",
        )
    )
