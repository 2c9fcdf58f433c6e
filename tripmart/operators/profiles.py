"""Where trips start and end: shares per zone and per pickup -> dropoff pair.

All weights are aggregated before anything else happens to them, so every later
join and total works on rows per zone or per pair, not per trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_weights(trips: DataFrame, zone_column: str) -> DataFrame:
    """Trips per zone id."""
    zone = F.col(zone_column).alias("location_id")
    return trips.groupBy(zone).agg(F.count("*").alias("weight"))


def pair_weights(trips: DataFrame) -> DataFrame:
    """Trips per (pickup, dropoff) pair: the matrix in long form."""
    pair = [F.col("PULocationID").alias("pickup_id"), F.col("DOLocationID").alias("dropoff_id")]
    return trips.groupBy(*pair).agg(F.count("*").alias("weight"))


def zone_totals(pairs: DataFrame, id_column: str) -> DataFrame:
    """Weights per zone from pair weights, without another pass over the trips."""
    return pairs.groupBy(F.col(id_column).alias("location_id")).agg(
        F.sum("weight").alias("weight")
    )


def known_zones(weights: DataFrame, zones: DataFrame, *id_columns: str) -> DataFrame:
    """Keep rows whose ids are all in the zone lookup (``location_id``)."""
    for name in id_columns:
        valid = zones.select(F.col("location_id").alias(name))
        weights = weights.join(valid, name, "left_semi")
    return weights


def normalise(weights: DataFrame, weight: str = "weight") -> DataFrame:
    """Add ``share``: each weight over the total of all weights."""
    total = weights.agg(F.sum(weight)).scalar()
    return weights.withColumn("share", F.round(F.col(weight) / total, 6))


def normalise_rows(pairs: DataFrame, weight: str = "weight") -> DataFrame:
    """Add ``share``: each pair's weight over the total of its pickup."""
    totals = pairs.groupBy("pickup_id").agg(F.sum(weight).alias("pickup_total"))
    return (
        pairs.join(totals, "pickup_id")
        .withColumn("share", F.round(F.col(weight) / F.col("pickup_total"), 6))
        .drop("pickup_total")
    )


def destination_share(
    pairs: DataFrame, row_shares: DataFrame, global_shares: DataFrame
) -> DataFrame:
    """Share of each pair's destination in the profile that applies to its pickup.

    A pickup with a row of its own in ``row_shares`` uses that row, any other one
    uses ``global_shares``. A destination the profile lacks has share 0. The choice
    is made per given pair, so no pickup is ever multiplied by all destinations.
    """
    own_rows = row_shares.select("pickup_id").distinct().withColumn("own", F.lit(True))
    own = row_shares.select("pickup_id", "dropoff_id", F.col("share").alias("own_share"))
    other = global_shares.select(
        F.col("location_id").alias("dropoff_id"), F.col("share").alias("global_share")
    )
    has_row = F.coalesce("own", F.lit(False))
    share = F.when(has_row, F.col("own_share")).otherwise(F.col("global_share"))
    return (
        pairs.join(own_rows, "pickup_id", "left")
        .join(own, ["pickup_id", "dropoff_id"], "left")
        .join(other, "dropoff_id", "left")
        .select(
            "pickup_id",
            "dropoff_id",
            "weight",
            F.when(has_row, "own").otherwise("global").alias("profile"),
            F.coalesce(share, F.lit(0.0)).alias("share"),
        )
    )
