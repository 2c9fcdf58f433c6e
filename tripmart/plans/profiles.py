"""Job: destination profile of every observed pickup -> dropoff pair."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.operators import profiles


def destination_profile(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Each pair's share in its pickup's own profile or, lacking one, in the global one.

    Profiles hold known zones only. The pairs enter the result in four places, which share
    one exchange.
    """
    pairs = profiles.pair_weights(trips)
    own = profiles.normalise_rows(profiles.known_zones(pairs, zones, "pickup_id", "dropoff_id"))
    dropoffs = profiles.zone_totals(pairs, "dropoff_id")
    everywhere = profiles.normalise(profiles.known_zones(dropoffs, zones, "location_id"))
    return profiles.destination_share(pairs, own, everywhere)
