"""Profiles against brute force in plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tripmart.operators import profiles
from tripmart.plans.profiles import destination_profile

KNOWN = {1, 2, 3, 4}


@pytest.fixture(scope="module")
def pairs_seen():
    """1,500 trips; pickup 1 holds a third of them, pickup 6 is unknown to the lookup."""
    source = random.Random(3)
    rows = [(1, source.choice([1, 2, 5])) for _ in range(500)]
    rows += [(source.choice([2, 3, 4, 6]), source.randint(1, 6)) for _ in range(1000)]
    return rows


@pytest.fixture(scope="module")
def frames(spark, pairs_seen):
    trips = spark.createDataFrame(pairs_seen, "PULocationID bigint, DOLocationID bigint")
    zones = spark.createDataFrame([(z,) for z in KNOWN], "location_id int")
    return trips, zones


def test_pickup_shares(frames, pairs_seen):
    trips, zones = frames
    known = Counter(p for p, _ in pairs_seen if p in KNOWN)
    weights = profiles.known_zones(
        profiles.zone_weights(trips, "PULocationID"), zones, "location_id"
    )
    rows = profiles.normalise(weights).collect()
    total = sum(known.values())
    assert {r["location_id"]: (r["weight"], r["share"]) for r in rows} == {
        p: (n, round(n / total, 6)) for p, n in known.items()
    }


def test_destination_falls_back_to_global_shares(frames, pairs_seen):
    trips, zones = frames
    rows = destination_profile(trips, zones).collect()

    seen = Counter(pairs_seen)
    own_total, global_count = Counter(), Counter()
    for (pickup, dropoff), n in seen.items():
        if dropoff in KNOWN:
            global_count[dropoff] += n
            if pickup in KNOWN:
                own_total[pickup] += n
    expected = {}
    for (pickup, dropoff), n in seen.items():
        if pickup in own_total:
            share = n / own_total[pickup] if dropoff in KNOWN else 0.0
            expected[pickup, dropoff] = ("own", round(share, 6))
        else:
            share = global_count[dropoff] / sum(global_count.values())
            expected[pickup, dropoff] = ("global", round(share, 6))
    got = {(r["pickup_id"], r["dropoff_id"]): (r["profile"], r["share"]) for r in rows}
    assert got == expected
    assert {(r["pickup_id"], r["dropoff_id"]): r["weight"] for r in rows} == seen
    assert {profile for profile, _ in got.values()} == {"own", "global"}
