from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from rows import raw_trips, zone_lookup
from tripmart.operators import conform, dimensions, facts
from tripmart.operators.reports import payment_by_calendar, payment_mix


def silver(spark, *changes):
    return conform.silver_trips(raw_trips(spark, *changes), "yellow")


def star(spark, trips, **changes):
    dims = {
        "date": dimensions.dim_date(trips),
        "location": dimensions.dim_location(zone_lookup(spark)),
        "customer": dimensions.dim_customer(trips),
        "vendor": dimensions.dim_vendor(spark),
        "ratecode": dimensions.dim_ratecode(spark),
        "payment_type": dimensions.dim_payment_type(spark),
    }
    return facts.StarDims(**(dims | changes))


def test_dim_date_has_both_dates_once(spark):
    rows = dimensions.dim_date(silver(spark, {}, {})).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [
        (date(2025, 1, 31), 31, 1, 2025, 1, 6),
        (date(2025, 2, 1), 1, 2, 2025, 1, 7),
    ]


def test_customer_has_one_row_per_phone(spark):
    trips = silver(
        spark,
        {"full_name": "Bob"},
        {"full_name": "Ann"},
        {"full_name": None},
        {"phonenumber": None, "full_name": "Zoe"},
    )
    assert dimensions.customer_names(trips).count() == 4
    rows = {r["phonenumber"]: r["full_name"] for r in dimensions.dim_customer(trips).collect()}
    assert rows == {"100": "Ann", None: "Zoe"}


def test_customer_merge_keeps_known_names_and_absent_phones(spark):
    trips = silver(
        spark,
        {"phonenumber": "1", "full_name": "new"},
        {"phonenumber": "2", "full_name": "new"},
        {"phonenumber": "3", "full_name": "new"},
        {"phonenumber": None, "full_name": "new"},
    )
    known = spark.createDataFrame(
        [("1", "known"), ("2", None), ("9", "gone"), (None, "nobody")],
        "phonenumber string, full_name string",
    )
    merged = dimensions.dim_customer(trips, known)
    expected = [("1", "known"), ("2", "new"), ("3", "new"), ("9", "gone")]
    expected += [(None, "new"), (None, "nobody")]
    assert Counter(map(tuple, merged.collect())) == Counter(expected)
    again = dimensions.dim_customer(trips, merged)
    assert Counter(map(tuple, again.collect())) == Counter(expected)


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("join_dates", [True, False])
def test_unknown_ids_give_null_keys_and_keep_the_trip(spark, shuffled, join_dates):
    trips = silver(
        spark,
        {},
        {"VendorID": 9, "PULocationID": 999, "RatecodeID": 50.0, "payment_type": 77},
        {"VendorID": None, "DOLocationID": None, "RatecodeID": 1.5, "payment_type": None},
    )
    dims = star(spark, trips) if join_dates else star(spark, trips, date=None)
    rows = facts.fact_trips(trips, dims, 2025, 1, shuffled).collect()
    keys = Counter(
        (
            r["vendor_id"],
            r["pickup_location_id"],
            r["dropoff_location_id"],
            r["ratecode_id"],
            r["payment_type_id"],
            r["pickup_date"],
            r["dropoff_date"],
        )
        for r in rows
    )
    days = (date(2025, 1, 31), date(2025, 2, 1))
    assert keys == Counter(
        [
            (1, 1, 2, 1, 1, *days),
            (None, None, 2, None, None, *days),
            (None, 1, None, None, None, *days),
        ]
    )
    assert {(r["year"], r["month"]) for r in rows} == {(2025, 1)}


def test_date_missing_from_its_dimension_gives_a_null_key(spark):
    trips = silver(spark, {})
    dates = dimensions.dim_date(trips).filter("date < DATE'2025-02-01'")
    (row,) = facts.fact_trips(trips, star(spark, trips, date=dates), 2025, 1).collect()
    assert (row["pickup_date"], row["dropoff_date"]) == (date(2025, 1, 31), None)


def test_customer_names_never_multiply_trips(spark):
    trips = silver(spark, {"full_name": "Ann"}, {"full_name": "Bob"}, {"phonenumber": None})
    dims = star(spark, trips, customer=dimensions.customer_names(trips))
    assert facts.fact_trips(trips, dims, 2025, 1).count() == 3


def test_fact_plan_is_map_only(spark, tmp_path):
    silver(spark, {}).write.parquet(str(tmp_path / "silver"))
    trips = spark.read.parquet(str(tmp_path / "silver"))
    dims = star(spark, trips)
    dims.date.write.parquet(str(tmp_path / "date"))
    dims.customer.write.parquet(str(tmp_path / "customer"))
    dims.location.write.parquet(str(tmp_path / "location"))
    stored = star(
        spark,
        trips,
        date=spark.read.parquet(str(tmp_path / "date")),
        customer=spark.read.parquet(str(tmp_path / "customer")),
        location=spark.read.parquet(str(tmp_path / "location")),
    )
    plan = plan_of(facts.fact_trips(trips, stored, 2025, 1))
    assert "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan
    assert str(tmp_path / "customer") not in plan
    assert str(tmp_path / "date") in plan


def test_hot_location_gives_the_same_fact_without_broadcasts(spark):
    """A third of the trips start in one zone."""
    places = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).cast("int").alias("place")
    )
    trips = silver(spark, {}).drop("PULocationID").crossJoin(places)
    trips = trips.withColumnRenamed("place", "PULocationID")
    dims = star(spark, trips)

    def pickups():
        fact = facts.fact_trips(trips, dims, 2025, 1)
        return Counter(r["pickup_location_id"] for r in fact.select("pickup_location_id").collect())

    usual = pickups()
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        assert pickups() == usual
    finally:
        spark.conf.unset(key)
    assert sum(usual.values()) == 3000 and usual[1] >= 1000


def test_reports_join_no_unused_dimension(spark, tmp_path):
    silver(spark, {}).write.parquet(str(tmp_path / "silver"))
    trips = spark.read.parquet(str(tmp_path / "silver"))
    fact = facts.fact_trips(trips, star(spark, trips, date=None), 2025, 1)
    plan = plan_of(payment_mix(fact, dimensions.dim_payment_type(spark)))
    assert "vendor_id" not in plan and "rate" not in plan.replace("Generate", "")


def test_unmatched_keys_are_counted_per_dimension(spark):
    trips = silver(spark, {"VendorID": 3}, {"VendorID": 4, "PULocationID": 500})
    fact = facts.fact_trips(trips, star(spark, trips), 2025, 1)
    row = facts.unmatched_keys(fact).first().asDict()
    assert row["vendor_id"] == 2 and row["pickup_location_id"] == 1
    assert sum(row.values()) == 3


def test_payment_mix_counts_unknown_types(spark):
    trips = silver(spark, {}, {"payment_type": 2}, {"payment_type": 2}, {"payment_type": 77})
    fact = facts.fact_trips(trips, star(spark, trips), 2025, 1)
    rows = payment_mix(fact, dimensions.dim_payment_type(spark)).collect()
    shares = {r["payment_type_description"]: r["share"] for r in rows}
    assert shares == {"Credit card": 0.25, "Cash": 0.5, None: 0.25}


def test_reports_keep_trips_without_date_and_count_bad_fares(spark):
    fact = spark.createDataFrame(
        [
            (1, date(2025, 1, 1), 10.0),
            (1, None, 5.0),
            (1, None, float("nan")),
            (1, None, 1e17),
            (1, None, None),
        ],
        "payment_type_id long, pickup_date date, fare_amount double",
    )
    (mix,) = payment_mix(fact, dimensions.dim_payment_type(spark)).collect()
    assert (mix["trip_count"], mix["share"], mix["bad_fares"]) == (5, 1.0, 1)
    assert mix["fare_total"] == 1e17 + 15
    dates = spark.createDataFrame(
        [(date(2025, 1, 1), 1, 4)], "date date, month int, day_of_week int"
    )
    rows = payment_by_calendar(fact, dates).collect()
    assert {(r["pickup_month"], r["trip_count"], r["bad_fares"]) for r in rows} == {
        (1, 1, 0),
        (None, 4, 1),
    }


def test_times_are_dates_of_the_session_zone(spark):
    trips = silver(spark, {"pickup_datetime": datetime(2025, 1, 1, 0, 0)})
    (row,) = facts.fact_trips(trips, star(spark, trips), 2025, 1).collect()
    assert row["pickup_date"] == date(2025, 1, 1)
