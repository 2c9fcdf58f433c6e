from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from rows import raw_trips
from tripmart.functions import bounded_distance, money_sum, next_weekday, whole_number
from tripmart.operators import conform, messages
from tripmart.schemas import EVENT_TYPES


def test_next_weekday_matches_python(spark):
    days = [date(2024, 2, 20) + timedelta(days=i) for i in range(15)]
    frame = spark.createDataFrame([(d, k) for d in days for k in range(7)], "d date, k int")
    for row in frame.withColumn("next", next_weekday(F.col("d"), F.col("k"))).collect():
        ahead = (row["k"] - row["d"].weekday()) % 7
        assert row["next"] == row["d"] + timedelta(days=ahead)
    assert frame.select(next_weekday(F.col("d"), 2)).distinct().count() == 3


def test_distance_is_bounded_and_rounded(spark):
    frame = spark.createDataFrame([(-3.0,), (0.1,), (2.345678,), (900.0,)], "x double")
    values = [r[0] for r in frame.select(bounded_distance(F.col("x"))).collect()]
    assert values == [0.1, 0.1, 2.35, 50.0]


def test_text_becomes_a_whole_number(spark):
    texts = {"7": 7, " 7 ": 7, "2.0": 2, "5.": 5, "-3.9": -3, "+4": 4, "abc": None, "1.x": None}
    texts |= {"": None, "1e3": None, "9" * 30: None, None: None}
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.withColumn("n", whole_number(F.col("t"), "bigint")).collect()
    assert {r["t"]: r["n"] for r in rows} == texts


def test_money_does_not_depend_on_order(spark):
    frame = spark.createDataFrame([(0.1,)] * 10 + [(1e9,), (-1e9,)], "x double")
    assert frame.agg(money_sum(F.col("x"))).first()[0] == 1.0


def test_message_round_trip(spark):
    trips = conform.silver_trips(raw_trips(spark, {"trip_distance": 77.123}), "yellow")
    encoded = messages.encode_events(trips)
    payload = json.loads(encoded.first()["value"])
    assert payload == {
        "VendorID": "1",
        "tpep_pickup_datetime": "2025-01-31 23:50:00",
        "passenger_count": "1",
        "trip_distance": 50.0,
        "RatecodeID": "1",
        "store_and_fwd_flag": "N",
        "PULocationID": "1",
        "DOLocationID": "2",
        "phonenumber": "100",
    }
    binary = encoded.select(F.col("value").cast("binary").alias("value"))
    decoded = messages.decode_events(binary)
    assert dict(decoded.dtypes) == EVENT_TYPES
    assert decoded.first()["tpep_pickup_datetime"] == datetime(2025, 1, 31, 23, 50)


def test_bad_messages_give_null_fields(spark):
    frame = spark.createDataFrame(
        [
            (1, "not json"),
            (2, None),
            (3, '{"tpep_pickup_datetime": "never", "PULocationID": "7"}'),
            (4, '{"tpep_pickup_datetime": "2025-01-01 10:00:00", "PULocationID": 7}'),
            (5, '{"tpep_pickup_datetime": "2025-01-01 10:00:00", "PULocationID": "x"}'),
        ],
        "n int, value string",
    )
    rows = messages.decode_json(
        frame, "value", "tpep_pickup_datetime timestamp, PULocationID string", "n"
    )
    ten = datetime(2025, 1, 1, 10)
    assert {tuple(r) for r in rows.collect()} == {
        (1, None, None),
        (2, None, None),
        (3, None, "7"),
        (4, ten, "7"),
        (5, ten, "x"),
    }
    zones = [r["PULocationID"] for r in messages.pickups(frame.orderBy("n")).collect()]
    assert zones == [None, None, 7, 7, None]


def test_distance_that_is_none_stays_none(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert [r[0] for r in frame.select(bounded_distance(F.col("x"))).collect()] == [None, None]
