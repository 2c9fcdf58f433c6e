from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from plan_text import plan_of
from rows import raw_trips
from tripmart.operators import conform
from tripmart.plans.silver import build_silver
from tripmart.schemas import SILVER_TYPES
from tripmart.sources.paths import LakePaths


@pytest.mark.parametrize("prefix", ["tpep_", "lpep_", ""])
def test_time_names_of_all_services_become_one(spark, prefix):
    conformed = conform.conform(raw_trips(spark, {}, prefix=prefix))
    assert conformed.columns == list(SILVER_TYPES)
    types = dict(conformed.dtypes)
    assert {n: t for n, t in SILVER_TYPES.items() if t} == {
        n: types[n] for n, t in SILVER_TYPES.items() if t
    }


def test_invalid_trips_are_dropped(spark):
    bad = [
        {"trip_distance": 0.0},
        {"trip_distance": -1.0},
        {"trip_distance": None},
        {"trip_distance": float("nan")},
        {"passenger_count": 0.0},
        {"passenger_count": 0.5},
        {"passenger_count": None},
        {"passenger_count": float("nan")},
        {"pickup_datetime": None},
        {"dropoff_datetime": None},
    ]
    good = [{"passenger_count": 1.5}, {"trip_distance": 0.01}]
    silver = conform.silver_trips(raw_trips(spark, *bad, *good), "yellow")
    assert sorted(r["passenger_count"] for r in silver.collect()) == [1, 1]


def test_values_that_do_not_fit_become_null(spark):
    raw = raw_trips(
        spark,
        {"PULocationID": "abc", "passenger_count": "2", "payment_type": "x"},
        PULocationID="string",
        passenger_count="string",
        payment_type="string",
    )
    (row,) = conform.silver_trips(raw, "green").collect()
    assert (row["PULocationID"], row["passenger_count"], row["payment_type"]) == (None, 2, None)


def test_drop_incomplete_treats_nan_as_missing(spark):
    trips = raw_trips(spark, {"extra": None}, {"extra": float("nan")}, {"extra": 0.0})
    assert conform.drop_incomplete(trips, ["extra"]).count() == 1


def test_union_keeps_duplicates_and_tags_services(spark):
    frames = {
        "yellow": raw_trips(spark, {}, {}),
        "green": raw_trips(spark, {}, prefix="lpep_"),
    }
    counts = conform.union_services(frames).groupBy("service_type").count().collect()
    assert {r["service_type"]: r["count"] for r in counts} == {"yellow": 2, "green": 1}


def test_missing_column_is_an_error(spark):
    with pytest.raises(AnalysisException):
        conform.conform(raw_trips(spark, {}).drop("extra"))


def test_silver_scan_filters_early_and_never_shuffles(spark, tmp_path):
    raw_trips(spark, {}, {"trip_distance": 0.0}).write.parquet(str(tmp_path / "t"))
    silver = conform.silver_trips(spark.read.parquet(str(tmp_path / "t")), "yellow")
    plan = plan_of(silver)
    assert "Exchange" not in plan
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "GreaterThanOrEqual(passenger_count,1.0)" in plan
    assert silver.count() == 1


def write_bronze(spark, paths, service, year, month, *changes, padded=False):
    prefix = {"yellow": "tpep_", "green": "lpep_"}[service]
    target = paths.bronze_files(service, year, month)[1 if padded else 0]
    raw_trips(spark, *changes, prefix=prefix).write.mode("overwrite").parquet(target)


def test_build_silver_reports_a_missing_service(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_bronze(spark, paths, "yellow", 2025, 1, {}, {"trip_distance": 0.0})
    result = build_silver(spark, paths, 2025, 1)
    assert (result.services, result.missing) == (("yellow",), ("green",))
    assert spark.read.parquet(paths.silver(2025, 1)).count() == 1


def test_build_silver_again_gives_the_same_rows(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_bronze(spark, paths, "yellow", 2025, 1, {})
    write_bronze(spark, paths, "green", 2025, 1, {}, padded=True)
    for _ in range(2):
        result = build_silver(spark, paths, 2025, 1)
        assert not result.missing
        assert spark.read.parquet(paths.silver(2025, 1)).count() == 2


def test_build_silver_without_any_file_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        build_silver(spark, LakePaths(str(tmp_path)), 2025, 1)


def test_build_silver_does_not_hide_a_broken_service(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_bronze(spark, paths, "yellow", 2025, 1, {})
    raw_trips(spark, {}, prefix="lpep_").drop("extra").write.parquet(
        paths.bronze_files("green", 2025, 1)[0]
    )
    with pytest.raises(AnalysisException):
        build_silver(spark, paths, 2025, 1)
