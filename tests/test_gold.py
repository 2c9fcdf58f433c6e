from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest

from plan_text import plan_of
from rows import TRIP, raw_trips, zone_lookup
from tripmart.plans import reports
from tripmart.plans.gold import build_gold
from tripmart.plans.month import build_month
from tripmart.plans.silver import build_silver
from tripmart.sources.files import read_silver
from tripmart.sources.paths import LakePaths
from tripmart.sources.versions import (
    MARKER,
    committed_versions,
    read_current,
    replace_table,
    settle_table,
    write_next,
)


def land_month(spark, paths, year, month, *changes):
    times = {
        "pickup_datetime": datetime(year, month, 3, 10),
        "dropoff_datetime": datetime(year, month, 3, 11),
    }
    raw = raw_trips(spark, *[times | change for change in changes])
    raw.write.mode("overwrite").parquet(paths.bronze_files("yellow", year, month)[0])


def run_month(spark, paths, year, month, **options):
    build_silver(spark, paths, year, month)
    build_gold(spark, paths, year, month, zone_lookup=zone_lookup(spark), **options)


def stored(spark, paths, table):
    if table == "dim_customer":
        frame = read_current(spark, paths.gold(table))
    else:
        frame = spark.read.parquet(paths.gold(table))
    return Counter(tuple(sorted(r.asDict().items(), key=str)) for r in frame.collect())


TABLES = (
    "dim_date",
    "dim_location",
    "dim_vendor",
    "dim_ratecode",
    "dim_payment_type",
    "dim_customer",
    "fact_trips",
)


@pytest.fixture()
def lake(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    land_month(spark, paths, 2025, 1, {}, {"phonenumber": "200", "full_name": "Ben"})
    land_month(spark, paths, 2025, 2, {"full_name": "Anna"}, {"phonenumber": "300"}, {})
    return paths


@pytest.mark.parametrize("persist_silver", [False, True])
def test_two_months_and_a_second_run(spark, lake, persist_silver):
    run_month(spark, lake, 2025, 1, persist_silver=persist_silver)
    run_month(spark, lake, 2025, 2, persist_silver=persist_silver)
    first = {table: stored(spark, lake, table) for table in TABLES}
    run_month(spark, lake, 2025, 2, persist_silver=persist_silver)
    assert {table: stored(spark, lake, table) for table in TABLES} == first

    assert {t: sum(rows.values()) for t, rows in first.items()} == {
        "dim_date": 2,
        "dim_location": 3,
        "dim_vendor": 4,
        "dim_ratecode": 7,
        "dim_payment_type": 7,
        "dim_customer": 3,
        "fact_trips": 5,
    }
    customers = read_current(spark, lake.gold("dim_customer")).collect()
    assert {r["phonenumber"]: r["full_name"] for r in customers} == {
        "100": TRIP["full_name"],
        "200": "Ben",
        "300": "Ann",
    }
    months = spark.read.parquet(lake.gold("fact_trips")).groupBy("year", "month").count()
    assert {tuple(r) for r in months.collect()} == {(2025, 1, 2), (2025, 2, 3)}


def test_month_that_lost_its_trips_is_emptied(spark, lake):
    run_month(spark, lake, 2025, 1)
    run_month(spark, lake, 2025, 2)
    land_month(spark, lake, 2025, 2, {"trip_distance": 0.0})
    run_month(spark, lake, 2025, 2)
    months = spark.read.parquet(lake.gold("fact_trips")).groupBy("year", "month").count()
    assert {tuple(r) for r in months.collect()} == {(2025, 1, 2)}


def test_catalog_lists_each_month_once(spark, lake):
    spark.sql("DROP TABLE IF EXISTS fact_trips")
    for month in (1, 2, 2):
        run_month(spark, lake, 2025, month, table="fact_trips")
    assert spark.sql("SHOW PARTITIONS fact_trips").count() == 2
    assert spark.table("fact_trips").count() == 5
    spark.sql("DROP TABLE fact_trips")


def test_month_job_uses_the_lookup_of_the_lake(spark, lake):
    target = Path(lake.zone_lookup)
    target.parent.mkdir(parents=True)
    target.write_text("LocationID,Borough,Zone,service_zone\n1,Manhattan,Midtown,Yellow Zone\n")
    result = build_month(spark, lake, 2025, 1)
    assert (result.services, result.missing) == (("yellow",), ("green",))
    row = spark.read.parquet(lake.gold("fact_trips")).first()
    assert (row["pickup_location_id"], row["dropoff_location_id"]) == (1, None)


def test_reports_read_the_stored_star(spark, lake):
    run_month(spark, lake, 2025, 1)
    run_month(spark, lake, 2025, 2)
    (mix,) = reports.payment_mix(spark, lake, 2025, 2).collect()
    assert (mix["payment_type_description"], mix["trip_count"], mix["share"]) == (
        "Credit card",
        3,
        1.0,
    )
    rows = reports.payment_by_calendar(spark, lake).collect()
    assert {(r["pickup_month"], r["day_of_week"], r["trip_count"]) for r in rows} == {
        (1, 6, 2),
        (2, 2, 3),
    }
    assert {r["fare_total"] for r in rows} == {20.0, 30.0}


def test_uncommitted_version_is_ignored_and_left(spark, tmp_path):
    path = str(tmp_path / "table")
    write_next(spark.range(1), path)
    Path(path, "version=2").mkdir()
    assert committed_versions(spark, path) == [1]
    assert read_current(spark, path).count() == 1
    assert write_next(spark.range(3), path).count() == 3
    assert committed_versions(spark, path) == [1, 3]


def test_versions_count_without_a_success_file(spark, tmp_path):
    path = str(tmp_path / "table")
    option = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set(option, "false")
    try:
        write_next(spark.range(1), path)
        assert not Path(path, "version=1", "_SUCCESS").exists()
        write_next(read_current(spark, path).union(spark.range(2)), path)
    finally:
        settings.unset(option)
    assert read_current(spark, path).count() == 3


def test_table_without_versions_is_the_start_of_them(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_current(spark, path) is None
    spark.range(2).write.parquet(path)
    assert read_current(spark, path).count() == 2
    write_next(read_current(spark, path).union(spark.range(1)), path)
    assert read_current(spark, path).count() == 3
    assert os.path.isdir(f"{path}/version=1")


def test_a_plain_read_of_the_customers_sees_one_version(spark, lake):
    path = lake.gold("dim_customer")
    for month in (1, 2, 2):
        run_month(spark, lake, 2025, month)
        rows = spark.read.parquet(path).collect()
        assert len({r["phonenumber"] for r in rows}) == len(rows) == month + 1


def test_customers_kept_in_versions_are_taken_over(spark, lake):
    path = lake.gold("dim_customer")
    for name in ("Old", "Known"):
        write_next(spark.createDataFrame([("100", name)], "phonenumber string, full_name string"), path)
    run_month(spark, lake, 2025, 1)
    names = {r["phonenumber"]: r["full_name"] for r in spark.read.parquet(path).collect()}
    assert names == {"100": "Known", "200": "Ben"}


@pytest.mark.parametrize("lost", ["between the renames", "before them", "while writing"])
def test_a_cut_off_swap_loses_nothing(spark, tmp_path, lost):
    path, new, old = (str(tmp_path / name) for name in ("t", "_next_t", "_previous_t"))
    for rows in (1, 2):
        replace_table(spark.range(rows), path)
    spark.range(3).write.parquet(new)
    if lost != "while writing":
        Path(new, MARKER).touch()
    if lost == "between the renames":
        os.rename(old, f"{old}_before")
        os.rename(path, old)
    settle_table(spark, path)
    assert read_current(spark, path).count() == (3 if lost == "between the renames" else 2)
    replace_table(read_current(spark, path).union(spark.range(5)), path)
    assert spark.read.parquet(path).count() == (8 if lost == "between the renames" else 7)


def test_catalog_reads_one_month_only(spark, lake):
    spark.sql("DROP TABLE IF EXISTS fact_pruned")
    for month in (1, 2):
        run_month(spark, lake, 2025, month, table="fact_pruned")
    one = spark.table("fact_pruned").where("month = 2 and year = 2025")
    assert one.count() == 3
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(month" in plan and "(month" in plan.split("PartitionFilters")[1]
    assert "month=1" not in " ".join(one.inputFiles())
    spark.sql("DROP TABLE fact_pruned")


@pytest.mark.parametrize("job", ["silver", "gold", "month"])
def test_jobs_run_from_the_command_line(spark, lake, tmp_path, job):
    target = Path(lake.zone_lookup)
    target.parent.mkdir(parents=True)
    target.write_text("LocationID,Borough,Zone,service_zone\n1,Manhattan,Midtown,Yellow Zone\n")
    if job == "gold":
        build_silver(spark, lake, 2025, 1)
    script = Path(reports.__file__).parent / f"{job}.py"
    table = [] if job == "silver" else ["--table", "fact_of_command"]
    settings = {
        "PYTHONPATH": str(script.parents[2]),
        "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell",
    }
    command = [sys.executable, str(script), "--root", lake.root, "--year", "2025", "--month", "1"]
    done = subprocess.run(
        [*command, *table], cwd=tmp_path, env=os.environ | settings, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    if job != "gold":
        assert "missing=('green',)" in done.stdout
    stored_rows = read_silver(spark, lake, 2025, 1) if job == "silver" else reports.read_fact(spark, lake)
    assert stored_rows.count() == 2
