from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from rows import raw_trips
from tripmart.operators import profiles
from tripmart.sources import files
from tripmart.sources.paths import LakePaths
from tripmart.operators.conform import silver_trips
from tripmart.operators.messages import decode_events, encode_events
from tripmart.sources.sinks import append_new, overwrite_partitions, publish

ZONES = """LocationID,Borough,Zone,service_zone
1,EWR,Newark Airport,EWR
2,Queens,"Bay, Jamaica",Boro Zone
3,Bronx,,Boro Zone
"""


@pytest.fixture()
def zones_csv(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONES)
    return str(path)


@pytest.mark.parametrize("infer_schema", [False, True])
def test_zone_lookup_schema(spark, zones_csv, infer_schema):
    zones = files.read_zone_lookup(spark, zones_csv, infer_schema)
    assert zones.dtypes == [
        ("LocationID", "int"),
        ("Borough", "string"),
        ("Zone", "string"),
        ("service_zone", "string"),
    ]
    assert [r["Zone"] for r in zones.orderBy("LocationID").collect()] == [
        "Newark Airport",
        "Bay, Jamaica",
        None,
    ]


def test_profiles_from_csv(spark, zones_csv, tmp_path):
    (tmp_path / "pu.csv").write_text(",proportion\n1,0.5\n2,1.5\n99,7.0\n")
    (tmp_path / "matrix.csv").write_text(",1,2,99\n1,3,1,5\n2,,2,1\n99,1,1,1\n")
    (tmp_path / "customers.csv").write_text("phonenumber,other\n555,a\n,b\n")
    zones = files.read_zone_ids(spark, zones_csv)

    weights = files.read_location_profile(spark, str(tmp_path / "pu.csv"))
    shares = profiles.normalise(profiles.known_zones(weights, zones, "location_id"))
    assert {r["location_id"]: r["share"] for r in shares.collect()} == {1: 0.25, 2: 0.75}

    pairs = files.read_pair_profile(spark, str(tmp_path / "matrix.csv"))
    assert pairs.dtypes == [("pickup_id", "int"), ("dropoff_id", "int"), ("weight", "double")]
    assert pairs.count() == 9
    known = profiles.known_zones(pairs, zones, "pickup_id", "dropoff_id")
    rows = profiles.normalise_rows(known).collect()
    assert {(r["pickup_id"], r["dropoff_id"]): r["share"] for r in rows} == {
        (1, 1): 0.75,
        (1, 2): 0.25,
        (2, 1): None,
        (2, 2): 1.0,
    }
    phones = files.read_phone_numbers(spark, str(tmp_path / "customers.csv"))
    assert [r["phonenumber"] for r in phones.collect()] == ["555"]


def test_only_a_missing_path_is_tolerated(spark, tmp_path):
    assert files.read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        files.read_if_exists(spark, str(tmp_path / "empty"))


def test_month_folder_may_be_padded(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    plain, padded = paths.bronze_files("green", 2025, 3)
    assert plain.endswith("/2025/3/green_tripdata_2025-03.parquet")
    assert padded.endswith("/2025/03/green_tripdata_2025-03.parquet")
    spark.range(2).write.parquet(padded)
    found, missing = files.read_bronze(spark, paths, 2025, 3)
    assert (list(found), missing) == (["green"], ["yellow"])


def test_month_in_both_folders_is_an_error(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for path in paths.bronze_files("green", 2025, 1):
        spark.range(2).write.parquet(path)
    with pytest.raises(ValueError, match="more than once"):
        files.read_bronze(spark, paths, 2025, 1)


def test_append_new_adds_each_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,), (None,)], "k int")
    assert append_new(one, path, "k").count() == 2
    more = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert append_new(more, path, "k").count() == 3
    assert append_new(more, path, "k").count() == 3


def test_partition_overwrite_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    for month, rows in ((1, 3), (2, 5), (2, 4)):
        frame = spark.range(rows).selectExpr("id", "2025 AS year", f"{month} AS month")
        overwrite_partitions(frame, path)
    counts = spark.read.parquet(path).groupBy("month").count().collect()
    assert {tuple(r) for r in counts} == {(1, 3), (2, 4)}


def test_published_messages_can_be_decoded(spark, tmp_path):
    path = str(tmp_path / "topic")
    trips = silver_trips(raw_trips(spark, {}, {"PULocationID": None}), "yellow")
    publish(encode_events(trips), "text", {"path": path})
    decoded = decode_events(spark.read.text(path)).collect()
    assert sorted(str(r["PULocationID"]) for r in decoded) == ["1", "None"]


def test_bad_zone_lines_are_kept_as_rejected(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(f"{ZONES}x9,Queens,Astoria,Boro Zone\n,Queens,Nowhere,Boro Zone\n4,Queens\n5,a,b,c,d\n")
    lines = files.read_zone_lines(spark, str(path))
    rejected = [r["rejected"] for r in lines.where("rejected is not null").collect()]
    assert sorted(rejected) == [
        ",Queens,Nowhere,Boro Zone",
        "4,Queens",
        "5,a,b,c,d",
        "x9,Queens,Astoria,Boro Zone",
    ]
    assert sorted(r["LocationID"] for r in lines.where("rejected is null").collect()) == [1, 2, 3]
    assert [r[0] for r in lines.select("LocationID").na.drop().sort("LocationID").collect()] == [1, 2, 3]
    assert lines.count() == 7
