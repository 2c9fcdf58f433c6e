"""File scans: monthly trips, silver, zone lookup, profile CSVs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import SERVICES, ZONE_LOOKUP_DDL
from tripmart.sources.paths import LakePaths
from tripmart.sources.storage import path_exists


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet at ``path``, or None when the path is missing. Other errors surface."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_bronze(
    spark: SparkSession,
    paths: LakePaths,
    year: int,
    month: int,
    services: Iterable[str] = SERVICES,
) -> tuple[dict[str, DataFrame], list[str]]:
    """The month's raw trips per service, and the services whose file is missing.

    A file under both spellings of the month is an error: which one counts is unknown.
    """
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for service in services:
        files = [p for p in paths.bronze_files(service, year, month) if path_exists(spark, p)]
        if len(files) > 1:
            raise ValueError(f"{service} has its month more than once: {', '.join(files)}")
        if files:
            found[service] = spark.read.parquet(files[0])
        else:
            missing.append(service)
    return found, missing


def read_silver(spark: SparkSession, paths: LakePaths, year: int, month: int) -> DataFrame:
    """All part files of a silver month."""
    return spark.read.parquet(paths.silver(year, month))


def read_zone_lookup(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Zone lookup CSV, with the contract's schema or with an inferred one."""
    if infer_schema:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(ZONE_LOOKUP_DDL).csv(path, header=True)


def read_zone_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the zone lookup CSV with a ``rejected`` column.

    ``rejected`` is the whole line where it breaks the contract: an id that is missing or
    no whole number, or too many or too few fields. Its other columns are then NULL, so
    a bad line is neither a zone nor lost without a word.
    """
    columns = ZONE_LOOKUP_DDL.replace(" NOT NULL", "")
    # Without its unused columns a line would not be seen to have too many or too few.
    reader = spark.read.schema(f"{columns}, rejected STRING").option("columnPruning", "false")
    lines = reader.csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="rejected"
    )
    names = [field.name for field in lines.schema if field.name != "rejected"]
    # A missing id parses well, but the contract has none; so the line is put together.
    told = F.concat_ws(",", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names])
    rejected = F.coalesce("rejected", F.when(F.col(names[0]).isNull(), told))
    return lines.select(rejected.alias("rejected"), *names).select(
        *[F.when(F.col("rejected").isNull(), F.col(name)).alias(name) for name in names],
        "rejected",
    )


def read_zone_ids(spark: SparkSession, path: str) -> DataFrame:
    """The valid zone ids of the lookup as ``location_id``."""
    return read_zone_lookup(spark, path).select(F.col("LocationID").alias("location_id"))


def _by_id(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """CSV whose first column, named or not, is the id."""
    table = spark.read.csv(path, header=True)
    return table, table.columns[0]


def read_location_profile(spark: SparkSession, path: str) -> DataFrame:
    """Per-zone weights: ``location_id int, weight double``."""
    table, id_column = _by_id(spark, path)
    return table.select(
        F.col(id_column).cast("int").alias("location_id"),
        F.col("proportion").cast("double").alias("weight"),
    )


def read_pair_profile(spark: SparkSession, path: str) -> DataFrame:
    """Wide pickup x dropoff matrix as long rows: ``pickup_id, dropoff_id, weight``."""
    table, id_column = _by_id(spark, path)
    dropoffs = [F.col(f"`{name}`").cast("double").alias(name) for name in table.columns[1:]]
    wide = table.select(F.col(id_column).cast("int").alias("pickup_id"), *dropoffs)
    return wide.unpivot("pickup_id", table.columns[1:], "dropoff_id", "weight").select(
        "pickup_id", F.col("dropoff_id").cast("int").alias("dropoff_id"), "weight"
    )


def read_phone_numbers(spark: SparkSession, path: str) -> DataFrame:
    """Known phone numbers; rows without one are dropped."""
    return spark.read.csv(path, header=True).select("phonenumber").dropna()
