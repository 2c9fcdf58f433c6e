"""Job: silver -> gold for one month.

    spark-submit --py-files tripmart.zip tripmart/plans/gold.py \\
        --root /datalake --year 2025 --month 1
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tripmart.operators import dimensions
from tripmart.operators.facts import StarDims, fact_trips
from tripmart.plans.arguments import month_arguments
from tripmart.schemas import FACT_PARTITIONS
from tripmart.session import build_session
from tripmart.sources.files import read_silver, read_zone_lookup
from tripmart.sources.paths import LakePaths
from tripmart.sources.sinks import (
    append_new,
    create_fact_table,
    overwrite,
    register_month,
)
from tripmart.sources.versions import read_current, replace_table, settle_table


def store_customers(spark: SparkSession, paths: LakePaths, trips: DataFrame) -> DataFrame:
    """Add the trips' customers to the stored ones; names that are known stay."""
    path = paths.gold("dim_customer")
    settle_table(spark, path)
    return replace_table(dimensions.dim_customer(trips, read_current(spark, path)), path)


def store_dimensions(
    spark: SparkSession, paths: LakePaths, trips: DataFrame, zone_lookup: DataFrame
) -> StarDims:
    """Write all dimensions and return the stored rows, cheap to measure and to join."""
    return StarDims(
        date=append_new(dimensions.dim_date(trips), paths.gold("dim_date"), "date"),
        location=overwrite(dimensions.dim_location(zone_lookup), paths.gold("dim_location")),
        customer=store_customers(spark, paths, trips),
        vendor=overwrite(dimensions.dim_vendor(spark), paths.gold("dim_vendor")),
        ratecode=overwrite(dimensions.dim_ratecode(spark), paths.gold("dim_ratecode")),
        payment_type=overwrite(
            dimensions.dim_payment_type(spark), paths.gold("dim_payment_type")
        ),
    )


def build_gold(
    spark: SparkSession,
    paths: LakePaths,
    year: int,
    month: int,
    zone_lookup: DataFrame | None = None,
    table: str | None = None,
    persist_silver: bool = False,
) -> None:
    """Dimensions, then the month's fact partition, then its catalog entry.

    Running a month again gives the same tables. Silver is read three times: two
    columns for the dates, two for the customers, all for the fact. ``persist_silver``
    trades those pruned scans for one cached copy; worth it when silver fits the
    executors' memory and its storage is slow.
    """
    trips = read_silver(spark, paths, year, month)
    if zone_lookup is None:
        zone_lookup = read_zone_lookup(spark, paths.zone_lookup)
    if persist_silver:
        trips.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dims = store_dimensions(spark, paths, trips, zone_lookup)
        fact = fact_trips(trips, dims, year, month)
        store_month(fact, paths, year, month)
    finally:
        if persist_silver:
            trips.unpersist()
    if table:
        create_fact_table(spark, table, fact, paths.gold("fact_trips"))
        register_month(spark, table, year, month, paths.fact_partition(year, month))


def store_month(fact: DataFrame, paths: LakePaths, year: int, month: int) -> None:
    """Replace the month's fact partition by path, an empty month included; others stay."""
    overwrite(fact.drop(*FACT_PARTITIONS), paths.fact_partition(year, month))


def main() -> None:
    arguments = month_arguments("Build the star schema of one month", table=True)
    spark = build_session("gold")
    build_gold(
        spark,
        LakePaths(arguments.root),
        arguments.year,
        arguments.month,
        table=arguments.table,
    )
    spark.stop()


if __name__ == "__main__":
    main()
