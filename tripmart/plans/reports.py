"""Reports over the stored star schema; a month filter prunes fact partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import reports
from tripmart.sources.paths import LakePaths


def read_fact(
    spark: SparkSession, paths: LakePaths, year: int | None = None, month: int | None = None
) -> DataFrame:
    fact = spark.read.parquet(paths.gold("fact_trips"))
    if year is not None:
        fact = fact.filter(F.col("year") == year)
    if month is not None:
        fact = fact.filter(F.col("month") == month)
    return fact


def payment_mix(
    spark: SparkSession, paths: LakePaths, year: int | None = None, month: int | None = None
) -> DataFrame:
    """How riders pay."""
    payment_types = spark.read.parquet(paths.gold("dim_payment_type"))
    return reports.payment_mix(read_fact(spark, paths, year, month), payment_types)


def payment_by_calendar(
    spark: SparkSession, paths: LakePaths, year: int | None = None, month: int | None = None
) -> DataFrame:
    """When riders pay how."""
    dates = spark.read.parquet(paths.gold("dim_date"))
    return reports.payment_by_calendar(read_fact(spark, paths, year, month), dates)
