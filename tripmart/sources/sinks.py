"""Batch sinks. Each one may be run again for the same input without harm."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import FACT_PARTITIONS
from tripmart.sources.files import read_if_exists


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace a table and return the stored rows. ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> DataFrame:
    """Append the rows whose ``key`` the table lacks and return all stored rows."""
    spark = df.sparkSession
    stored = read_if_exists(spark, path)
    if stored is not None:
        taken = stored.select(F.col(key).alias("_taken"))
        df = df.join(taken, F.col(key).eqNullSafe(F.col("_taken")), "left_anti")
    df.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, partitions: tuple[str, ...] = FACT_PARTITIONS
) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def publish(messages: DataFrame, sink_format: str, options: Mapping[str, str]) -> None:
    """Send messages with a ``value`` column to a message sink, such as a Kafka topic."""
    messages.write.format(sink_format).options(**options).mode("append").save()


def create_fact_table(spark: SparkSession, table: str, fact: DataFrame, location: str) -> None:
    """External partitioned table over the fact files, if it is not there yet."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in fact.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(FACT_PARTITIONS)}) LOCATION '{location}'"
    )


def register_month(spark: SparkSession, table: str, year: int, month: int, location: str) -> None:
    """Make a written month visible in the catalog table."""
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS "
        f"PARTITION (year={int(year)}, month={int(month)}) LOCATION '{location}'"
    )
