"""Queries that run the jobs, sinks and streams on the driver's tables.

Each one returns what was stored, read back as any other reader would. They write to the
folder that the cluster shares, where their tables are left.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import fixtures
from tripmart.functions import event_time_text, id_text
from tripmart.operators import dimensions, facts, profiles
from tripmart.operators.zone_windows import zone_names
from tripmart.plans.gold import build_gold, store_customers, store_month
from tripmart.plans.silver import build_silver
from tripmart.schemas import SERVICES, WATERMARK
from tripmart.sources.files import read_pair_profile, read_silver, read_zone_lines
from tripmart.sources.paths import LakePaths
from tripmart.sources.scratch import scratch_folder
from tripmart.sources.sinks import append_new, create_fact_table, overwrite, register_month
from tripmart.streaming.upserts import BatchWriter, current_zone_counts, parquet_upserts
from tripmart.streaming.zone_counts import message_stream, start_zone_counts

YEAR = 2025
MONTHS = (1, 2)
UNKNOWN_BOROUGH = "EUROPE"

# Late events: every fifth one arrives a run, ten days, after its time.
LATE_RUNS = 3
DAYS_OF_RUN = 10
LATE_MODULUS = 5

Query = Callable[[SparkSession, str], DataFrame]


# --- streams ----------------------------------------------------------------------


def _stream(
    spark: SparkSession,
    sf_dir: str,
    run_of: Column,
    runs: int,
    write: Callable[[str], BatchWriter],
    lateness: str = WATERMARK,
) -> DataFrame:
    """Land the events as messages, run by run, and count each run from one checkpoint.

    Returns what the sink holds after the last run.
    """
    folder = scratch_folder(spark)
    # The stored lookup: each run joins its zones without computing them again.
    lookup = overwrite(fixtures.zone_lookup(spark, sf_dir), f"{folder}/zones")
    events = fixtures.parsed_props(spark, sf_dir)
    message = F.struct(
        event_time_text(F.col("ts")).alias("tpep_pickup_datetime"),
        id_text(F.col("k")).alias("PULocationID"),
    )
    messages = events.select(run_of.alias("run"), F.to_json(message).alias("value"))
    for run in range(runs):
        arrived = messages.where(F.col("run") == run).select("value")
        arrived.write.mode("append").text(f"{folder}/messages")
        start_zone_counts(
            message_stream(spark, "text", {}, f"{folder}/messages"),
            zone_names(lookup),
            write(f"{folder}/counts"),
            f"{folder}/checkpoint",
            trigger={"availableNow": True},
            lateness=lateness,
        ).awaitTermination()
    return current_zone_counts(spark, f"{folder}/counts")


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream in which every fifth event comes ten days late.

    A run drops the windows that end at or before the latest event of the runs before,
    less the 20 minutes of the watermark.
    """
    late = F.when(F.col("event_id") % LATE_MODULUS == 0, 1).otherwise(0)
    day = F.floor((F.dayofmonth("ts") - 1) / DAYS_OF_RUN)
    run = F.least(day + late, F.lit(LATE_RUNS - 1))
    return _stream(spark, sf_dir, run, LATE_RUNS, parquet_upserts)


def stream_replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream whose every batch is delivered twice, with compactions between."""

    def write(path: str) -> BatchWriter:
        once = parquet_upserts(path, compact_every=1)

        def twice(batch: DataFrame, batch_id: int) -> None:
            once(batch, batch_id)
            once(batch, batch_id)

        return twice

    half = F.when(F.dayofmonth("ts") <= 15, 0).otherwise(1)
    return _stream(spark, sf_dir, half, 2, write)


def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream that ends and starts again, with every window still open.

    The runs share the events of all windows, so only carried state counts them right.
    """
    return _stream(spark, sf_dir, F.col("event_id") % 2, 2, parquet_upserts, "60 days")


# --- batch jobs -------------------------------------------------------------------


def _month_of(trips: DataFrame, month: int) -> DataFrame:
    """The trips of half a year, in the role of a month."""
    first = F.month("pickup_datetime") <= 6
    return trips.where(first if month == MONTHS[0] else ~first)


def _landed(trips: DataFrame, paths: LakePaths) -> DataFrame:
    """The trips stored once, so that the runs of the months do not join them again."""
    return overwrite(trips, f"{paths.root}/trips")


def silver_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files of both services landed, made silver by the job, and read."""
    paths = LakePaths(scratch_folder(spark))
    for service, prefix in zip(SERVICES, ("tpep_", "lpep_")):
        raw = fixtures.bronze_trips(spark, sf_dir, prefix=prefix, service=service)
        raw.write.parquet(paths.bronze_files(service, YEAR, MONTHS[0])[0])
    build_silver(spark, paths, YEAR, MONTHS[0])
    return read_silver(spark, paths, YEAR, MONTHS[0])


def gold_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after two months and a second run of the last."""
    paths = LakePaths(scratch_folder(spark))
    trips = _landed(fixtures.trips(spark, sf_dir), paths)
    lookup = fixtures.zone_lookup(spark, sf_dir)
    for month in MONTHS:
        overwrite(_month_of(trips, month), paths.silver(YEAR, month))
    for month in (*MONTHS, MONTHS[-1]):
        build_gold(spark, paths, YEAR, month, zone_lookup=lookup)
    return spark.read.parquet(paths.gold("fact_trips"))


def gold_catalog_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month's trips, read through the catalog by its partition."""
    paths = LakePaths(scratch_folder(spark))
    table = f"fact_trips_{uuid4().hex}"
    trips = _landed(fixtures.trips(spark, sf_dir), paths)
    lookup = fixtures.zone_lookup(spark, sf_dir)
    dims = facts.StarDims(
        date=None,
        location=overwrite(dimensions.dim_location(lookup), paths.gold("dim_location")),
        customer=dimensions.dim_customer(trips),
        vendor=dimensions.dim_vendor(spark),
        ratecode=dimensions.dim_ratecode(spark),
        payment_type=dimensions.dim_payment_type(spark),
    )
    for month in (*MONTHS, MONTHS[-1]):
        fact = facts.fact_trips(_month_of(trips, month), dims, YEAR, month)
        store_month(fact, paths, YEAR, month)
        create_fact_table(spark, table, fact, paths.gold("fact_trips"))
        register_month(spark, table, YEAR, month, paths.fact_partition(YEAR, month))
    first, last = (
        spark.table(table).where((F.col("year") == YEAR) & (F.col("month") == month))
        for month in MONTHS
    )
    return first.unionByName(last)


def gold_dates_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates appended month by month, the last one twice."""
    paths = LakePaths(scratch_folder(spark))
    times = fixtures.trips(spark, sf_dir).select("pickup_datetime", "dropoff_datetime")
    trips = _landed(times, paths)
    for month in (*MONTHS, MONTHS[-1]):
        days = dimensions.dim_date(_month_of(trips, month))
        dates = append_new(days, paths.gold("dim_date"), "date")
    return dates


def gold_customers_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after two months, as a plain read of the folder finds them.

    The second month spells all names in another way; known ones stay.
    """
    paths = LakePaths(scratch_folder(spark))
    riders = fixtures.trips(spark, sf_dir).select("pickup_datetime", "phonenumber", "full_name")
    trips = _landed(riders, paths)
    first, last = (_month_of(trips, month) for month in MONTHS)
    store_customers(spark, paths, first)
    later = last.withColumn("full_name", F.concat(F.lit("Later "), "full_name"))
    for _ in range(2):
        store_customers(spark, paths, later)
    return spark.read.parquet(paths.gold("dim_customer"))


# --- CSV --------------------------------------------------------------------------


def matrix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair weights stored as a wide CSV matrix, read as rows, known zones only."""
    path = f"{scratch_folder(spark)}/pu_do_matrix"
    pairs = profiles.pair_weights(fixtures.trips(spark, sf_dir))
    wide = pairs.groupBy("pickup_id").pivot("dropoff_id").agg(F.first("weight"))
    wide.write.csv(path, header=True)
    lookup = fixtures.zone_lookup(spark, sf_dir, without_borough=UNKNOWN_BOROUGH)
    zones = dimensions.dim_location(lookup).select("location_id")
    stored = read_pair_profile(spark, path).where("weight is not null")
    return profiles.known_zones(stored, zones, "pickup_id", "dropoff_id").select(
        *[F.col(name).cast("bigint").alias(name) for name in ("pickup_id", "dropoff_id", "weight")]
    )


def zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of a zone lookup, some of them bad: zones and rejected lines."""
    path = f"{scratch_folder(spark)}/zones"
    kind = F.col("c_custkey") % 10
    bad_id = F.when(kind == 3, "n/a").when(kind == 5, "").otherwise(F.col("c_custkey").cast("string"))
    more = F.when(kind == 7, ",more").otherwise("")
    last = F.concat(F.col("c_nationkey").cast("string"), more)
    line = F.concat_ws(",", bad_id, "c_mktsegment", "c_name", last)
    customers = fixtures.table(spark, sf_dir, "customer")
    header = "LocationID,Borough,Zone,service_zone"
    # Whole lines, so the commas in them are not the writer's.
    customers.select(line.alias(header)).write.csv(path, header=True, sep="\x01")
    return read_zone_lines(spark, path)


def queries() -> dict[str, Query]:
    return {
        "stream_late_events": stream_late_events,
        "stream_replayed_batches": stream_replayed_batches,
        "stream_restarted": stream_restarted,
        "silver_landed": silver_landed,
        "gold_two_months": gold_two_months,
        "gold_catalog_months": gold_catalog_months,
        "gold_dates_appended": gold_dates_appended,
        "gold_customers_read": gold_customers_read,
        "matrix_pairs": matrix_pairs,
        "zone_lines": zone_lines,
    }
