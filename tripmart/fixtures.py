"""The driver's tables in the roles of trips, events and zones.

One trip is one lineitem with its order, customer and supplier. Joins are left to
Spark: it broadcasts a side by its file size and splits skewed keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.conform import silver_trips
from tripmart.operators.messages import decode_json
from tripmart.operators.zone_windows import EVENT_TIME

# Trip column -> expression over the joined tables.
ROLES = {
    "VendorID": "l_linenumber",
    "pickup_datetime": "o_orderdate",
    "dropoff_datetime": "l_shipdate",
    "store_and_fwd_flag": "l_returnflag",
    "RatecodeID": "rint(l_tax * 100)",
    "PULocationID": "c_nationkey",
    "DOLocationID": "s_nationkey",
    "passenger_count": "l_quantity",
    "trip_distance": "l_discount * 100",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "0.0D",
    "tolls_amount": "0.0D",
    "improvement_surcharge": "0.0D",
    "total_amount": "o_totalprice",
    "payment_type": "substr(o_orderpriority, 1, 1)",
    "congestion_surcharge": "0.0D",
    "phonenumber": "o_custkey",
    "full_name": "c_name",
}

# The driver's tables. Given to the scan, they save it the footer job
# that finds the schema.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
}
SERVICE = "CASE l_linestatus WHEN 'F' THEN 'yellow' ELSE 'green' END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_trips(
    spark: SparkSession,
    sf_dir: str,
    prefix: str = "tpep_",
    service: str | None = None,
) -> DataFrame:
    """Raw trips, of one service or of all, with a service's time names."""
    lines = table(spark, sf_dir, "lineitem")
    if service:
        lines = lines.filter(F.expr(SERVICE) == service)
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    # Lines meet their orders last, so that no shuffle carries the columns of both.
    supplied = lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"])
    ordered = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    joined = supplied.join(ordered, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        *[
            F.expr(text).alias(f"{prefix}{name}" if name.endswith("_datetime") else name)
            for name, text in ROLES.items()
        ],
        F.expr(SERVICE).alias("service"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips of both services in one scan."""
    return silver_trips(bronze_trips(spark, sf_dir), F.col("service"))


def zone_lookup(spark: SparkSession, sf_dir: str, without_borough: str | None = None) -> DataFrame:
    """Nations as zones, regions as boroughs; one borough may be unknown to the lookup."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    zones = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )
    if without_borough:
        zones = zones.filter(F.col("Borough") != without_borough)
    return zones


def parsed_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the fields of their JSON payload."""
    return decode_json(
        table(spark, sf_dir, "events"), "props", "k INT", "event_id", "ts", "user_id", "event_type"
    )


def zone_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trip events: event time and zone id."""
    return parsed_props(spark, sf_dir).select(
        "event_id",
        F.col("ts").cast("timestamp").alias(EVENT_TIME),
        F.col("k").alias("PULocationID"),
    )
