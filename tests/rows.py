"""Hand-made trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

RAW_TYPES = {
    "VendorID": "bigint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string",
    "RatecodeID": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "passenger_count": "double",
    "trip_distance": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "payment_type": "bigint",
    "congestion_surcharge": "double",
    "phonenumber": "string",
    "full_name": "string",
}

TRIP = {
    "VendorID": 1,
    "pickup_datetime": datetime(2025, 1, 31, 23, 50),
    "dropoff_datetime": datetime(2025, 2, 1, 0, 10),
    "store_and_fwd_flag": "N",
    "RatecodeID": 1.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.0,
    "payment_type": 1,
    "congestion_surcharge": 2.5,
    "phonenumber": "100",
    "full_name": "Ann",
}


def raw_trips(
    spark: SparkSession, *changes: dict, prefix: str = "tpep_", **types: str
) -> DataFrame:
    """One raw trip per dict of changes to ``TRIP``, under a service's time names."""
    schema = ", ".join(
        f"{prefix if name.endswith('_datetime') else ''}{name} {types.get(name, sql_type)}"
        for name, sql_type in RAW_TYPES.items()
    )
    rows = [tuple((TRIP | change)[name] for name in RAW_TYPES) for change in changes]
    return spark.createDataFrame(rows, schema)


def zone_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            (1, "Manhattan", "Midtown", "Yellow Zone"),
            (2, "Queens", "Corona", "Boro Zone"),
            (3, "Queens", "Corona", "Boro Zone"),
        ],
        "LocationID int, Borough string, Zone string, service_zone string",
    )
