"""Column contracts of every layer, as plain name -> SQL type mappings."""

# Names, types and order below are the published table layouts.

SERVICES = ("yellow", "green")

# A service names its two trip times with one of these prefixes.
TIME_PREFIXES = ("lpep_", "tpep_")
TIME_COLUMNS = ("pickup_datetime", "dropoff_datetime")

# Silver trips. ``None`` keeps the type the file has.
SILVER_TYPES = {
    "VendorID": "bigint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": None,
    "RatecodeID": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "passenger_count": "bigint",
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

# A trip lacking one of these is not a trip.
REQUIRED_COLUMNS = ("pickup_datetime", "dropoff_datetime", "trip_distance", "passenger_count")

# Fact table: dimension keys, measures, attributes, partition columns.
FACT_KEYS = (
    "phonenumber",
    "vendor_id",
    "ratecode_id",
    "payment_type_id",
    "pickup_date",
    "dropoff_date",
    "pickup_location_id",
    "dropoff_location_id",
)
FACT_MEASURES = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
)
FACT_ATTRIBUTES = ("store_and_fwd_flag", "service_type")
FACT_PARTITIONS = ("year", "month")

# Zone lookup file.
ZONE_LOOKUP_DDL = "LocationID INT NOT NULL, Borough STRING, Zone STRING, service_zone STRING"

# Trip event message (JSON object).
EVENT_TYPES = {
    "VendorID": "string",
    "tpep_pickup_datetime": "timestamp",
    "passenger_count": "string",
    "trip_distance": "double",
    "RatecodeID": "string",
    "store_and_fwd_flag": "string",
    "PULocationID": "string",
    "DOLocationID": "string",
    "phonenumber": "string",
}
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Literal dimensions.
VENDORS = (
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
)
RATECODES = (
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
)
PAYMENT_TYPES = (
    (0, "Flex Fare"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
)

# Zone counts: window length and slide, and how late an event may come.
WINDOW_MINUTES = 15
SLIDE_MINUTES = 5
WATERMARK = "20 minutes"

# Trip distance bounds of an event message.
DISTANCE_MIN = 0.1
DISTANCE_MAX = 50.0
