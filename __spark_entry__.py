"""

Each query runs over whole tables. ``tripmart/fixtures.py`` gives the tables their
trip roles; the SQL below states the same roles on its own.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmart import fixtures, stored_queries  # noqa: E402
from tripmart.functions import bounded_distance, next_weekday  # noqa: E402
from tripmart.operators import conform, dimensions, facts, profiles, reports  # noqa: E402
from tripmart.operators import zone_windows as windows  # noqa: E402
from tripmart.operators.messages import encode_events  # noqa: E402
from tripmart.plans.profiles import destination_profile  # noqa: E402
from tripmart.schemas import PAYMENT_TYPES, RATECODES, VENDORS  # noqa: E402
from tripmart.streaming.zone_counts import stream_zone_counts  # noqa: E402

# The corpus operators are an optional part: a subpackage and the pipeline over it.
try:
    from tripmart.llm import queries as corpus  # noqa: E402
except ImportError:
    corpus = None
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

YEAR, MONTH = stored_queries.YEAR, 1
UNKNOWN_BOROUGH = "EUROPE"
KNOWN_SEGMENT = "BUILDING"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: trips per zone over sliding windows."""
    return queries()["zone_counts_sliding"](spark, "/root/testdata/sf0.001")


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the oracle has them."""
    return df.select(
        *[
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if field.dataType.typeName() == "timestamp"
            else F.col(field.name)
            for field in df.schema
        ]
    )


# --- zone windows -----------------------------------------------------------------


def events_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.parsed_props(spark, sf_dir).select("event_id", "k")


def zone_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = windows.zone_names(fixtures.zone_lookup(spark, sf_dir))
    events = fixtures.zone_events(spark, sf_dir)
    return windows.zone_enrich(events, zones, "event_id", windows.EVENT_TIME)


def zone_enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone names by a shuffled join."""
    zones = windows.zone_names(fixtures.zone_lookup(spark, sf_dir))
    events = fixtures.zone_events(spark, sf_dir)
    return windows.zone_enrich(
        events, zones, "event_id", windows.EVENT_TIME, shuffled=True
    )


def zone_counts_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = windows.zone_names(fixtures.zone_lookup(spark, sf_dir))
    return windows.zone_counts(fixtures.zone_events(spark, sf_dir), zones)


def zone_counts_one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = windows.zone_names(fixtures.zone_lookup(spark, sf_dir))
    return windows.sliding_counts(fixtures.zone_events(spark, sf_dir), zones)


def zone_counts_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = windows.zone_names(fixtures.zone_lookup(spark, sf_dir))
    trips = fixtures.trips(spark, sf_dir)
    return stream_zone_counts(encode_events(trips), zones)


def events_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_events(fixtures.trips(spark, sf_dir))


# --- silver -----------------------------------------------------------------------


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.bronze_trips(spark, sf_dir, prefix="lpep_")
    return conform.valid_trips(conform.conform(raw))


def silver_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.bronze_trips(spark, sf_dir)
    taxed = conform.conform(raw).withColumn("mta_tax", F.nullif("mta_tax", F.lit(0.0)))
    return conform.drop_incomplete(taxed, ("pickup_datetime", "dropoff_datetime", "mta_tax"))


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.union_services(
        {
            "yellow": fixtures.bronze_trips(spark, sf_dir, prefix="tpep_", service="yellow"),
            "green": fixtures.bronze_trips(spark, sf_dir, prefix="lpep_", service="green"),
        }
    )


# --- dimensions -------------------------------------------------------------------


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_date(fixtures.trips(spark, sf_dir))


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_location(fixtures.zone_lookup(spark, sf_dir))


def _with_trip_count(dim: DataFrame, trips: DataFrame, dim_key: str, column: str) -> DataFrame:
    """Literal dimension with the trips of each row: its use of the whole trip table."""
    used = trips.groupBy(F.col(column).alias("used")).agg(F.count("*").alias("trips"))
    counted = dim.join(used, F.col(dim_key) == F.col("used"), "left")
    return counted.select("*", F.coalesce("trips", F.lit(0)).alias("trip_count")).drop(
        "used", "trips"
    )


def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    return _with_trip_count(dimensions.dim_vendor(spark), trips, "vendor_id", "VendorID")


def dim_ratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    return _with_trip_count(dimensions.dim_ratecode(spark), trips, "ratecode_id", "RatecodeID")


def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    dim = dimensions.dim_payment_type(spark)
    return _with_trip_count(dim, trips, "payment_type_id", "payment_type")


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.customer_names(fixtures.trips(spark, sf_dir))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_customer(fixtures.trips(spark, sf_dir))


def dim_customer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = (
        fixtures.table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == KNOWN_SEGMENT)
        .select(
            F.col("c_custkey").cast("string").alias("phonenumber"),
            F.concat(F.lit("Known "), "c_name").alias("full_name"),
        )
    )
    return dimensions.dim_customer(fixtures.trips(spark, sf_dir), known)


# --- fact -------------------------------------------------------------------------


def _star_dims(
    spark: SparkSession,
    sf_dir: str,
    trips: DataFrame,
    zone_lookup: DataFrame,
    join_dates: bool = False,
) -> facts.StarDims:
    return facts.StarDims(
        date=dim_date(spark, sf_dir) if join_dates else None,
        location=dimensions.dim_location(zone_lookup),
        customer=dimensions.dim_customer(trips),
        vendor=dimensions.dim_vendor(spark),
        ratecode=dimensions.dim_ratecode(spark),
        payment_type=dimensions.dim_payment_type(spark),
    )


def fact_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    dims = _star_dims(spark, sf_dir, trips, fixtures.zone_lookup(spark, sf_dir))
    return facts.fact_trips(trips, dims, YEAR, MONTH)


def fact_star_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star with the date dimension joined; no join to a dimension moves the trips."""
    trips = fixtures.trips(spark, sf_dir)
    dims = _star_dims(spark, sf_dir, trips, fixtures.zone_lookup(spark, sf_dir), join_dates=True)
    return facts.fact_trips(trips, dims, YEAR, MONTH)


def fact_unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    zones = fixtures.zone_lookup(spark, sf_dir, without_borough=UNKNOWN_BOROUGH)
    fact = facts.fact_trips(trips, _star_dims(spark, sf_dir, trips, zones), YEAR, MONTH)
    return facts.unmatched_keys(fact)


# --- reports ----------------------------------------------------------------------


def _payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    dims = _star_dims(spark, sf_dir, trips, fixtures.zone_lookup(spark, sf_dir))
    return facts.fact_trips(trips, dims, YEAR, MONTH)


def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_mix(
        _payment_fact(spark, sf_dir), dimensions.dim_payment_type(spark)
    )


def payment_by_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_by_calendar(_payment_fact(spark, sf_dir), dim_date(spark, sf_dir))


# --- profiles ---------------------------------------------------------------------


def _known_zone_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = fixtures.zone_lookup(spark, sf_dir, without_borough=UNKNOWN_BOROUGH)
    return dimensions.dim_location(lookup).select("location_id")


def valid_location_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = profiles.zone_weights(fixtures.trips(spark, sf_dir), "PULocationID")
    return profiles.known_zones(weights, _known_zone_ids(spark, sf_dir), "location_id")


def valid_pair_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = profiles.pair_weights(
        fixtures.trips(spark, sf_dir)
    )
    zones = _known_zone_ids(spark, sf_dir)
    return profiles.known_zones(pairs, zones, "pickup_id", "dropoff_id")


def pickup_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.normalise(valid_location_semi(spark, sf_dir))


def od_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = profiles.pair_weights(
        fixtures.trips(spark, sf_dir)
    )
    return profiles.normalise_rows(pairs)


def od_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixtures.trips(spark, sf_dir)
    return destination_profile(trips, _known_zone_ids(spark, sf_dir))


def clamp_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events")
    return events.select("event_id", bounded_distance(F.col("value")).alias("distance"))


def next_weekday_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    weekday = F.col("l_linenumber") - 1
    return lines.select(
        "l_orderkey", "l_linenumber", next_weekday(day, weekday).alias("next_date")
    )


def queries() -> dict[str, Query]:
    """Query name -> callable over (session, folder of the tables)."""
    named = {
        "events_parse_json": events_parse_json,
        "zone_enrich": zone_enrich,
        "zone_enrich_salted": zone_enrich_salted,
        "zone_counts_sliding": zone_counts_sliding,
        "zone_counts_one_step": zone_counts_one_step,
        "zone_counts_messages": zone_counts_messages,
        "events_to_json": events_to_json,
        "silver_clean": silver_clean,
        "silver_dropna": silver_dropna,
        "silver_union": silver_union,
        "dim_date": dim_date,
        "dim_location": dim_location,
        "dim_vendor": dim_vendor,
        "dim_ratecode": dim_ratecode,
        "dim_payment_type": dim_payment_type,
        "customer_names": customer_names,
        "dim_customer": dim_customer,
        "dim_customer_merge": dim_customer_merge,
        "fact_star": fact_star,
        "fact_star_salted": fact_star_salted,
        "fact_unmatched_keys": fact_unmatched_keys,
        "payment_mix": payment_mix,
        "payment_by_calendar": payment_by_calendar,
        "valid_location_semi": valid_location_semi,
        "valid_pair_semi": valid_pair_semi,
        "pickup_share": pickup_share,
        "od_share": od_share,
        "od_fallback": od_fallback,
        "clamp_round": clamp_round,
        "next_weekday": next_weekday_of,
    } | stored_queries.queries()
    timed = {name: _with_plain_times(query) for name, query in named.items()}
    if corpus:
        timed |= corpus.queries()
    if corpus_pipeline:
        timed["pipeline"] = corpus_pipeline.run
    return timed


def _with_plain_times(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain_times(query(spark, sf_dir))

    return run


# --- oracles ----------------------------------------------------------------------

_TRIPS = """
SELECT CAST(l_linenumber AS BIGINT) AS "VendorID", o_orderdate AS pickup_datetime,
  l_shipdate AS dropoff_datetime, l_returnflag AS store_and_fwd_flag,
  round(l_tax * 100) AS "RatecodeID", CAST(c_nationkey AS BIGINT) AS "PULocationID",
  CAST(s_nationkey AS BIGINT) AS "DOLocationID",
  CAST(trunc(l_quantity) AS BIGINT) AS passenger_count, l_discount * 100 AS trip_distance,
  l_extendedprice AS fare_amount, l_discount AS extra, l_tax AS mta_tax,
  CAST(0 AS DOUBLE) AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
  CAST(0 AS DOUBLE) AS improvement_surcharge, o_totalprice AS total_amount,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
  CAST(0 AS DOUBLE) AS congestion_surcharge, CAST(o_custkey AS VARCHAR) AS phonenumber,
  c_name AS full_name,
  CASE l_linestatus WHEN 'F' THEN 'yellow' ELSE 'green' END AS service_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""
_SILVER = f"""
SELECT * FROM ({_TRIPS}) AS bronze
WHERE trip_distance > 0 AND NOT isnan(trip_distance) AND passenger_count > 0
  AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
"""
_ZONES = """
SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, r_name AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
_KNOWN_ZONES = f"SELECT * FROM ({_ZONES}) AS z WHERE borough <> '{UNKNOWN_BOROUGH}'"
_DATES = f"""
SELECT CAST(pickup_datetime AS DATE) AS date FROM ({_SILVER}) AS p
UNION SELECT CAST(dropoff_datetime AS DATE) FROM ({_SILVER}) AS d
"""
_CALENDAR = f"""
SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
  CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week
FROM ({_DATES}) AS dates
"""


def _values(rows: tuple[tuple[int, str], ...]) -> str:
    return ", ".join(f"(CAST({number} AS BIGINT), '{text}')" for number, text in rows)


_VENDORS = _values(VENDORS)
_RATECODES = _values(RATECODES)
_PAYMENTS = _values(PAYMENT_TYPES)


def _fact(zones: str, month: str = str(MONTH)) -> str:
    return f"""
SELECT t.phonenumber, v.vendor_id, r.ratecode_id, p.payment_type_id,
  pd.date AS pickup_date, dd.date AS dropoff_date,
  pz.location_id AS pickup_location_id, dz.location_id AS dropoff_location_id,
  t.passenger_count, t.trip_distance, t.fare_amount, t.extra, t.mta_tax, t.tip_amount,
  t.tolls_amount, t.improvement_surcharge, t.total_amount, t.congestion_surcharge,
  t.store_and_fwd_flag, t.service_type,
  CAST({YEAR} AS INTEGER) AS year, CAST({month} AS INTEGER) AS month
FROM ({_SILVER}) AS t
  LEFT JOIN ({_DATES}) AS pd ON CAST(t.pickup_datetime AS DATE) = pd.date
  LEFT JOIN ({_DATES}) AS dd ON CAST(t.dropoff_datetime AS DATE) = dd.date
  LEFT JOIN ({zones}) AS pz ON t."PULocationID" = pz.location_id
  LEFT JOIN ({zones}) AS dz ON t."DOLocationID" = dz.location_id
  LEFT JOIN (SELECT phonenumber, min(full_name) AS full_name FROM ({_SILVER}) AS c0
    GROUP BY phonenumber) AS c ON t.phonenumber = c.phonenumber
  LEFT JOIN (VALUES {_VENDORS}) AS v(vendor_id, vendor_name) ON t."VendorID" = v.vendor_id
  LEFT JOIN (VALUES {_RATECODES}) AS r(ratecode_id, ratecode_description)
    ON t."RatecodeID" = r.ratecode_id
  LEFT JOIN (VALUES {_PAYMENTS}) AS p(payment_type_id, payment_type_description)
    ON t.payment_type = p.payment_type_id
"""


def _used_dim(rows: str, key: str, text: str, column: str) -> str:
    return f"""
SELECT {key}, {text}, CAST(count(t.used) AS BIGINT) AS trip_count
FROM (VALUES {rows}) AS d({key}, {text})
  LEFT JOIN (SELECT "{column}" AS used FROM ({_SILVER}) AS s) AS t ON t.used = d.{key}
GROUP BY {key}, {text}
"""


_PARSED = """
SELECT event_id, ts, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""


def _sliding(events: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL '5 minutes', e.ts) - i * INTERVAL '5 minutes' AS window_start,
  time_bucket(INTERVAL '5 minutes', e.ts) - i * INTERVAL '5 minutes'
    + INTERVAL '15 minutes' AS window_end,
  z.zone, count(*) AS trip_count
FROM ({events}) AS e JOIN ({_ZONES}) AS z ON e.k = z.location_id
  CROSS JOIN range(3) AS offsets(i)
GROUP BY ALL
"""


_ENRICHED = f"""
SELECT e.event_id, e.ts AS tpep_pickup_datetime, z.zone
FROM ({_PARSED}) AS e JOIN ({_ZONES}) AS z ON e.k = z.location_id
"""
_MESSAGE_EVENTS = f"""
SELECT date_trunc('second', pickup_datetime) AS ts, "PULocationID" AS k FROM ({_SILVER}) AS s
"""
_MESSAGES = f"""
SELECT '{{"VendorID":"' || "VendorID"
  || '","tpep_pickup_datetime":"' || strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')
  || '","passenger_count":"' || passenger_count
  || '","trip_distance":'
  || CAST(round(greatest(0.1, least(50.0, trip_distance)), 2) AS VARCHAR)
  || ',"RatecodeID":"' || CAST("RatecodeID" AS BIGINT)
  || '","store_and_fwd_flag":"' || store_and_fwd_flag
  || '","PULocationID":"' || "PULocationID" || '","DOLocationID":"' || "DOLocationID"
  || '","phonenumber":"' || phonenumber || '"}}' AS value
FROM ({_SILVER}) AS s
"""
_NAMES = f"SELECT DISTINCT phonenumber, full_name FROM ({_SILVER}) AS s"
_CUSTOMERS = f"""
SELECT phonenumber, min(full_name) AS full_name FROM ({_SILVER}) AS s
GROUP BY phonenumber, CASE WHEN phonenumber IS NULL THEN full_name END
"""
_PAIRS = f"""
SELECT "PULocationID" AS pickup_id, "DOLocationID" AS dropoff_id, count(*) AS weight
FROM ({_SILVER}) AS s GROUP BY ALL
"""
_KNOWN_PAIRS = f"""
SELECT * FROM ({_PAIRS}) AS p
WHERE pickup_id IN (SELECT location_id FROM ({_KNOWN_ZONES}) AS a)
  AND dropoff_id IN (SELECT location_id FROM ({_KNOWN_ZONES}) AS b)
"""
_KNOWN_PICKUPS = f"""
SELECT "PULocationID" AS location_id, count(*) AS weight FROM ({_SILVER}) AS s
WHERE "PULocationID" IN (SELECT location_id FROM ({_KNOWN_ZONES}) AS z)
GROUP BY "PULocationID"
"""


# Events by the run that they arrive in, and the time up to which a run drops windows.
_LATE = stored_queries.LATE_MODULUS
_ARRIVALS = f"""
SELECT date_trunc('second', ts) AS ts, k, least({stored_queries.LATE_RUNS - 1},
  (day(ts) - 1) // {stored_queries.DAYS_OF_RUN} + CASE WHEN event_id % {_LATE} = 0 THEN 1 ELSE 0 END)
  AS run FROM ({_PARSED}) AS e
"""
_LATE_COUNTS = f"""
WITH arrivals AS ({_ARRIVALS}),
marks AS (SELECT r.run, max(a.ts) - INTERVAL '20 minutes' AS mark
  FROM (SELECT DISTINCT run FROM arrivals) AS r LEFT JOIN arrivals AS a ON a.run < r.run
  GROUP BY r.run),
windows AS (SELECT a.run, a.k, time_bucket(INTERVAL '5 minutes', a.ts) - i * INTERVAL '5 minutes'
    AS window_start FROM arrivals AS a CROSS JOIN range(3) AS offsets(i))
SELECT w.window_start, w.window_start + INTERVAL '15 minutes' AS window_end, z.zone,
  count(*) AS trip_count
FROM windows AS w JOIN marks AS m ON w.run = m.run JOIN ({_ZONES}) AS z ON w.k = z.location_id
WHERE m.mark IS NULL OR w.window_start + INTERVAL '15 minutes' > m.mark
GROUP BY ALL
"""
_MONTH_OF_TRIP = "CASE WHEN month(t.pickup_datetime) <= 6 THEN 1 ELSE 2 END"
_MONTH_CUSTOMERS = f"""
SELECT month, phonenumber, min(full_name) AS full_name
FROM (SELECT t.phonenumber, t.full_name, {_MONTH_OF_TRIP} AS month FROM ({_SILVER}) AS t) AS s
GROUP BY ALL
"""
_ZONE_LINES = f"""
SELECT c_custkey % 10 AS kind, CAST(c_custkey AS INTEGER) AS "LocationID", c_mktsegment AS "Borough",
  c_name AS "Zone", CAST(c_nationkey AS VARCHAR) AS service_zone FROM customer
"""


def oracle_sql() -> dict[str, str]:
    """Query name -> the same result in DuckDB SQL."""
    fact = _fact(_ZONES)
    dropped = ("pickup_datetime", "dropoff_datetime", "mta_tax")
    required = " AND ".join(f"{name} IS NOT NULL" for name in dropped)
    optional = corpus.oracle_sql() if corpus else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        optional["pipeline"] = corpus_pipeline.ORACLE_SQL
    return optional | {
        "events_parse_json": f"SELECT event_id, k FROM ({_PARSED}) AS e",
        "zone_enrich": _ENRICHED,
        "zone_enrich_salted": _ENRICHED,
        "zone_counts_sliding": _sliding(_PARSED),
        "zone_counts_one_step": _sliding(_PARSED),
        "zone_counts_messages": _sliding(_MESSAGE_EVENTS),
        "events_to_json": _MESSAGES,
        "silver_clean": f"SELECT * EXCLUDE (service_type) FROM ({_SILVER}) AS s",
        "silver_dropna": f"""
SELECT * FROM (SELECT * EXCLUDE (service_type) REPLACE (nullif(mta_tax, 0) AS mta_tax)
  FROM ({_TRIPS}) AS t) AS taxed WHERE {required}
""",
        "silver_union": f"""
SELECT * FROM ({_SILVER}) AS y WHERE service_type = 'yellow'
UNION ALL SELECT * FROM ({_SILVER}) AS g WHERE service_type = 'green'
""",
        "dim_date": _CALENDAR,
        "dim_location": _ZONES,
        "dim_vendor": _used_dim(_VENDORS, "vendor_id", "vendor_name", "VendorID"),
        "dim_ratecode": _used_dim(
            _RATECODES, "ratecode_id", "ratecode_description", "RatecodeID"
        ),
        "dim_payment_type": _used_dim(
            _PAYMENTS, "payment_type_id", "payment_type_description", "payment_type"
        ),
        "customer_names": _NAMES,
        "dim_customer": _CUSTOMERS,
        "dim_customer_merge": f"""
SELECT coalesce(n.phonenumber, k.phonenumber) AS phonenumber,
  coalesce(k.full_name, n.full_name) AS full_name
FROM ({_CUSTOMERS}) AS n FULL OUTER JOIN (
  SELECT CAST(c_custkey AS VARCHAR) AS phonenumber, 'Known ' || c_name AS full_name
  FROM customer WHERE c_mktsegment = '{KNOWN_SEGMENT}') AS k ON n.phonenumber = k.phonenumber
""",
        "fact_star": fact,
        "fact_star_salted": fact,
        "fact_unmatched_keys": f"""
SELECT count(*) FILTER (WHERE vendor_id IS NULL) AS vendor_id,
  count(*) FILTER (WHERE ratecode_id IS NULL) AS ratecode_id,
  count(*) FILTER (WHERE payment_type_id IS NULL) AS payment_type_id,
  count(*) FILTER (WHERE pickup_date IS NULL) AS pickup_date,
  count(*) FILTER (WHERE dropoff_date IS NULL) AS dropoff_date,
  count(*) FILTER (WHERE pickup_location_id IS NULL) AS pickup_location_id,
  count(*) FILTER (WHERE dropoff_location_id IS NULL) AS dropoff_location_id
FROM ({_fact(_KNOWN_ZONES)}) AS f
""",
        "payment_mix": f"""
SELECT f.payment_type_id, p.payment_type_description, f.trip_count,
  round(f.trip_count / sum(f.trip_count) OVER (), 6) AS share, f.fare_total, f.bad_fares
FROM (SELECT payment_type_id, count(*) AS trip_count,
    CAST(sum(TRY_CAST(fare_amount AS DECIMAL(28, 2))) AS DOUBLE) AS fare_total,
    count(*) FILTER (WHERE fare_amount IS NOT NULL
      AND TRY_CAST(fare_amount AS DECIMAL(28, 2)) IS NULL) AS bad_fares
  FROM ({fact}) AS x GROUP BY payment_type_id) AS f
LEFT JOIN (VALUES {_PAYMENTS}) AS p(payment_type_id, payment_type_description)
  ON f.payment_type_id = p.payment_type_id
""",
        "payment_by_calendar": f"""
SELECT f.payment_type_id, d.month AS pickup_month, d.day_of_week, count(*) AS trip_count,
  CAST(sum(TRY_CAST(f.fare_amount AS DECIMAL(28, 2))) AS DOUBLE) AS fare_total,
  count(*) FILTER (WHERE f.fare_amount IS NOT NULL
    AND TRY_CAST(f.fare_amount AS DECIMAL(28, 2)) IS NULL) AS bad_fares
FROM ({fact}) AS f LEFT JOIN ({_CALENDAR}) AS d ON f.pickup_date = d.date
GROUP BY ALL
""",
        "valid_location_semi": _KNOWN_PICKUPS,
        "valid_pair_semi": _KNOWN_PAIRS,
        "pickup_share": f"""
SELECT location_id, weight, round(weight / sum(weight) OVER (), 6) AS share
FROM ({_KNOWN_PICKUPS}) AS w
""",
        "od_share": f"""
SELECT pickup_id, dropoff_id, weight,
  round(weight / sum(weight) OVER (PARTITION BY pickup_id), 6) AS share
FROM ({_PAIRS}) AS p
""",
        "od_fallback": f"""
WITH own AS (SELECT pickup_id, dropoff_id,
    round(weight / sum(weight) OVER (PARTITION BY pickup_id), 6) AS share
  FROM ({_KNOWN_PAIRS}) AS k),
everywhere AS (SELECT dropoff_id, round(sum(weight) / sum(sum(weight)) OVER (), 6) AS share
  FROM ({_PAIRS}) AS p
  WHERE dropoff_id IN (SELECT location_id FROM ({_KNOWN_ZONES}) AS z) GROUP BY dropoff_id)
SELECT p.pickup_id, p.dropoff_id, p.weight, 'own' AS profile, coalesce(o.share, 0) AS share
FROM ({_PAIRS}) AS p LEFT JOIN own AS o USING (pickup_id, dropoff_id)
WHERE p.pickup_id IN (SELECT pickup_id FROM own)
UNION ALL
SELECT p.pickup_id, p.dropoff_id, p.weight, 'global' AS profile, coalesce(e.share, 0) AS share
FROM ({_PAIRS}) AS p LEFT JOIN everywhere AS e USING (dropoff_id)
WHERE p.pickup_id NOT IN (SELECT pickup_id FROM own)
""",
        "clamp_round": """
SELECT event_id, CASE WHEN value IS NOT NULL AND NOT isnan(value)
  THEN round(greatest(0.1, least(50.0, value)), 2) END AS distance FROM events
""",
        "stream_late_events": _LATE_COUNTS,
        "stream_replayed_batches": _sliding(_PARSED),
        "stream_restarted": _sliding(_PARSED),
        "silver_landed": f"SELECT * FROM ({_SILVER}) AS s",
        "gold_two_months": _fact(_ZONES, _MONTH_OF_TRIP),
        "gold_catalog_months": _fact(_ZONES, _MONTH_OF_TRIP),
        "gold_dates_appended": _CALENDAR,
        "gold_customers_read": f"""
SELECT coalesce(a.phonenumber, b.phonenumber) AS phonenumber,
  coalesce(a.full_name, 'Later ' || b.full_name) AS full_name
FROM (SELECT * FROM ({_MONTH_CUSTOMERS}) AS x WHERE month = 1) AS a
  FULL OUTER JOIN (SELECT * FROM ({_MONTH_CUSTOMERS}) AS y WHERE month = 2) AS b
  ON a.phonenumber = b.phonenumber
""",
        "matrix_pairs": _KNOWN_PAIRS,
        "zone_lines": f"""
SELECT CASE WHEN kind NOT IN (3, 5, 7) THEN "LocationID" END AS "LocationID",
  CASE WHEN kind NOT IN (3, 5, 7) THEN "Borough" END AS "Borough",
  CASE WHEN kind NOT IN (3, 5, 7) THEN "Zone" END AS "Zone",
  CASE WHEN kind NOT IN (3, 5, 7) THEN service_zone END AS service_zone,
  CASE kind WHEN 3 THEN 'n/a,' || "Borough" || ',' || "Zone" || ',' || service_zone
    WHEN 5 THEN ',' || "Borough" || ',' || "Zone" || ',' || service_zone
    WHEN 7 THEN "LocationID" || ',' || "Borough" || ',' || "Zone" || ',' || service_zone || ',more'
  END AS rejected
FROM ({_ZONE_LINES}) AS z
""",
        "next_weekday": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE)
  + CAST((l_linenumber - 1 - (isodow(l_shipdate) - 1) + 7) % 7 AS INTEGER) AS next_date
FROM lineitem
""",
    }
