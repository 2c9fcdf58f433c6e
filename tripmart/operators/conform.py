"""Bronze -> silver: one column layout for all services, invalid trips out.

Every step is narrow, so the whole layer is one map-only stage per service.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import whole_number
from tripmart.schemas import REQUIRED_COLUMNS, SILVER_TYPES, TIME_COLUMNS, TIME_PREFIXES


def unify_time_names(raw: DataFrame) -> DataFrame:
    """Drop the service prefix from the two trip time columns."""
    present = [p for p in TIME_PREFIXES if f"{p}{TIME_COLUMNS[0]}" in raw.columns]
    if not present:
        return raw
    return raw.withColumnsRenamed({f"{present[0]}{name}": name for name in TIME_COLUMNS})


def conform(raw: DataFrame, *extra: Column) -> DataFrame:
    """Project to the silver columns and types; a value that does not fit is NULL.

    ``extra`` columns are appended as they are. A missing column is an error.
    """
    named = unify_time_names(raw)
    texts = {name for name, source_type in named.dtypes if source_type == "string"}

    def typed(name: str, sql_type: str | None) -> Column:
        column = F.col(name)
        if sql_type is None:
            return column
        if sql_type == "bigint" and name in texts:
            return whole_number(column, sql_type).alias(name)
        return column.try_cast(sql_type).alias(name)

    return named.select(*[typed(*contract) for contract in SILVER_TYPES.items()], *extra)


def _present(df: DataFrame, name: str) -> Column:
    """Neither NULL nor NaN, as predicates that a Parquet scan accepts."""
    column = F.col(name)
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def drop_incomplete(df: DataFrame, columns: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Keep rows in which each of ``columns`` has a value."""
    return df.filter(reduce(Column.__and__, [_present(df, name) for name in columns]))


def valid_trips(conformed: DataFrame) -> DataFrame:
    """Trips with a distance, a passenger and all required columns."""
    moved = conformed.filter((F.col("trip_distance") > 0) & (F.col("passenger_count") > 0))
    return drop_incomplete(moved)


def _scan_filter(raw: DataFrame) -> DataFrame:
    """Repeat the passenger rule on the raw column, where the scan can use it.

    A fractional count truncates to at least 1 exactly when it is at least 1.
    The rule on the cast column stays; this one only lets row groups be skipped.
    """
    if raw.schema["passenger_count"].dataType.typeName() in ("double", "float", "decimal"):
        return raw.filter(F.col("passenger_count") >= 1)
    return raw


def silver_trips(raw: DataFrame, service: str | Column) -> DataFrame:
    """Clean trips of one service, tagged with its name."""
    tag = F.lit(service) if isinstance(service, str) else service
    return valid_trips(conform(_scan_filter(raw), tag.alias("service_type")))


def union_services(raw_by_service: Mapping[str, DataFrame]) -> DataFrame:
    """Silver trips of all services; duplicates stay."""
    frames = [silver_trips(raw, service) for service, raw in raw_by_service.items()]
    return reduce(DataFrame.unionByName, frames)
