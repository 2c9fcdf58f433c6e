"""How and when riders pay, from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import bad_money_count, money, money_sum


def payment_mix(fact: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Trips, their share and fares per payment type.

    The groups, one for each payment type and one for none, are folded to a row with their
    total and unfolded again, so the trips are read once. Fares without exact cents are
    counted as ``bad_fares`` and not summed.
    """
    per_type = fact.groupBy("payment_type_id").agg(
        F.count("*").alias("trip_count"),
        money_sum(F.col("fare_amount")).alias("fare_total"),
        bad_money_count(F.col("fare_amount")).alias("bad_fares"),
    )
    rows = F.collect_list(F.struct(*per_type.columns))
    folded = per_type.agg(F.sum("trip_count").alias("total"), rows.alias("rows"))
    return folded.select("total", F.inline("rows")).join(payment_types, "payment_type_id", "left").select(
        "payment_type_id",
        "payment_type_description",
        "trip_count",
        F.round(F.col("trip_count") / F.col("total"), 6).alias("share"),
        "fare_total",
        "bad_fares",
    )


def payment_by_calendar(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Trips and fares per payment type, month and day of week of the pickup.

    Trips are counted per date first; the calendar joins those counts only. Trips without
    a pickup date stay, with NULL calendar parts.
    """
    per_date = fact.groupBy("payment_type_id", "pickup_date").agg(
        F.count("*").alias("trips"),
        F.sum(money(F.col("fare_amount"))).alias("fares"),
        bad_money_count(F.col("fare_amount")).alias("bad"),
    )
    calendar = dates.select("date", F.col("month").alias("pickup_month"), "day_of_week")
    return (
        per_date.join(calendar, per_date["pickup_date"] == calendar["date"], "left")
        .groupBy("payment_type_id", "pickup_month", "day_of_week")
        .agg(
            F.sum("trips").alias("trip_count"),
            F.sum("fares").cast("double").alias("fare_total"),
            F.sum("bad").alias("bad_fares"),
        )
    )
