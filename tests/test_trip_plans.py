"""What the trip queries move between tasks, on small tables of their own."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

import pytest

import __spark_entry__ as driver
from plan_text import plan_of
from tripmart import fixtures, stored_queries

ROWS = {
    "region": [(0, "ASIA"), (1, "EUROPE")],
    "nation": [(0, "JAPAN", 0), (1, "FRANCE", 1)],
    "customer": [(10, "Ann", 0, 1.0, "BUILDING"), (11, "Ben", 5, 1.0, "MACHINERY")],
    "supplier": [(20, "S", 1, 1.0)],
    "orders": [
        (1, 10, "O", 100.0, datetime(2025, 3, 1), "1-URGENT"),
        (2, 11, "O", 200.0, datetime(2025, 9, 1), "9-NONE"),
        (3, None, "O", 300.0, datetime(2025, 9, 1), "1-URGENT"),
    ],
    "lineitem": [
        (1, 30, 20, 1, 2.0, 10.0, 0.5, 0.01, "N", "F", datetime(2025, 3, 5)),
        (1, 30, 20, 3, 2.0, 20.0, 0.5, 0.08, "N", "O", datetime(2025, 3, 6)),
        (2, 30, 20, 2, 3.0, 30.0, 0.5, 0.02, "R", "O", datetime(2025, 9, 1)),
        (2, 30, 20, 2, 3.0, 30.0, 0.5, 0.02, "R", "O", datetime(2025, 9, 1)),
        (2, 30, None, 2, 3.0, 40.0, 0.5, 0.02, "R", "O", datetime(2025, 9, 1)),
        (3, 30, 20, 2, 3.0, 50.0, 0.5, 0.02, "R", "O", datetime(2025, 9, 1)),
        (2, 30, 20, 2, 3.0, 60.0, 0.0, 0.02, "R", "O", datetime(2025, 9, 1)),
    ],
}
SCHEMAS = fixtures.TABLES


@pytest.fixture()
def tables(spark, tmp_path):
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def stored_keys(df):
    names = ("phonenumber", "vendor_id", "ratecode_id", "payment_type_id", "pickup_location_id")
    return Counter((*(r[n] for n in names), str(r["pickup_date"]), r["fare_amount"]) for r in df.collect())


ANN = ("10", 1, 1, 1, 0, "2025-03-01", 10.0)
ANN_UNKNOWN = ("10", None, None, 1, 0, "2025-03-01", 20.0)
BEN = ("11", 2, 2, None, None, "2025-09-01", 30.0)


def exchanges(plan):
    """The details of each exchange: its input columns and how it deals them."""
    details = [part for part in plan.split("\n\n") if "\nArguments: hashpartitioning" in part]
    assert details
    return details


def test_lines_and_orders_travel_apart(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fixtures.trips(spark, tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [part for part in exchanges(plan) if "l_tax" in part and "o_totalprice" in part]


def test_months_do_not_join_the_trips_again(spark, tables, monkeypatch):
    """Months of a job, the second one twice, all from one join of the tables."""
    plans, months = [], stored_queries._month_of

    def month_of(trips, month):
        plans.append(plan_of(trips))
        return months(trips, month)

    monkeypatch.setattr(stored_queries, "_month_of", month_of)
    jobs = ("gold_catalog_months", "gold_two_months", "gold_dates_appended", "gold_customers_read")
    read = {name: driver.queries()[name](spark, tables) for name in jobs}
    assert len(plans) >= 2 * len(jobs)
    assert not [plan for plan in plans if "Join" in plan or "lineitem" in plan]
    for name in jobs[:2]:
        assert stored_keys(read[name]) == Counter({ANN: 1, ANN_UNKNOWN: 1, BEN: 2})
        assert {r["month"] for r in read[name].collect()} == {1, 2}
    assert read["gold_dates_appended"].count() == 4
    names = {r["phonenumber"]: r["full_name"] for r in read["gold_customers_read"].collect()}
    assert names == {"10": "Ann", "11": "Later Ben"}


def test_no_join_to_a_dimension_moves_the_trips(spark, tables):
    """The dates too, though Spark takes those derived from trips for large ones."""
    star = driver.queries()["fact_star_salted"](spark, tables)
    plan = plan_of(star)
    assert "SortMergeJoin" not in plan
    assert not [part for part in plan.split("\n\n") if "hashpartitioning" in part and "l_tax" in part]
    assert stored_keys(star) == Counter({ANN: 1, ANN_UNKNOWN: 1, BEN: 2})
