"""Job: the whole batch path of one month, bronze -> silver -> gold -> catalog.

    spark-submit --py-files tripmart.zip tripmart/plans/month.py \\
        --root /datalake --year 2025 --month 1 --table fact_trips
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.plans.arguments import month_arguments
from tripmart.plans.gold import build_gold
from tripmart.plans.silver import SilverResult, build_silver
from tripmart.session import build_session
from tripmart.sources.paths import LakePaths


def build_month(
    spark: SparkSession,
    paths: LakePaths,
    year: int,
    month: int,
    zone_lookup: DataFrame | None = None,
    table: str | None = None,
) -> SilverResult:
    """Silver first; gold runs only when it succeeded."""
    result = build_silver(spark, paths, year, month)
    build_gold(spark, paths, year, month, zone_lookup, table)
    return result


def main() -> None:
    arguments = month_arguments("Build silver and gold of one month", table=True)
    spark = build_session("month")
    paths = LakePaths(arguments.root)
    print(build_month(spark, paths, arguments.year, arguments.month, table=arguments.table))
    spark.stop()


if __name__ == "__main__":
    main()
