"""Job: bronze -> silver for one month.

    spark-submit --py-files tripmart.zip tripmart/plans/silver.py \\
        --root /datalake --year 2025 --month 1
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tripmart.operators.conform import union_services
from tripmart.plans.arguments import month_arguments
from tripmart.session import build_session
from tripmart.sources.files import read_bronze
from tripmart.sources.paths import LakePaths
from tripmart.sources.sinks import overwrite


@dataclass(frozen=True)
class SilverResult:
    path: str
    services: tuple[str, ...]
    missing: tuple[str, ...]


def build_silver(spark: SparkSession, paths: LakePaths, year: int, month: int) -> SilverResult:
    """Clean and union the month's services; a missing file is reported, not hidden.

    Any other problem of a service, and a month with no file at all, is an error.
    """
    found, missing = read_bronze(spark, paths, year, month)
    if not found:
        raise FileNotFoundError(f"no trip file of {year}-{month:02d} for any of {missing}")
    target = paths.silver(year, month)
    overwrite(union_services(found), target)
    return SilverResult(target, tuple(found), tuple(missing))


def main() -> None:
    arguments = month_arguments("Clean one month of trips")
    spark = build_session("silver")
    print(build_silver(spark, LakePaths(arguments.root), arguments.year, arguments.month))
    spark.stop()


if __name__ == "__main__":
    main()
