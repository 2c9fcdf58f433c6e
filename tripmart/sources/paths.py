"""Where each table of the lake lies. The month is an int everywhere."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    root: str

    def bronze_files(self, service: str, year: int, month: int) -> tuple[str, str]:
        """Where a service's month may lie: the folder is named 1 or 01, the file 01."""
        name = f"{service}_tripdata_{year}-{month:02d}.parquet"
        return tuple(
            f"{self.root}/bronze/{year}/{folder}/{name}" for folder in (month, f"{month:02d}")
        )

    @property
    def zone_lookup(self) -> str:
        return f"{self.root}/bronze/taxi_zone_lookup/taxi_zone_lookup.csv"

    def silver(self, year: int, month: int) -> str:
        return f"{self.root}/silver/{year}/{month}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def fact_partition(self, year: int, month: int) -> str:
        return f"{self.gold('fact_trips')}/year={year}/month={month}"
