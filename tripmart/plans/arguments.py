"""Command line shared by the monthly jobs."""

from __future__ import annotations

import argparse


def month_arguments(description: str, table: bool = False) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--root", default="/datalake", help="folder of the lake")
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, required=True)
    if table:
        parser.add_argument("--table", help="catalog table that lists the fact partitions")
    return parser.parse_args()
