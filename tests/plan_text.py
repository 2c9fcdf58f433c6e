"""Plan of a frame as text."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    captured = io.StringIO()
    with redirect_stdout(captured):
        df.explain("formatted")
    return captured.getvalue()
