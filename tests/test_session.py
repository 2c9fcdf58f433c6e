from __future__ import annotations

from pathlib import Path

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def test_building_a_query_writes_nothing(spark, tmp_path, monkeypatch):
    """Facts and profiles keep no intermediate table on one machine."""
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    before = {*Path("/tmp").glob("tripmart-*")}
    for name in ("fact_star", "fact_unmatched_keys", "od_fallback"):
        entry.queries()[name](spark, SF_DIR)
    assert not [*tmp_path.iterdir()] and {*Path("/tmp").glob("tripmart-*")} == before
