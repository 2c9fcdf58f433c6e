"""Tables that a job both reads and replaces.

``replace_table`` keeps one folder that any reader may open: the new table is written
beside it, marked complete, and takes its place by a rename. ``write_next`` keeps numbered
versions, for readers that go through ``read_current``. In both, what counts is marked
after it is written. So a lost executor or a failed job never damages the current table,
whatever files the committer in use leaves behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.sources.files import read_if_exists
from tripmart.sources.storage import create_empty, folder_names, move, path_exists, remove

PREFIX = "version="
MARKER = "_COMMITTED"


def mark_committed(spark: SparkSession, folder: str) -> None:
    """Say that the folder is complete; readers of Parquet skip the marker."""
    create_empty(spark, f"{folder}/{MARKER}")


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return [
        int(name.removeprefix(prefix))
        for name in folder_names(spark, path)
        if name.startswith(prefix)
    ]


def committed_versions(
    spark: SparkSession, path: str, prefix: str = PREFIX, above: int = -1
) -> list[int]:
    """Numbers of the committed versions under ``path`` greater than ``above``, in order.

    Folders written before there was a marker count by their ``_SUCCESS`` file.
    """
    return sorted(
        number
        for number in _numbers(spark, path, prefix)
        if number > above
        and path_exists(spark, f"{path}/{prefix}{number}/{{{MARKER},_SUCCESS}}")
    )


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version; a table written without versions is read as it is."""
    versions = committed_versions(spark, path)
    if versions:
        return spark.read.parquet(f"{path}/{PREFIX}{versions[-1]}")
    return read_if_exists(spark, f"{path}/*.parquet")


def write_next(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as the next version and return the stored rows."""
    spark = df.sparkSession
    target = f"{path}/{PREFIX}{max(_numbers(spark, path, PREFIX), default=0) + 1}"
    df.write.parquet(target)
    mark_committed(spark, target)
    return spark.read.parquet(target)


def _beside(path: str, role: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{role}_{name}"


def settle_table(spark: SparkSession, path: str) -> None:
    """Finish a swap that a failure cut off between its two renames."""
    if path_exists(spark, path):
        return
    for role in ("next", "previous"):
        if path_exists(spark, f"{_beside(path, role)}/{MARKER}"):
            move(spark, _beside(path, role), path)
            return


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Make ``df``, which may read ``path``, the table at ``path``; return the stored rows.

    A plain read sees the old rows or the new ones, never both; between the two renames
    it finds no folder. The old table stays beside the new one until the next call. Where
    a rename copies, as in object stores, the swap takes as long as copying the table.
    """
    spark = df.sparkSession
    new, old = _beside(path, "next"), _beside(path, "previous")
    df.write.mode("overwrite").parquet(new)
    mark_committed(spark, new)
    if path_exists(spark, path):
        remove(spark, old)
        # A table of numbered versions has its markers inside.
        mark_committed(spark, path)
        move(spark, path, old)
    move(spark, new, path)
    return spark.read.parquet(path)
