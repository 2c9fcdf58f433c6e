"""Micro-batch sinks under which the last write of a key wins.

``foreachBatch`` may deliver a batch again after a failure, so a sink must not
count it twice. A keyed store gets that from its primary key; the Parquet sink
from one folder per batch, replaced as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.storage import create_empty, file_names
from tripmart.sources.versions import committed_versions

BatchWriter = Callable[[DataFrame, int], None]

KEY = ("window_start", "window_end", "zone")
BATCH = "batch_id="
SNAPSHOT = "upto="
BATCH_ENTRY, SNAPSHOT_ENTRY = "batch", "snapshot"


def keyed_store(source_format: str, options: Mapping[str, str]) -> BatchWriter:
    """Append to a store whose primary key makes an append an upsert."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(source_format).options(**options).mode("append").save()

    return write


class ForeignSink(ValueError):
    """The sink belongs to another streaming query."""


@dataclass(frozen=True)
class Ledger:
    """What a sink holds: the committed batches and snapshots of its one query."""

    query_id: str | None
    batches: tuple[int, ...]
    snapshot: int = -1


def _entry(query_id: str, kind: str, number: int) -> str:
    return f"{query_id}.{kind}.{number}"


def read_ledger(spark: SparkSession, path: str) -> Ledger:
    """The ledger under ``path``, from one listing of its entries.

    An entry is an empty file named after the query, its kind and its number, written
    after the data. Entries of two queries are an error: each counted from its own start.
    """
    entries = [name.rsplit(".", 2) for name in file_names(spark, f"{path}/ledger")]
    queries = sorted({query_id for query_id, _, _ in entries})
    if len(queries) > 1:
        raise ForeignSink(f"{path} holds batches of several queries: {', '.join(queries)}")
    if not queries and committed_versions(spark, f"{path}/batches", BATCH):
        raise ForeignSink(f"{path} was written without a ledger; which query did is unknown")
    snapshot = max((int(n) for _, kind, n in entries if kind == SNAPSHOT_ENTRY), default=-1)
    batches = sorted(int(n) for _, kind, n in entries if kind == BATCH_ENTRY and int(n) > snapshot)
    return Ledger(queries[0] if queries else None, tuple(batches), snapshot)


def _commit(spark: SparkSession, path: str, query_id: str, kind: str, number: int) -> None:
    create_empty(spark, f"{path}/ledger/{_entry(query_id, kind, number)}")


def running_query(spark: SparkSession) -> str:
    """Id of the streaming query whose batch this thread handles; ``none`` outside of one.

    The id is kept in the checkpoint, so a query that restarts has its own again.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def parquet_upserts(
    path: str, files_per_batch: int | None = None, compact_every: int | None = None
) -> BatchWriter:
    """Write each batch's changed counts to its own folder under ``path``.

    Each partition of the batch writes its own file. With ``files_per_batch`` an exchange
    moves the changed rows into that many. With ``compact_every`` the running job folds
    old batches into a snapshot whenever so many are there. A sink belongs to the query
    that wrote its first batch: one with a new checkpoint counts its batches from 0 again
    and is refused, and so is a batch that a snapshot already covers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = running_query(spark)
        ledger = read_ledger(spark, path)
        if ledger.query_id not in (None, query_id):
            raise ForeignSink(f"{path} belongs to query {ledger.query_id}, not to {query_id}")
        if batch_id <= ledger.snapshot:
            raise ForeignSink(f"{path} has folded batch {batch_id} into a snapshot already")
        changed = batch.repartition(files_per_batch, *KEY) if files_per_batch else batch
        changed.write.mode("overwrite").parquet(f"{path}/batches/{BATCH}{batch_id}")
        _commit(spark, path, query_id, BATCH_ENTRY, batch_id)
        if compact_every and len(ledger.batches) >= compact_every:
            compact_zone_counts(spark, path)

    return write


def _versioned_counts(
    spark: SparkSession, path: str, ledger: Ledger, upto: int | None = None
) -> DataFrame | None:
    """Newest snapshot and the committed batches after it, each row with its batch."""
    batches = [number for number in ledger.batches if upto is None or number <= upto]
    frames = []
    if ledger.snapshot >= 0:
        stored = spark.read.parquet(f"{path}/snapshots/{SNAPSHOT}{ledger.snapshot}")
        frames.append(stored.withColumn("batch_id", F.lit(ledger.snapshot).cast("bigint")))
    if batches:
        folders = [f"{path}/batches/{BATCH}{number}" for number in batches]
        changed = spark.read.option("basePath", f"{path}/batches").parquet(*folders)
        frames.append(changed.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    return reduce(DataFrame.unionByName, frames) if frames else None


def _latest(versioned: DataFrame) -> DataFrame:
    return versioned.groupBy(*KEY).agg(
        F.max_by("trip_count", "batch_id").alias("trip_count")
    )


def current_zone_counts(spark: SparkSession, path: str) -> DataFrame:
    """The last written count of every window and zone."""
    versioned = _versioned_counts(spark, path, read_ledger(spark, path))
    if versioned is None:
        raise FileNotFoundError(f"no zone counts under {path}")
    return _latest(versioned)


def compact_zone_counts(spark: SparkSession, path: str) -> int | None:
    """Fold all committed batches but the newest into a snapshot; return its last batch.

    The newest batch may still be delivered again, so it stays out. Folders that a
    snapshot covers are not read any more and may be deleted by the operator.
    """
    ledger = read_ledger(spark, path)
    if len(ledger.batches) < 2:
        return None
    upto = ledger.batches[-2]
    counts = _latest(_versioned_counts(spark, path, ledger, upto))
    counts.write.mode("overwrite").parquet(f"{path}/snapshots/{SNAPSHOT}{upto}")
    _commit(spark, path, ledger.query_id, SNAPSHOT_ENTRY, upto)
    return upto
