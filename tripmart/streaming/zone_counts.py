"""Job: count trips per zone over sliding windows, from a stream of trip events.

    KAFKA_BOOTSTRAP=host:9092 CASSANDRA_HOST=host spark-submit \\
        --py-files tripmart.zip tripmart/streaming/zone_counts.py \\
        --zones zones.csv --checkpoint /shared/zone_counts

Connector packages are given to spark-submit; this module only names the formats.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tripmart.operators.messages import pickups
from tripmart.operators.zone_windows import EVENT_TIME, zone_counts, zone_names
from tripmart.schemas import WATERMARK
from tripmart.session import build_session
from tripmart.sources.files import read_zone_lookup
from tripmart.streaming.upserts import BatchWriter, keyed_store, parquet_upserts


def kafka_options(
    bootstrap: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Subscription to one topic; the maximum bounds the batch after a long stop."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def message_stream(
    spark: SparkSession, source_format: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """Stream of messages with a ``value`` column."""
    return spark.readStream.format(source_format).options(**options).load(path)


def stream_zone_counts(
    messages: DataFrame, zones: DataFrame, lateness: str = WATERMARK
) -> DataFrame:
    """Decode, bound the lateness, count. ``messages`` may also be a batch."""
    events = pickups(messages).withWatermark(EVENT_TIME, lateness)
    return zone_counts(events, zones)


def start_zone_counts(
    messages: DataFrame,
    zones: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    lateness: str = WATERMARK,
) -> StreamingQuery:
    """Start the stream; each batch hands only the changed counts to ``write_batch``.

    A restart with the same ``checkpoint`` continues where the last batch ended.
    """
    writer = (
        stream_zone_counts(messages, zones, lateness)
        .writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def main() -> None:
    parser = argparse.ArgumentParser(description="Count trips per zone from a message stream")
    parser.add_argument("--zones", required=True, help="zone lookup CSV")
    parser.add_argument("--checkpoint", required=True, help="shared folder for offsets and state")
    parser.add_argument("--topic", default="taxi-stream")
    parser.add_argument("--max-offsets", type=int, help="most messages in one batch")
    parser.add_argument("--parquet-sink", help="write here instead of to the keyed store")
    parser.add_argument(
        "--compact-every", type=int, default=100, help="fold the Parquet sink at so many batches"
    )
    arguments = parser.parse_args()

    spark = build_session(
        "zone-counts",
        spark__cassandra__connection__host=os.environ["CASSANDRA_HOST"],
        spark__cassandra__connection__port=os.getenv("CASSANDRA_PORT", "9042"),
        # Keeps window state off the executor heap.
        spark__sql__streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    )
    bootstrap = os.environ["KAFKA_BOOTSTRAP"]
    options = kafka_options(
        bootstrap, arguments.topic, max_offsets_per_trigger=arguments.max_offsets
    )
    messages = message_stream(spark, "kafka", options)
    zones = zone_names(read_zone_lookup(spark, arguments.zones))
    sink = (
        parquet_upserts(arguments.parquet_sink, compact_every=arguments.compact_every)
        if arguments.parquet_sink
        else keyed_store(
            "org.apache.spark.sql.cassandra", {"keyspace": "taxi", "table": "zone_counts"}
        )
    )
    start_zone_counts(messages, zones, sink, arguments.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
