from __future__ import annotations

import json
import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException

from plan_text import plan_of
from rows import zone_lookup
from tripmart.operators.zone_windows import bucket_counts, sliding_counts, zone_enrich, zone_names
from tripmart.operators.messages import pickups
from tripmart.streaming import upserts
from tripmart.streaming.zone_counts import (
    kafka_options,
    message_stream,
    start_zone_counts,
    stream_zone_counts,
)

START = datetime(2025, 3, 1, 10, 0)


class Feed:
    """Folder of message files whose order is their modification time."""

    def __init__(self, folder):
        self.folder = folder
        folder.mkdir()
        self.files = 0

    def send(self, *events):
        lines = [
            json.dumps(
                {
                    "tpep_pickup_datetime": (START + timedelta(minutes=minute)).strftime(
                        "%Y-%m-%d %H:%M:%S"
                    ),
                    "PULocationID": str(zone),
                    "trip_distance": 1.5,
                }
            )
            for minute, zone in events
        ]
        target = self.folder / f"{self.files:04d}.json"
        target.write_text("\n".join(lines) + "\n")
        self.files += 1
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))


@pytest.fixture()
def feed(tmp_path):
    return Feed(tmp_path / "feed")


@pytest.fixture()
def zones(spark, tmp_path):
    """Zones of a stored lookup, whose size Spark knows."""
    path = str(tmp_path / "zones")
    zone_lookup(spark).write.parquet(path)
    return zone_names(spark.read.parquet(path))


def run(spark, feed, zones, write_batch, checkpoint):
    messages = message_stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(feed.folder))
    query = start_zone_counts(
        messages, zones, write_batch, str(checkpoint), trigger={"availableNow": True}
    )
    query.awaitTermination()


def counts_of(df):
    return Counter(
        {
            (int((r["window_start"] - START).total_seconds() // 60), r["zone"]): r["trip_count"]
            for r in df.collect()
        }
    )


def expected_counts(events, names={1: "Midtown", 2: "Corona", 3: "Corona"}):
    counts = Counter()
    for minute, zone in events:
        if zone in names:
            bucket = minute // 5 * 5
            for start in (bucket - 10, bucket - 5, bucket):
                counts[start, names[zone]] += 1
    return counts


def test_stream_batch_and_brute_force_agree(spark, feed, zones, tmp_path):
    source = random.Random(1)
    events = sorted(
        (source.randint(0, 239), source.choice([1, 1, 1, 2, 3, 40])) for _ in range(600)
    )
    for i in range(0, 600, 200):
        feed.send(*events[i : i + 200])
    run(spark, feed, zones, upserts.parquet_upserts(str(tmp_path / "out")), tmp_path / "check")

    expected = expected_counts(events)
    assert counts_of(upserts.current_zone_counts(spark, str(tmp_path / "out"))) == expected
    messages = spark.read.text(str(feed.folder))
    assert counts_of(stream_zone_counts(messages, zones)) == expected
    assert counts_of(sliding_counts(pickups(messages), zones)) == expected
    assert counts_of(bucket_counts(pickups(messages), zones)) == expected


def test_event_on_an_edge_is_in_three_windows(spark, feed, zones):
    feed.send((15, 1))
    messages = spark.read.text(str(feed.folder))
    expected = Counter({(5, "Midtown"): 1, (10, "Midtown"): 1, (15, "Midtown"): 1})
    assert counts_of(stream_zone_counts(messages, zones)) == expected
    row = stream_zone_counts(messages, zones).orderBy("window_start").first()
    assert row["window_end"] - row["window_start"] == timedelta(minutes=15)


def test_late_events_are_dropped_once_the_watermark_has_moved(spark, feed, zones, tmp_path):
    """Spark filters late rows by the watermark that the batch before had."""
    feed.send((0, 1), (120, 1))
    feed.send((121, 1))
    feed.send((110, 1), (10, 1))
    run(spark, feed, zones, upserts.parquet_upserts(str(tmp_path / "out")), tmp_path / "check")
    got = counts_of(upserts.current_zone_counts(spark, str(tmp_path / "out")))
    assert got == expected_counts([(0, 1), (120, 1), (121, 1), (110, 1)])


def test_only_changed_counts_reach_the_sink(spark, feed, zones, tmp_path):
    batches = []

    def collect(batch, batch_id):
        batches.append(counts_of(batch))

    feed.send((0, 1), (1, 2))
    feed.send((2, 2))
    run(spark, feed, zones, collect, tmp_path / "check")
    written = [b for b in batches if b]
    assert written == [
        expected_counts([(0, 1), (1, 2)]),
        Counter({(s, "Corona"): 2 for s in (-10, -5, 0)}),
    ]


def test_restart_continues_from_the_checkpoint(spark, feed, zones, tmp_path):
    sink = upserts.parquet_upserts(str(tmp_path / "out"), files_per_batch=2)
    feed.send((0, 1), (3, 2))
    run(spark, feed, zones, sink, tmp_path / "check")
    feed.send((4, 1))
    run(spark, feed, zones, sink, tmp_path / "check")
    got = counts_of(upserts.current_zone_counts(spark, str(tmp_path / "out")))
    assert got == expected_counts([(0, 1), (3, 2), (4, 1)])


def batch_of(spark, *rows):
    return spark.createDataFrame(
        [(START, START + timedelta(minutes=15), zone, count) for zone, count in rows],
        "window_start timestamp, window_end timestamp, zone string, trip_count bigint",
    )


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    write = upserts.parquet_upserts(path)
    write(batch_of(spark, ("a", 1), ("b", 1)), 0)
    write(batch_of(spark, ("a", 4)), 1)
    write(batch_of(spark, ("a", 4)), 1)
    assert counts_of(upserts.current_zone_counts(spark, path)) == {(0, "a"): 4, (0, "b"): 1}


def test_compaction_keeps_the_current_counts(spark, tmp_path):
    path = str(tmp_path / "out")
    write = upserts.parquet_upserts(path)
    write(batch_of(spark, ("a", 1), ("b", 1)), 0)
    assert upserts.compact_zone_counts(spark, path) is None
    for batch_id, count in ((1, 3), (2, 5), (10, 7)):
        write(batch_of(spark, ("a", count)), batch_id)
    before = counts_of(upserts.current_zone_counts(spark, path))
    assert upserts.compact_zone_counts(spark, path) == 2
    assert upserts.compact_zone_counts(spark, path) is None
    assert counts_of(upserts.current_zone_counts(spark, path)) == before
    write(batch_of(spark, ("b", 9)), 11)
    assert upserts.compact_zone_counts(spark, path) == 10
    assert counts_of(upserts.current_zone_counts(spark, path)) == {(0, "a"): 7, (0, "b"): 9}


def test_uncommitted_batch_is_not_read(spark, tmp_path):
    path = tmp_path / "out"
    upserts.parquet_upserts(str(path))(batch_of(spark, ("a", 1)), 0)
    (path / "batches" / "batch_id=1").mkdir()
    assert counts_of(upserts.current_zone_counts(spark, str(path))) == {(0, "a"): 1}


def test_keyed_store_appends_with_its_options(spark, tmp_path):
    path = str(tmp_path / "store")
    write = upserts.keyed_store("parquet", {"path": path})
    write(batch_of(spark, ("a", 1)), 0)
    write(batch_of(spark, ("a", 2)), 1)
    assert spark.read.parquet(path).count() == 2


def test_stream_join_without_broadcast_keeps_every_event(spark, feed, zones, tmp_path):
    feed.send((0, 1), (1, 2), (2, 40), (3, 1))
    messages = message_stream(spark, "text", {}, str(feed.folder))
    enriched = zone_enrich(pickups(messages), zones, shuffled=True)
    seen = Counter()

    def collect(batch, batch_id):
        seen.update(r["zone"] for r in batch.collect())

    enriched.writeStream.foreachBatch(collect).option(
        "checkpointLocation", str(tmp_path / "check")
    ).trigger(availableNow=True).start().awaitTermination()
    assert seen == {"Midtown": 2, "Corona": 1}


def test_rocksdb_state_gives_the_same_counts(spark, feed, zones, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(
        key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        feed.send((0, 1))
        feed.send((1, 1))
        sink = upserts.parquet_upserts(str(tmp_path / "out"))
        run(spark, feed, zones, sink, tmp_path / "check")
    finally:
        spark.conf.unset(key)
    got = counts_of(upserts.current_zone_counts(spark, str(tmp_path / "out")))
    assert got == expected_counts([(0, 1), (1, 1)])


def test_plan_parses_each_message_once_and_broadcasts_zones(spark, feed, zones):
    feed.send((0, 1))
    plan = plan_of(stream_zone_counts(spark.read.text(str(feed.folder)), zones))
    assert "BroadcastHashJoin" in plan and "LeftOuter" not in plan
    assert plan.count("from_json") == 1


def test_kafka_subscription_options():
    options = {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "trips",
        "startingOffsets": "latest",
    }
    assert kafka_options("host:1", "trips") == options
    bounded = kafka_options("host:1", "trips", max_offsets_per_trigger=500)
    assert bounded == options | {"maxOffsetsPerTrigger": "500"}


def test_a_new_checkpoint_is_refused(spark, feed, zones, tmp_path):
    """Its batches would count from 0 again and never be read."""
    path = str(tmp_path / "out")
    for minute in (0, 1, 2):
        feed.send((minute, 1))
    run(spark, feed, zones, upserts.parquet_upserts(path), tmp_path / "check")
    ledger = upserts.read_ledger(spark, path)
    assert ledger.query_id not in (None, "none") and ledger.batches[:3] == (0, 1, 2)
    assert upserts.compact_zone_counts(spark, path) is not None
    before = counts_of(upserts.current_zone_counts(spark, path))
    with pytest.raises(StreamingQueryException, match="belongs to query"):
        run(spark, feed, zones, upserts.parquet_upserts(path), tmp_path / "other")
    assert counts_of(upserts.current_zone_counts(spark, path)) == before
    feed.send((3, 1))
    run(spark, feed, zones, upserts.parquet_upserts(path), tmp_path / "check")
    assert counts_of(upserts.current_zone_counts(spark, path))[0, "Midtown"] == 4


def test_running_job_compacts_its_sink(spark, feed, zones, tmp_path):
    path = str(tmp_path / "out")
    events = [(minute, 1 + minute % 2) for minute in range(9)]
    for event in events:
        feed.send(event)
    run(spark, feed, zones, upserts.parquet_upserts(path, compact_every=3), tmp_path / "check")
    ledger = upserts.read_ledger(spark, path)
    assert ledger.snapshot >= 5 and len(ledger.batches) <= 4
    assert counts_of(upserts.current_zone_counts(spark, path)) == expected_counts(events)


def test_failed_batch_is_replayed_after_a_compaction(spark, feed, zones, tmp_path):
    path = str(tmp_path / "out")
    write = upserts.parquet_upserts(path)
    events = [(0, 1), (1, 1), (2, 2)]
    for event in events:
        feed.send(event)

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            upserts.compact_zone_counts(spark, path)
            raise OSError("lost after the write")

    with pytest.raises(StreamingQueryException):
        run(spark, feed, zones, failing, tmp_path / "check")
    assert upserts.read_ledger(spark, path).snapshot == 1
    run(spark, feed, zones, write, tmp_path / "check")
    assert counts_of(upserts.current_zone_counts(spark, path)) == expected_counts(events)


def test_ledger_refuses_what_it_cannot_place(spark, tmp_path):
    path = str(tmp_path / "out")
    write = upserts.parquet_upserts(path)
    for batch_id in range(3):
        write(batch_of(spark, ("a", batch_id)), batch_id)
    assert upserts.compact_zone_counts(spark, path) == 1
    with pytest.raises(upserts.ForeignSink, match="batch 1"):
        write(batch_of(spark, ("a", 9)), 1)
    (tmp_path / "out" / "ledger" / "another.batch.0").touch()
    with pytest.raises(upserts.ForeignSink, match="several"):
        upserts.current_zone_counts(spark, path)
    old = tmp_path / "old"
    batch_of(spark, ("a", 1)).write.parquet(str(old / "batches" / "batch_id=0"))
    with pytest.raises(upserts.ForeignSink, match="without a ledger"):
        upserts.current_zone_counts(spark, str(old))
    with pytest.raises(FileNotFoundError):
        upserts.current_zone_counts(spark, str(tmp_path / "none"))
