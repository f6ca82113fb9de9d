from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.session import table_name
from tripmill.sinks.files import events, publish
from tripmill.sources import adapters
from tripmill.streaming import rides

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def event(seconds, zone=1, amount=10.0):
    at = int((NOON + timedelta(seconds=seconds)).timestamp() * 1000)
    return {"PULocationID": zone, "DOLocationID": 2, "trip_distance": 1.0,
            "total_amount": amount, "tpep_pickup_datetime": at}


class Stream:
    """A folder of event files that a query reads one per micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.count = rides.stream_session(spark, rides.INSTANCES), root, 0
        (root / "in").mkdir()

    def arrive(self, *batch):
        path = self.root / "in" / f"{self.count:04d}.json"
        path.write_text("\n".join(json.dumps(e) for e in batch))
        self.count += 1

    def source(self):
        return rides.source(self.spark, str(self.root / "in"), files_per_batch=1)

    def run(self, df, mode, sink):
        query = rides.writer(df, str(self.root / "checkpoint"), mode, bounded=True) \
            .foreachBatch(sink).start()
        query.awaitTermination()
        return query


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


@pytest.fixture
def hourly_sink(spark, tmp_path):
    name = table_name("hourly")
    rides.hourly_table(spark, name, str(tmp_path / name))
    return name


def windows(spark, name):
    return sorted((r.window_start.hour, r.PULocationID, r.num_trips, r.total_revenue)
                  for r in spark.table(name).collect())


def test_late_rows(spark, stream, hourly_sink):
    """On time, late with an open window, and late for a closed window."""
    sink = rides.upsert_sink(hourly_sink)
    df = rides.hourly(stream.source())
    dropped = 0
    for batch in ([event(0), event(3590)],
                  [event(3587)],                # 3 s late, window open
                  [event(3580, amount=1.0)],    # 10 s late, behind the watermark, window open
                  [event(3700)],                # moves the watermark past the first window
                  [event(3500, amount=99.0)]):  # its window has closed
        stream.arrive(*batch)
        dropped += rides.dropped_late(stream.run(df, "append", sink))
    stream.arrive(event(7300))
    stream.run(df, "append", sink)
    assert dropped == 1
    assert windows(spark, hourly_sink) == [(12, 1, 4, 31.0), (13, 1, 1, 10.0)]


def test_row_late_in_the_batch_that_closes_its_window_counts(spark, stream, hourly_sink):
    df = rides.hourly(stream.source())
    stream.arrive(event(0), event(3700), event(10))
    query = stream.run(df, "append", rides.upsert_sink(hourly_sink))
    assert rides.dropped_late(query) == 0
    assert windows(spark, hourly_sink) == [(12, 1, 2, 20.0)]


def test_update_mode_keeps_the_last_value(spark, stream, hourly_sink):
    df, sink = rides.hourly(stream.source()), rides.upsert_sink(hourly_sink)
    stream.arrive(event(0), event(5, zone=3, amount=2.5))
    stream.run(df, "update", sink)
    stream.arrive(event(60))
    stream.run(df, "update", sink)
    assert windows(spark, hourly_sink) == [(12, 1, 2, 20.0), (12, 3, 1, 2.5)]


def test_replayed_batch_changes_nothing(spark, tmp_path, hourly_sink):
    batch = rides.hourly(spark.createDataFrame([tuple(event(0).values())], schemas.RIDE))
    sink = rides.upsert_sink(hourly_sink)
    for _ in range(2):
        sink(batch, 7)
    assert windows(spark, hourly_sink) == [(12, 1, 1, 10.0)]
    path, append = str(tmp_path / "append"), rides.append_sink(str(tmp_path / "append"))
    for batch_id in (7, 7, 8):
        append(batch, batch_id)
    assert spark.read.parquet(path).count() == 2


def test_stream_equals_batch_twin(spark, sf, stream, hourly_sink):
    data = adapters.rides(spark, sf)
    publish(data, str(stream.root / "in"))
    stream.run(rides.hourly(stream.source(), watermark="60 days"), "update",
               rides.upsert_sink(hourly_sink))
    got = spark.table(hourly_sink).drop("window_date")
    want = rides.hourly(data)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_known_record_round_trip(spark):
    one = [(186, 79, 1.72, 17.31, 1730429702000)]
    df = spark.createDataFrame(one, schemas.RIDE)
    text = events(df).first().value
    assert json.loads(text) == {"PULocationID": 186, "DOLocationID": 79, "trip_distance": 1.72,
                                "total_amount": 17.31, "tpep_pickup_datetime": 1730429702000}
    decoded = events(df).select(rides.decode(F.encode("value", "UTF-8")).alias("r")).select("r.*")
    assert [tuple(r) for r in decoded.collect()] == one


def test_unreadable_message_gives_nulls(spark):
    row = spark.createDataFrame([(b"not json",)], "value binary").select(
        rides.decode("value").alias("r")).select("r.*").first()
    assert set(row) == {None}


def test_source_starts(spark, tmp_path):
    options = rides.kafka_source_options("b:9092", "rides", "latest", per_batch=100)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        rides.kafka_source_options("b:9092", "rides", "middle")
    with pytest.raises(ValueError):
        rides.source(spark, str(tmp_path), start="latest")


def test_rows_are_counted_beyond_a_hundred_batches(spark, stream):
    for n in range(130):
        stream.arrive(*[event(n)] * (1 + n % 2))
    with rides.counting(stream.spark) as counter:
        query = stream.run(rides.passed_through(stream.source()), "append",
                           lambda df, i: df.write.format("noop").mode("overwrite").save())
        assert counter.rows(query) == 195
    assert len(query.recentProgress) <= 100


def test_merges_of_a_stream_run_in_a_wide_session(spark, stream, hourly_sink, monkeypatch):
    seen = {}
    def upsert(rows, *args, **kwargs):
        conf = rows.sparkSession.conf
        seen["width"] = conf.get("spark.sql.shuffle.partitions")
        seen["adaptive"] = conf.get("spark.sql.adaptive.enabled")
    monkeypatch.setattr(rides.tables, "upsert", upsert)
    stream.arrive(event(0))
    stream.run(rides.hourly(stream.source()), "update", rides.upsert_sink(hourly_sink))
    assert seen["adaptive"] == "true" and int(seen["width"]) > rides.INSTANCES


def test_stream_session_sets_state_partitions_alone(spark, stream, hourly_sink):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream.arrive(event(0))
    query = stream.run(rides.hourly(stream.source()), "update", rides.upsert_sink(hourly_sink))
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    assert {op["numShufflePartitions"] for op in operators} == {rides.INSTANCES}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_batch_that_comes_again_is_left_out_by_the_ledger(spark, hourly_sink):
    def batch(amount):
        return rides.hourly(spark.createDataFrame(
            [tuple(event(0, amount=amount).values())], schemas.RIDE))
    sink = rides.upsert_sink(hourly_sink, "rides")
    sink(batch(10.0), 0)
    sink(batch(12.0), 1)
    sink(batch(99.0), 1)
    sink(batch(98.0), 0)
    assert windows(spark, hourly_sink) == [(12, 1, 1, 12.0)]
    assert rides.merged_batch(spark, hourly_sink, "rides") == 1
    rides.upsert_sink(hourly_sink, "other")(batch(5.0), 0)
    assert windows(spark, hourly_sink) == [(12, 1, 1, 5.0)]


def test_the_ledger_is_committed_with_the_rows(spark, hourly_sink, monkeypatch):
    batch = rides.hourly(spark.createDataFrame([tuple(event(0).values())], schemas.RIDE))
    sink = rides.upsert_sink(hourly_sink, "rides")
    for step, want in (("written", -1), ("recorded", 0)):
        with monkeypatch.context() as patch:
            def stop(reached, step=step):
                if reached == step:
                    raise RuntimeError(step)
            patch.setattr(rides.commits, "reached", stop)
            with pytest.raises(RuntimeError):
                sink(batch, 0)
        rides.commits.recover(spark, hourly_sink)
        assert rides.merged_batch(spark, hourly_sink, "rides") == want
    assert windows(spark, hourly_sink) == [(12, 1, 1, 10.0)]


def test_a_stream_names_itself_and_leaves_no_copies(spark, stream, hourly_sink, monkeypatch):
    root = stream.root / "shared"
    monkeypatch.setattr("tripmill.session.shared_root", lambda spark: str(root))
    counts = []
    for n in range(25):
        stream.arrive(event(n))
        query = stream.run(rides.hourly(stream.source()), "update",
                           rides.upsert_sink(hourly_sink))
        place = rides.commits.location(spark, hourly_sink).removeprefix("file:")
        counts.append(len(list(root.glob("*"))) + len(os.listdir(f"{place}-commits")))
    assert rides.merged_batch(spark, hourly_sink, str(query.id)) >= 24
    assert len(set(counts)) == 1


def test_late_rows_are_counted_beyond_a_hundred_batches(spark, stream):
    """The first row sets the watermark past the windows of all that follow.

    The bound for late rows is that of the batch before, so the second row still counts.
    """
    stream.arrive(event(7200))
    os.utime(stream.root / "in" / "0000.json", (1, 1))  # files are read in order of their times
    for n in range(130):
        stream.arrive(event(-3600 * 5))
    with rides.counting(stream.spark) as counter:
        query = stream.run(rides.hourly(stream.source()), "append",
                           lambda df, i: df.write.format("noop").mode("overwrite").save())
        assert counter.dropped_late(query) == 129
    assert rides.dropped_late(query) < 129
