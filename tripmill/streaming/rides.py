"""Ride event stream: source, event time, hourly windows and sinks."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tripmill import schemas
from tripmill.functions.exact import exact_sum
from tripmill.functions.temporal import from_epoch_ms
from tripmill.session import ensure_session
from tripmill.sinks import commits, tables

# Lateness bound, window length, checkpoint pace and parallel instances.
LATENESS = "5 seconds"
WINDOW = "1 hour"
CHECKPOINT_EVERY = "10 seconds"
INSTANCES = 3

STARTS = ("earliest", "latest")


def decode(value: Column | str) -> Column:
    """JSON bytes to a ride struct; a message that does not parse gives nulls."""
    value = F.col(value) if isinstance(value, str) else value
    return F.from_json(F.decode(value, "UTF-8"), schemas.RIDE)


def kafka_source_options(servers: str, topic: str, start: str = "earliest",
                         per_batch: int | None = None) -> dict[str, str]:
    """Options of a topic source; ``per_batch`` bounds the events of one micro-batch."""
    if start not in STARTS:
        raise ValueError(f"start must be one of {STARTS}, not {start}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def source(spark: SparkSession, path: str | None = None, kafka: Mapping[str, str] | None = None,
           start: str = "earliest", files_per_batch: int | None = None) -> DataFrame:
    """Stream of rides from a topic, or from a folder of JSON lines when ``path`` is given.

    A folder is always read from its first file on: it has no notion of latest.
    """
    if path is None:
        raw = spark.readStream.format("kafka").options(**kafka).load()
        return raw.select(decode("value").alias("ride")).select("ride.*")
    if start != "earliest":
        raise ValueError("a folder can only be read from the earliest file")
    reader = spark.readStream.schema(schemas.RIDE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def with_event_time(rides: DataFrame) -> DataFrame:
    return rides.withColumn("event_timestamp", from_epoch_ms("tpep_pickup_datetime"))


def passed_through(rides: DataFrame) -> DataFrame:
    """Rides with the pickup instant as a timestamp; no state, no shuffle."""
    return rides.select("PULocationID", "DOLocationID", "trip_distance", "total_amount",
                        from_epoch_ms("tpep_pickup_datetime").alias("pickup_datetime"))


def hourly(rides: DataFrame, watermark: str | None = LATENESS) -> DataFrame:
    """Trips and revenue per hour and pickup zone; the same for streams and bounded input.

    State is one row per open window and zone. Rows combine inside each task before the shuffle,
    so a busy zone does not weigh on one state partition.
    """
    timed = with_event_time(rides)
    if rides.isStreaming and watermark:
        timed = timed.withWatermark("event_timestamp", watermark)
    grouped = timed.groupBy(F.window("event_timestamp", WINDOW).alias("w"), "PULocationID").agg(
        F.count(F.lit(1)).alias("num_trips"), exact_sum("total_amount").alias("total_revenue"))
    return grouped.select(F.col("w.start").alias("window_start"), "PULocationID", "num_trips",
                          "total_revenue")


def writer(df: DataFrame, checkpoint: str, mode: str = "append",
           bounded: bool = False) -> DataStreamWriter:
    """Writer that records offsets and state in ``checkpoint``.

    Long-running queries trigger every ten seconds; ``bounded`` ones stop once the input at hand
    is processed.
    """
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if bounded:
        return out.trigger(availableNow=True)
    return out.trigger(processingTime=CHECKPOINT_EVERY)


def to_files(df: DataFrame, path: str, checkpoint: str, bounded: bool = False) -> StreamingQuery:
    """Append to a Parquet folder whose log makes each batch visible exactly once."""
    return writer(df, checkpoint, "append", bounded).format("parquet").option("path", path).start()


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function that writes each micro-batch to its own partition.

    A replayed batch overwrites its earlier attempt instead of adding rows twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return write


# Table property that names the last batch of a stream that was merged.
LEDGER = "merged-batch.{}"

# Fixed value: where a running stream notes its id for the jobs it starts.
QUERY_ID = "sql.streaming.queryId"


def merged_batch(spark: SparkSession, table: str, stream: str) -> int:
    """Number of the last batch of a stream that a keyed table holds, -1 before the first."""
    return int(commits.properties(spark, table).get(LEDGER.format(stream), -1))


def upsert_sink(table: str, stream: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function that keeps the last value per window and zone in a keyed table.

    The table is partitioned by the date of the window, which the key fixes, so a batch rewrites
    the dates of its windows only. The number of the batch is committed with its rows, so a batch
    that comes again is left out. ``stream`` names the sender; by default it is the id of the query,
    which its checkpoint keeps. The batch is stored once in the shared folder, so the state is
    updated once, and deleted after the commit. A session of its own merges it: the stream's session
    has the narrow width of its state and no adaptive planning.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session = ensure_session(batch.sparkSession.newSession())
        sender = stream or session.sparkContext.getLocalProperty(QUERY_ID)
        commits.recover(session, table)
        if sender and merged_batch(session, table, sender) >= batch_id:
            return
        dated = batch.withColumn("window_date", F.to_date("window_start"))
        ledger = {LEDGER.format(sender): str(batch_id)} if sender else None
        with tables.stored(dated, f"{table}-batch-{batch_id}", session) as rows:
            tables.upsert(rows, table, ["window_start", "PULocationID"], "window_date",
                          key_fixes_partition=True, is_stored=True, settings=ledger)
    return write


def hourly_table(spark: SparkSession, table: str, path: str) -> None:
    """Empty keyed sink of the hourly aggregate, unless it exists."""
    empty = spark.createDataFrame(
        [], "window_start timestamp, PULocationID int, num_trips bigint, total_revenue double, "
            "window_date date")
    fields = empty.schema.fields
    tables.create_if_absent(spark, table, type(empty.schema)(fields[:-1]), path, fields[-1:])


def stream_session(spark: SparkSession, instances: int | None = None) -> SparkSession:
    """Session to build a stream in, with ``instances`` state partitions; the given one is left
    as it is.

    State is never re-partitioned: the first run of a checkpoint fixes the number, so size it for
    the peak. By default there are as many as tasks the cluster runs at once.
    """
    session = ensure_session(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions",
                     instances or spark.sparkContext.defaultParallelism)
    return session


def dropped_late(query: StreamingQuery) -> int:
    """Late rows dropped in the reports a query keeps, its last hundred; ``RowCounter`` has all."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for progress in query.recentProgress
               for op in progress["stateOperators"])


class RowCounter(StreamingQueryListener):
    """Adds up over every micro-batch the rows read and the rows dropped because they were late.

    A query itself keeps only its last hundred reports.
    """

    def __init__(self) -> None:
        self._rows: dict[str, int] = {}
        self._late: dict[str, int] = {}
        self._ended = threading.Condition()
        self._over: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self._rows[run] = self._rows.get(run, 0) + event.progress.numInputRows
        self._late[run] = self._late.get(run, 0) + sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        with self._ended:
            self._over.add(str(event.runId))
            self._ended.notify_all()

    def _total(self, totals: dict[str, int], query: StreamingQuery, timeout: float) -> int:
        run = str(query.runId)
        with self._ended:
            if not self._ended.wait_for(lambda: run in self._over, timeout):
                raise TimeoutError(f"no end of query run {run} was reported")
        return totals.get(run, 0)

    def rows(self, query: StreamingQuery, timeout: float = 60) -> int:
        """Rows of a query that has ended; waits until its last report is in."""
        return self._total(self._rows, query, timeout)

    def dropped_late(self, query: StreamingQuery, timeout: float = 60) -> int:
        """Rows of a query that has ended which were dropped because their window had closed."""
        return self._total(self._late, query, timeout)


@contextmanager
def counting(spark: SparkSession) -> Iterator[RowCounter]:
    """A row counter for the queries of a session that start inside."""
    counter = RowCounter()
    spark.streams.addListener(counter)
    try:
        yield counter
    finally:
        spark.streams.removeListener(counter)


def from_rows(trips: DataFrame, pickup: str = "tpep_pickup_datetime") -> DataFrame:
    """Trip rows as typed ride events."""
    kinds = {f.name: f.dataType for f in schemas.RIDE.fields}
    plain = [F.col(n).cast(t).alias(n) for n, t in kinds.items() if n != "tpep_pickup_datetime"]
    return trips.select(*plain, F.unix_millis(pickup).alias("tpep_pickup_datetime"))
