"""Streaming jobs, run to the end of the input at hand and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.catalog.prelude import total
from tripmill.catalog.registry import query
from tripmill.session import table_name, workspace
from tripmill.sinks.files import publish
from tripmill.sources import adapters
from tripmill.streaming import rides

_PASSED = """
SELECT PULocationID, DOLocationID, trip_distance, total_amount,
  make_timestamp(tpep_pickup_datetime * 1000) AS pickup_datetime FROM rides"""
_HOURLY = f"""
SELECT date_trunc('hour', make_timestamp(tpep_pickup_datetime * 1000)) AS window_start,
  PULocationID, count(*) AS num_trips, {total('total_amount')} AS total_revenue
FROM rides GROUP BY 1, 2"""
# Windows a five-second watermark has closed by the end of the input.
_CLOSED = f"""
SELECT * FROM ({_HOURLY}) WHERE window_start + INTERVAL 1 HOUR
  <= (SELECT make_timestamp(max(tpep_pickup_datetime) * 1000) FROM rides) - INTERVAL 5 SECOND"""


def _events(spark, d, instances=None):
    """The rides as JSON lines, and a stream over them in a session of its own."""
    path = workspace(spark, "ride-events")
    publish(adapters.rides(spark, d), path)
    return rides.source(rides.stream_session(spark, instances), path)


def _run(query):
    query.awaitTermination()
    return query


def _through_files(spark, df, label, out=None, checkpoint=None):
    out = out or workspace(spark, label)
    _run(rides.to_files(df, out, checkpoint or workspace(spark, f"{label}-checkpoint"),
                        bounded=True))
    return spark.read.schema(df.schema).parquet(out)


def _through_batches(df, checkpoint, mode, sink):
    _run(rides.writer(df, checkpoint, mode, bounded=True).foreachBatch(sink).start())


@query("src_stream_json", "SELECT * FROM rides")
def src_stream_json(spark, d):
    return _through_files(spark, _events(spark, d), "stream-json")


_HALVES = """
, halves AS (SELECT *, tpep_pickup_datetime >= (SELECT (min(tpep_pickup_datetime)
  + max(tpep_pickup_datetime)) // 2 FROM rides) AS later FROM rides)"""


def _by_time(spark, d):
    """Rides of the earlier and of the later half of the time they span."""
    events = adapters.rides(spark, d)
    at = F.col("tpep_pickup_datetime")
    first, last = events.agg(F.min(at), F.max(at)).first()
    middle = F.lit((first + last) // 2 if first is not None else 0)
    return events.where(at < middle), events.where(at >= middle)


@query("src_stream_offsets", _HALVES + """
SELECT later, count(*) AS n FROM halves GROUP BY 1""")
def src_stream_offsets(spark, d):
    """From the earliest file, then from where a checkpoint stands.

    The second run must take only files that arrived in between. Starting from the latest offset
    needs a broker: a folder has no such notion.
    """
    earlier, later = _by_time(spark, d)
    path, out = workspace(spark, "ride-events"), workspace(spark, "stream-offsets")
    checkpoint = workspace(spark, "offsets-checkpoint")
    publish(earlier, path)
    session = rides.stream_session(spark)
    found = []
    for is_later in (False, True):
        if is_later:
            later.select(F.to_json(F.struct("*"))).write.mode("append").text(path)
        stream = rides.source(session, path, start="earliest", files_per_batch=4)
        batch = f"{out}/{is_later}"
        _run(rides.writer(stream, checkpoint, "append", bounded=True)
             .foreachBatch(rides.append_sink(batch)).start())
        found.append(spark.read.schema(stream.schema).parquet(batch)
                     .withColumn("later", F.lit(is_later)))
    return found[0].unionByName(found[1]).groupBy("later").agg(F.count(F.lit(1)).alias("n"))


@query("stm_pass_through", _PASSED)
def stm_pass_through(spark, d):
    return _through_files(spark, rides.passed_through(_events(spark, d)), "pass-through")


@query("stm_event_time", """
SELECT *, make_timestamp(tpep_pickup_datetime * 1000) AS event_timestamp FROM rides""")
def stm_event_time(spark, d):
    return _through_files(spark, rides.with_event_time(_events(spark, d)), "event-time")


@query("stm_watermark", _CLOSED)
def stm_watermark(spark, d):
    """Append mode: only windows the watermark has closed are written."""
    return _through_files(spark, rides.hourly(_events(spark, d)), "watermark")


@query("stm_tumbling", _HOURLY)
def stm_tumbling(spark, d):
    """Update mode: every window is written with its latest value."""
    return _keyed(spark, _events(spark, d), "tumbling")


def _keyed(spark, stream, label):
    name = table_name("hourly")
    rides.hourly_table(spark, name, workspace(spark, label))
    _through_batches(rides.hourly(stream), workspace(spark, f"{label}-checkpoint"), "update",
                     rides.upsert_sink(name))
    return spark.table(name).drop("window_date")


@query("stm_upsert_sink", _HOURLY)
def stm_upsert_sink(spark, d):
    """The same events in several micro-batches; open windows are written again and again."""
    path = workspace(spark, "ride-events")
    events = adapters.rides(spark, d)
    # Files in event order, so that nothing is late when they arrive one after the other.
    publish(events.repartitionByRange(4, "tpep_pickup_datetime"), path)
    files = sorted(spark.read.text(path).inputFiles())
    name = table_name("hourly")
    rides.hourly_table(spark, name, workspace(spark, "upsert"))
    checkpoint = workspace(spark, "upsert-checkpoint")
    arrivals = workspace(spark, "arrivals")
    session = rides.stream_session(spark)
    for file in files:
        spark.read.text(file).write.mode("append").text(arrivals)
        _through_batches(rides.hourly(rides.source(session, arrivals)), checkpoint, "update",
                         rides.upsert_sink(name))
    return spark.table(name).drop("window_date")


_LATE = "DOLocationID % 7 = 0"


@query("stm_late_data", _HALVES + f"""
SELECT date_trunc('hour', make_timestamp(tpep_pickup_datetime * 1000)) AS window_start,
  PULocationID, count(*) AS num_trips, {total('total_amount')} AS total_revenue
FROM halves WHERE (later OR NOT coalesce({_LATE}, false))
  AND date_trunc('hour', make_timestamp(tpep_pickup_datetime * 1000)) + INTERVAL 1 HOUR
    <= (SELECT make_timestamp(max(tpep_pickup_datetime) * 1000) FROM rides) - INTERVAL 5 SECOND
GROUP BY 1, 2""")
def stm_late_data(spark, d):
    """Three arrivals: the earlier half without some rows, the later half, then those rows.

    When they come, the watermark has passed their windows, so they are dropped and nothing else is.
    """
    earlier, later = _by_time(spark, d)
    late = F.coalesce(F.expr(_LATE), F.lit(False))
    path, out = workspace(spark, "ride-events"), workspace(spark, "late")
    checkpoint, session = workspace(spark, "late-checkpoint"), rides.stream_session(spark)
    for n, rows in enumerate((earlier.where(~late), later, earlier.where(late))):
        mode = "append" if n else "errorifexists"
        rows.select(F.to_json(F.struct("*"))).write.mode(mode).text(path)
        found = _through_files(spark, rides.hourly(rides.source(session, path)), "late", out,
                               checkpoint)
    return found


@query("stm_append_sink", _PASSED)
def stm_append_sink(spark, d):
    out = workspace(spark, "append-sink")
    stream = rides.passed_through(_events(spark, d))
    _through_batches(stream, workspace(spark, "append-checkpoint"), "append",
                     rides.append_sink(out))
    return spark.read.parquet(out).drop("batch_id")


@query("stm_checkpoint", "SELECT count(*) AS n FROM rides")
def stm_checkpoint(spark, d):
    """A second run from the same checkpoint finds nothing left to do."""
    stream = rides.passed_through(_events(spark, d))
    out, checkpoint = workspace(spark, "resumed"), workspace(spark, "resumed-checkpoint")
    for _ in range(2):
        _run(rides.to_files(stream, out, checkpoint, bounded=True))
    return spark.read.schema(stream.schema).parquet(out).agg(F.count(F.lit(1)).alias("n"))


@query("stm_parallelism", _HOURLY)
def stm_parallelism(spark, d):
    """State in the fixed number of partitions; the result is the same."""
    return _keyed(spark, _events(spark, d, rides.INSTANCES), "three-way")


@query("stm_row_consumer", "SELECT count(*) AS n_consumed FROM rides")
def stm_row_consumer(spark, d):
    """Rows consumed, added up over all micro-batches the query reports."""
    stream = rides.passed_through(_events(spark, d))
    with rides.counting(stream.sparkSession) as counter:
        done = _run(rides.to_files(stream, workspace(spark, "consumed"),
                                   workspace(spark, "consumed-checkpoint"), bounded=True))
        consumed = counter.rows(done)
    return spark.range(1).select(F.lit(consumed).cast("bigint").alias("n_consumed"))


@query("stm_batch_twin", _HOURLY)
def stm_batch_twin(spark, d):
    return rides.hourly(adapters.rides(spark, d))
