"""Sessions emitted by a stream are the batch sessions closed by its watermark."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clicktrail.operators.sessions import session_table
from clicktrail.schema import EVENT_COLUMNS
from clicktrail.sources.event_table import read_table_events
from clicktrail.streaming.sessions import stream_sessions
from tests.brute import event, make_events

COLUMNS = [
    "user_id", "start_ts", "end_ts", "duration_seconds", "duration_minutes", "event_count",
    "product_views", "cart_adds", "purchases",
]


@pytest.mark.parametrize("gap", [30, 720])
def test_stream_matches_batch(spark, gap):
    folder = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    events = read_table_events(spark, "/root/testdata/sf0.01")
    # Two files in time order, taken one per trigger.
    middle = events.selectExpr("timestamp_micros(cast(avg(unix_micros(ts)) AS bigint)) AS m").first().m
    source = str(folder / "in")
    events.filter(F.col("ts") < F.lit(middle)).coalesce(1).write.parquet(source)
    events.filter(F.col("ts") >= F.lit(middle)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        stream_sessions(stream.select(*EVENT_COLUMNS), gap, "1 hour")
        .writeStream.format("parquet").outputMode("append")
        .option("path", str(folder / "out")).option("checkpointLocation", str(folder / "state"))
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(300)
    emitted = spark.read.parquet(str(folder / "out"))
    batch = session_table(events, gap).select(*COLUMNS)
    assert emitted.select(*COLUMNS).exceptAll(batch).isEmpty()
    left = batch.exceptAll(emitted.select(*COLUMNS))
    latest = events.agg(F.date_trunc("second", F.max("ts"))).first()[0]
    still_open = F.unix_timestamp("end_ts") + gap * 60 >= F.unix_timestamp(F.lit(latest)) - 3600
    assert left.filter(~still_open).isEmpty()
    assert emitted.count() > 0.9 * batch.count()


@pytest.mark.parametrize("gap", [0, 1, 30])
def test_static_input(spark, gap):
    rows = [event("a", x) for x in (0, 0.9, 1.0, 60, 61.5, 1861)] + [event(None, 5, "purchase")]
    events = make_events(spark, rows)
    assert sorted(map(str, stream_sessions(events, gap).select(*COLUMNS).collect())) == sorted(
        map(str, session_table(events, gap).select(*COLUMNS).collect())
    )
