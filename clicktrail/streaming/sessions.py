"""Session totals on a stream.

Lag windows do not exist on streams, so sessions come from `session_window`.
On whole seconds, with a gap that ends a session only when exceeded, it finds
the sessions of `operators.sessions.session_table`; the ordinal is left out,
since a stream does not know a user's earlier sessions once they are closed.

Do not filter the result on the window: Spark moves such a filter below the
merging of sessions, where it drops single events. Filter on start_ts, end_ts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.events import (
    ADD_TO_CART,
    DEFAULT_GAP_MINUTES,
    PRODUCT_VIEW,
    PURCHASE,
    check_gap,
    count_events,
    minutes_2dp,
    seconds_between,
)


def stream_sessions(
    events: DataFrame, gap_minutes: int = DEFAULT_GAP_MINUTES, allowed_lateness: str = "1 hour"
) -> DataFrame:
    """One row per closed session of a stream of canonical events.

    A session is emitted once the watermark (latest event less
    `allowed_lateness`) has passed its end plus the gap; events later than
    that are dropped by Spark. State holds running totals per open session,
    never its events. Works on a static DataFrame too.

    For a stream with hot users set
    `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`, which
    merges sessions before the shuffle.
    """
    gap_seconds = check_gap(gap_minutes)
    # The window merges events exactly one gap apart. For a gap of 0 any gap
    # below a second does, as it must only merge events of the same second.
    gap = f"{gap_seconds} seconds" if gap_seconds else "1 millisecond"
    window = F.session_window("second", gap)
    sessions = (
        events.withColumn("second", F.date_trunc("second", F.col("ts")))
        .withWatermark("second", allowed_lateness)
        .groupBy("user_id", window)
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.count("*").alias("event_count"),
            count_events(PRODUCT_VIEW).alias("product_views"),
            count_events(ADD_TO_CART).alias("cart_adds"),
            count_events(PURCHASE).alias("purchases"),
        )
    )
    seconds = seconds_between(F.col("start_ts"), F.col("end_ts"))
    return sessions.select(
        "user_id",
        "start_ts",
        "end_ts",
        seconds.alias("duration_seconds"),
        minutes_2dp(seconds).alias("duration_minutes"),
        "event_count",
        "product_views",
        "cart_adds",
        "purchases",
    )
