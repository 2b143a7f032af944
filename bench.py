"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_RUNS (default 5, the median counts). All queries run twice to warm up
before any is timed. Results go to Spark's `noop` sink, so all rows and columns
are computed; planning is part of the time.

`baseline` has the times of plain plans for some of them in the same session:
lag and running sum over a window of the user's events, then a group by.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.plans import catalog
from clicktrail.session import build_spark
from clicktrail.sources.event_table import read_table_events

HEADLINES = [
    "session_metrics_g30",
    "session_metrics_g720",
    "sessionized_events_g30",
    "session_pages_g30",
    "session_product_metrics_g720",
    "basic_totals_g30",
    "engagement_g720",
    "event_position_g720",
    "duration_buckets_g720",
    "funnel_rates_g720",
    "top_sequences_10_g720",
    "product_views",
    "top_products_10",
    "overview_totals",
    "events_by_hour_by_type",
    "daily_activity",
    "user_return_gaps",
    "return_histogram",
    "return_categories",
    "product_transitions",
]


# The yardstick: the usual plain plan of lag and running sum, without any care for hot keys.
def _labelled(events: DataFrame, gap: int) -> DataFrame:
    user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    idle = (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(user))) / 60.0
    starts = F.when(idle.isNull() | (idle > gap), 1).otherwise(0)
    return events.withColumn("new", starts).withColumn("seq", F.sum("new").over(user))


def _sessions(events: DataFrame, gap: int, *more) -> DataFrame:
    spans = [F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n")]
    return _labelled(events, gap).groupBy("user_id", "seq").agg(*spans, *more)


def _list(column: str, kept=None):
    entry = F.struct("ts", "event_id", column)
    entry = entry if kept is None else F.when(kept, entry)
    return F.sort_array(F.collect_list(entry))[column].alias("list")


def _gaps(events: DataFrame) -> DataFrame:
    user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = events.withColumn("before", F.lag("ts").over(user)).where(F.col("before").isNotNull())
    return before.withColumn("hours", (F.unix_timestamp("ts") - F.unix_timestamp("before")) / 3600.0)


def _transitions(events: DataFrame) -> DataFrame:
    item = Window.partitionBy("item_id").orderBy("ts", "event_id")
    following = events.where("item_id IS NOT NULL").withColumn("following", F.lead("event_type").over(item))
    return following.where("following IS NOT NULL").groupBy("event_type", "following").count()


def _products(events: DataFrame) -> DataFrame:
    views = events.where("event_type = 'product_view' AND item_id IS NOT NULL")
    return views.groupBy("item_id").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users")).orderBy(F.desc("n"))


PLAIN = {
    "session_metrics_g30": lambda e: _sessions(e, 30),
    "session_metrics_g720": lambda e: _sessions(e, 720),
    "sessionized_events_g30": lambda e: _labelled(e, 30),
    "session_pages_g30": lambda e: _sessions(e, 30, _list("item_id")),
    "session_product_metrics_g720": lambda e: _sessions(
        e, 720, F.count_distinct("item_id"), _list("item_id", F.col("event_type") == "product_view")
    ),
    "basic_totals_g30": lambda e: _sessions(e, 30).agg(F.count("*"), F.sum("n"), F.count_distinct("user_id")),
    "product_views": _products,
    "overview_totals": lambda e: e.agg(F.count("*"), F.count_distinct("user_id"), F.count_distinct("item_id")),
    "user_return_gaps": _gaps,
    "return_categories": lambda e: _gaps(e).groupBy((F.col("hours") <= 1), (F.col("hours") <= 24), (F.col("hours") <= 168)).count(),
    "product_transitions": _transitions,
}


def plain(name: str):
    return lambda spark, folder: PLAIN[name](read_table_events(spark, folder))


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_spark(
        "clicktrail-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINES
    compared = {name: plain(name) for name in names if name in PLAIN}
    for name in 2 * names:
        seconds(queries[name], spark, folder)
        if name in compared:
            seconds(compared[name], spark, folder)

    def median(query) -> float:
        return round(statistics.median(seconds(query, spark, folder) for _ in range(runs)), 3)

    timings = {name: median(queries[name]) for name in names}
    baseline = {name: median(query) for name, query in compared.items()}
    spark.stop()
    print(json.dumps({
        "metric": "total median wall time of the headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "baseline": baseline,
        "ratio": {name: round(timings[name] / baseline[name], 2) for name in baseline},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
