"""The analyses as named queries over a test-data folder.

Lists are joined to text and times are zone-less in these results, so that
they can be compared with another engine's. Gaps of 30 and 720 minutes are
used: at 30, sessions of the test data have at most three events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.jobs.cli import main
from clicktrail.operators import behavior as b
from clicktrail.operators import rankings as r
from clicktrail.operators import reports as p
from clicktrail.operators import sessions as s
from clicktrail.operators.ordered import Skew
from clicktrail.operators.session_store import SessionStore, stored_pages, stored_products
from clicktrail.operators.sketches import daily_user_sketches, unite_days
from clicktrail.plans import analyses
from clicktrail.session import ensure_checkpoint_dir
from clicktrail.sources import readers, writers
from clicktrail.sources.event_table import read_event_table, read_table_events
from clicktrail.sources.readers import event_profile

Query = Callable[[SparkSession, str], DataFrame]

# Row limit per key that sends most users and every product of the test data
# through the sliced plan of `per_key_order`, the others through the plain one.
SPLIT_ROWS = 60
# Below the longest session, so that lists and sequences are put together from parts.
PART_ROWS = 5
# Buckets of the table that is laid out by user.
BUCKETS = 16
# More hot keys than may be listed, so that all rows are sliced without a list of keys.
MANY_HOT = Skew(SPLIT_ROWS, listed=3)


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, small integers as bigint, lists as text."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            value = F.array_join(value, ",", "")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def _events(build: Callable[[DataFrame], DataFrame], flavour: str = "product") -> Query:
    return lambda spark, folder: comparable(build(read_table_events(spark, folder, flavour)))


def _sessions(build: Callable[[DataFrame], DataFrame], gap: int) -> Query:
    return _events(lambda events: build(s.session_table(events, gap)))


def _page_metrics(gap: int, hot_rows: int | Skew | None = s.HOT_ROWS) -> Query:
    return _events(lambda e: s.session_pages(e, gap, hot_rows=hot_rows), "page")


def _scalar_metrics(gap: int) -> Query:
    columns = ["user_id", "session_id", "start_ts", "end_ts"]
    return _sessions(
        lambda t: t.select(
            *columns,
            F.col("duration_seconds").alias("session_duration_seconds"),
            F.col("event_count").alias("page_count"),
        ),
        gap,
    )


def _sequences(gap: int, hot_rows: int | None = s.HOT_ROWS) -> Query:
    def build(events: DataFrame) -> DataFrame:
        return s.session_sequences(events, gap, hot_rows=hot_rows)

    return _events(build)


def _stored_log(spark: SparkSession, folder: str, kind: str) -> str:
    """The events written as a raw log, in the shared folder of the session."""
    path = f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    instant = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    if kind == "json":
        read_table_events(spark, folder, "page").select(
            instant.alias("timestamp"),
            "user_id",
            F.col("event_type").alias("action"),
            F.col("item_id").alias("page_id"),
        ).write.option("ignoreNullFields", False).json(path)
    else:
        read_table_events(spark, folder).select(
            F.col("user_id").alias("UserID"),
            instant.alias("Timestamp"),
            F.col("event_type").alias("EventType"),
            F.col("item_id").alias("ProductID"),
        ).write.option("header", True).csv(path)
    return path


def _json_log(table: int) -> Query:
    return lambda spark, folder: comparable(
        analyses.sessionize_logs(spark, _stored_log(spark, folder, "json"), 720)[table]
    )


def _csv_log(table: int) -> Query:
    return lambda spark, folder: comparable(
        analyses.process_clickstream(spark, _stored_log(spark, folder, "csv"), 720)[table]
    )


def _mixed_json_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a log whose times are epoch numbers in some files, text, missing or no time in others."""
    path = f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    events = read_table_events(spark, folder, "page")
    early = F.col("event_id") < 2000
    named = [F.col("user_id"), F.col("event_type").alias("action"), F.col("item_id").alias("page_id")]
    seconds = F.unix_micros(F.col("ts")) / F.lit(1_000_000)
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    bad = F.when(F.col("event_id") % 11 == 0, "no time").when(F.col("event_id") % 13 != 0, text)
    writer = {"ignoreNullFields": False}
    events.where(early).select(seconds.alias("timestamp"), *named).write.json(f"{path}/a", **writer)
    events.where(~early).select(bad.alias("timestamp"), *named).write.json(f"{path}/b", **writer)
    found = readers.read_json_events(spark, f"{path}/*")
    return comparable(found.select("user_id", "event_type", "item_id", F.date_trunc("second", "ts").alias("ts")))


def _faulty_log(spark: SparkSession, folder: str, kind: str) -> str:
    """The events as a raw log in which some lines are cut off, too long or without a readable time."""
    path = f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    events = read_table_events(spark, folder, "page" if kind == "json" else "product")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    instant = F.when(F.col("event_id") % 17 == 0, "no time").when(F.col("event_id") % 19 != 0, text)
    if kind == "json":
        line = F.to_json(F.struct(
            instant.alias("timestamp"), "user_id", F.col("event_type").alias("action"), F.col("item_id").alias("page_id")
        ), {"ignoreNullFields": "false"})
        bad = F.expr("substring(line, 1, length(line) - 5)")
    else:
        fields = [F.col("user_id"), instant, F.col("event_type"), F.col("item_id")]
        line = F.concat_ws(",", *[F.coalesce(field, F.lit("")) for field in fields])
        bad = F.concat(F.col("line"), F.lit(",one,more"))
    lines = events.select("event_id", line.alias("line"))
    lines = lines.select(F.when(F.col("event_id") % 23 == 0, bad).otherwise(F.col("line")).alias("line"))
    if kind == "json":
        lines.write.text(path)
        return path
    # One column that holds the whole line and is named as the header, so that every file begins with that.
    lines.toDF("UserID,Timestamp,EventType,ProductID").write.option("header", True).option("sep", "\t").csv(path)
    return path


def _rejects(kind: str) -> Query:
    """How many lines of a faulty log are events and how many are rejected, by reason."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        log = readers.LOG_READERS[kind](spark, _faulty_log(spark, folder, kind))
        accepted = log.events.agg(F.lit("event").alias("kind"), F.count("*").alias("lines"), F.count("ts").alias("timed"))
        rejected = log.rejects.groupBy(F.col("reason").alias("kind")).agg(
            F.count("*").alias("lines"), F.lit(0).cast("long").alias("timed")
        )
        return accepted.unionByName(rejected)

    return query


def _accepted(kind: str) -> Query:
    """Sessions of the events of a faulty log."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        log = readers.LOG_READERS[kind](spark, _faulty_log(spark, folder, kind))
        return comparable(s.session_table(log.events, 720).select("user_id", "session_id", "start_ts", "end_ts", "event_count"))

    return query


def _job(kind: str, result: str) -> Query:
    """A result that a job of the command line writes, run on a raw log."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        out = f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
        second = "--out-top" if kind == "json" else "--out-products"
        arguments = [f"{kind}-sessions", "--input", _stored_log(spark, folder, kind), "--out-sessions", f"{out}/sessions"]
        main([*arguments, second, f"{out}/ranking", "--gap-minutes", "720"], spark)
        return comparable(spark.read.parquet(f"{out}/{result}"))

    return query


def _missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """What the readers and the table check raise for logs of the events that lack columns, and the logs' lines."""
    base = f"{ensure_checkpoint_dir(spark)}/log-{uuid.uuid4().hex}"
    events = read_table_events(spark, folder).select(F.col("user_id").alias("UserID"), F.col("event_type").alias("EventType"))
    events.write.option("header", True).csv(f"{base}/csv")
    events.select(F.col("UserID").alias("user_id")).write.json(f"{base}/json")
    events.write.parquet(f"{base}/parquet")
    found = []
    for kind in ("csv", "json", "parquet"):
        try:
            readers.read_events(spark, f"{base}/{kind}", kind)
        except ValueError as error:
            found.append((kind, str(error)))
    lines = spark.read.parquet(f"{base}/parquet").agg(F.count("*").alias("lines"))
    return spark.createDataFrame(found, "format string, error string").crossJoin(F.broadcast(lines))


def _bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of the events in a table laid out by user."""
    name = f"events_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    table = writers.write_event_table(read_table_events(spark, folder), name, path, BUCKETS)
    return comparable(s.sessionize(table, 720))


def _weekly_users(spark: SparkSession, folder: str) -> DataFrame:
    """Per week and for the whole time: events, and whether the users that daily sketches give are near the exact ones."""
    path = f"{ensure_checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    events = read_table_events(spark, folder)
    daily_user_sketches(events).write.parquet(path)
    stored = spark.read.parquet(path)

    def week(day: str):
        return F.date_format(F.date_trunc("week", F.col(day)), "yyyy-MM-dd")

    weeks = unite_days(stored, week("day").alias("week")).unionByName(
        unite_days(stored).select(F.lit("all").alias("week"), "events", "users")
    )
    exact = events.groupBy(week("ts").alias("week")).agg(F.count_distinct("user_id").alias("exact")).unionByName(
        events.agg(F.lit("all").alias("week"), F.count_distinct("user_id").alias("exact"))
    )
    near = F.abs(F.hll_sketch_estimate("users") - F.col("exact")) <= 0.05 * F.col("exact")
    return weeks.join(exact, "week").select("week", "events", near.alias("users_within_5_percent"))


def _stored_events(kind: str) -> Query:
    """Events written by a sink of the library and read back by suffix."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = f"{ensure_checkpoint_dir(spark)}/events-{uuid.uuid4().hex}.{kind}"
        events = read_table_events(spark, folder)
        if kind == "parquet":
            writers.write_parquet(events, path)
            return comparable(readers.read_events(spark, path))
        instant = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        log = events.select(
            F.col("item_id").alias("ProductID"), F.col("user_id").alias("UserID"),
            instant.alias("Timestamp"), F.col("event_type").alias("EventType"),
        )
        writers.write_csv(log, path, single_file=True)
        return comparable(readers.read_events(spark, path).drop("event_id"))

    return query


def _in_batches(events: DataFrame, late: bool) -> list[DataFrame]:
    """The events in two batches by time; with `late`, one event in 13 comes in a third, whatever its time."""
    span = events.agg(F.struct(F.min("ts").alias("low"), F.max("ts").alias("high"))).scalar()
    middle = F.timestamp_seconds((F.unix_timestamp(span["low"]) + F.unix_timestamp(span["high"])) / 2)
    early = F.coalesce(F.col("ts") < middle, F.lit(True))
    delayed = F.col("event_id") % 13 == 0 if late else F.lit(False)
    batches = [events.where(early & ~delayed), events.where(~early & ~delayed)]
    return [*batches, events.where(delayed)] if late else batches


def _stored_sessions(
    result: Callable[[SessionStore], DataFrame], gap: int, late: bool, lists: bool = False, flavour: str = "product"
) -> Query:
    """A result of sessions that were stored batch by batch."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = f"{ensure_checkpoint_dir(spark)}/sessions-{uuid.uuid4().hex}"
        store = SessionStore(spark, path, gap, lists)
        for number, batch in enumerate(_in_batches(read_table_events(spark, folder, flavour), late)):
            store.add(batch, f"batch {number}")
        return comparable(result(store))

    return query


def _totals_of(store: SessionStore) -> DataFrame:
    return store.sessions().select(
        "user_id", "session_id", "start_ts", "end_ts", F.col("duration_seconds").alias("session_duration_seconds"),
        F.col("event_count").alias("page_count"),
    )


def _nulled(column: str, every: int, build: Callable[[DataFrame], DataFrame]) -> Query:
    """`build` on events of which every so many have no value in `column`."""

    def nulled(events: DataFrame) -> DataFrame:
        return events.withColumn(column, F.when(F.col("event_id") % every != 0, F.col(column)))

    return _events(lambda events: build(nulled(events)))


def _approximate_users(table: DataFrame) -> DataFrame:
    """The approximate user count is within 5 % of the exact one."""
    exact = table.agg(F.count_distinct("user_id").alias("n"))
    near = F.abs(F.col("unique_users") - exact.scalar()) <= 0.05 * exact.scalar()
    return p.session_summary(table).select("total_sessions", near.alias("users_within_5_percent"))


def _time_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, unit in {"hour": "hour", "dow": "day_of_week", "month": "month"}.items():
        found[f"events_by_{name}"] = _events(lambda e, u=unit: b.events_by_time(e, u))
        found[f"events_by_{name}_by_type"] = _events(lambda e, u=unit: b.event_types_by_time(e, u))
    return found


def queries() -> dict[str, Query]:
    return {
        # sessions
        "sessionized_events_g30": _events(lambda e: s.sessionize(e, 30, "keep_range")),
        "sessionized_events_rows_frame_g30": _events(lambda e: s.sessionize(e, 30, "keep_rows")),
        "sessionized_events_g720_split": _events(lambda e: s.sessionize(e, 720, hot_rows=SPLIT_ROWS)),
        "session_metrics_g30": _scalar_metrics(30),
        "session_metrics_g720": _scalar_metrics(720),
        "session_pages_g30": _page_metrics(30),
        "session_pages_g720": _page_metrics(720),
        "session_pages_g720_split": _page_metrics(720, SPLIT_ROWS),
        "session_product_metrics_g720": _events(lambda e: s.session_products(e, 720)),
        "session_product_metrics_g720_split": _events(
            lambda e: s.session_products(e, 720, hot_rows=SPLIT_ROWS)
        ),
        "session_item_parts_g720": _events(lambda e: s.session_item_parts(e, 720, part_size=4)),
        "session_stats_g720": _sessions(p.session_stats, 720),
        "session_averages_g720": _sessions(p.session_averages, 720),
        "session_summary_g720": _sessions(
            lambda t: p.session_summary(t).drop("unique_users"), 720
        ),
        "session_summary_approx_users_g720": _sessions(_approximate_users, 720),
        # lists and texts put together from parts
        "session_pages_g720_parts": _page_metrics(720, PART_ROWS),
        "session_product_metrics_g720_parts": _events(
            lambda e: s.session_products(e, 720, hot_rows=PART_ROWS)
        ),
        "event_sequences_g720_parts": _sequences(720, PART_ROWS),
        "sequence_counts_g720_parts": _events(
            lambda e: p.sequence_counts(e, 720, hot_rows=PART_ROWS)
        ),
        "session_metrics_g30_split": _events(
            lambda e: s.session_table(e, 30, hot_rows=PART_ROWS).select(
                "user_id", "session_id", "start_ts", "end_ts",
                F.col("duration_seconds").alias("session_duration_seconds"),
                F.col("event_count").alias("page_count"),
            )
        ),
        # hot keys too many to list
        "sessionized_events_g720_many_hot": _events(lambda e: s.sessionize(e, 720, hot_rows=MANY_HOT)),
        "session_pages_g720_many_hot": _page_metrics(720, MANY_HOT),
        "session_metrics_g30_many_hot": _events(
            lambda e: s.session_table(e, 30, hot_rows=Skew(PART_ROWS, listed=3)).select(
                "user_id", "session_id", "start_ts", "end_ts",
                F.col("duration_seconds").alias("session_duration_seconds"),
                F.col("event_count").alias("page_count"),
            )
        ),
        "event_position_g720_many_hot": _events(lambda e: p.event_position_counts(e, 720, hot_rows=MANY_HOT)),
        "user_return_gaps_many_hot": _events(lambda e: b.user_return_gaps(e, MANY_HOT)),
        "product_transitions_many_hot": _events(lambda e: b.product_transitions(e, MANY_HOT)),
        # sessions of a growing log, stored batch by batch
        "stored_sessions_g720": _stored_sessions(_totals_of, 720, late=False),
        "stored_sessions_late_g30": _stored_sessions(_totals_of, 30, late=True),
        "stored_sessions_late_g720": _stored_sessions(_totals_of, 720, late=True),
        "stored_session_stats_g720": _stored_sessions(lambda t: p.session_stats(t.sessions()), 720, late=False),
        "stored_pages_late_g720": _stored_sessions(stored_pages, 720, late=True, lists=True, flavour="page"),
        "stored_products_late_g720": _stored_sessions(stored_products, 720, late=True, lists=True),
        # events without time, user or item
        "untimed_rows_frame_g30": _nulled("ts", 10, lambda e: s.sessionize(e, 30, "keep_rows")),
        "untimed_range_frame_g30": _nulled("ts", 10, lambda e: s.sessionize(e, 30, "keep_range")),
        "dropped_events": _nulled("ts", 10, s.dropped_events),
        "session_stats_null_user_g720": _nulled(
            "user_id", 7, lambda e: p.session_stats(s.session_table(e, 720))
        ),
        "overview_totals_null_user": _nulled("user_id", 7, r.overview_totals),
        "overview_totals_null_item": _nulled("item_id", 7, r.overview_totals),
        "top_products_null_item": _nulled("item_id", 7, r.viewed_products),
        "product_views_null_user": _nulled("user_id", 7, r.product_views),
        # the same from raw logs, written and read back
        "json_log_sessions_g720": _json_log(0),
        "json_log_top_pages": _json_log(1),
        "csv_log_sessions_g720": _csv_log(0),
        "csv_log_products": _csv_log(1),
        "json_log_mixed_timestamps": _mixed_json_log,
        # faulty logs, jobs of the command line, missing columns
        "json_log_rejects": _rejects("json"),
        "csv_log_rejects": _rejects("csv"),
        "json_log_accepted_sessions_g720": _accepted("json"),
        "csv_log_accepted_sessions_g720": _accepted("csv"),
        "job_json_sessions_g720": _job("json", "sessions"),
        "job_json_top_pages": _job("json", "ranking"),
        "job_json_dropped_events": _job("json", "sessions_dropped_events"),
        "job_csv_sessions_g720": _job("csv", "sessions"),
        "job_csv_products": _job("csv", "ranking"),
        "missing_columns": _missing_columns,
        # laid out by user; stored sketches of users
        "sessionized_events_bucketed_g720": _bucketed,
        "weekly_users_from_sketches": _weekly_users,
        # written by the sinks and read back
        "events_parquet_round_trip": _stored_events("parquet"),
        "events_csv_round_trip": _stored_events("csv"),
        # rankings and totals
        "top_pages": _events(r.top_pages, "page"),
        "product_views": _events(r.product_views),
        "product_views_all_cart": _events(lambda e: r.product_views(e, "all_events")),
        "top_products_10": _events(lambda e: r.top_products(e, 10)),
        "top_products_5": _events(lambda e: r.product_views(e, limit=5)),
        "top_products_with_null": _events(r.viewed_products),
        "basic_totals_g30": _sessions(p.basic_totals, 30),
        "raw_totals": _events(r.raw_totals),
        "overview_totals": _events(r.overview_totals),
        "event_type_distribution": _events(r.event_type_distribution),
        # engagement, funnel, sequences
        "user_activity_g720": _sessions(p.user_activity, 720),
        "engagement_g720": _sessions(p.engagement, 720),
        "event_position_g720": _events(lambda e: p.event_position_counts(e, 720)),
        "event_position_g720_split": _events(
            lambda e: p.event_position_counts(e, 720, hot_rows=SPLIT_ROWS)
        ),
        "duration_buckets_g720": _sessions(p.duration_distribution, 720),
        "funnel_flags_g720": _sessions(p.funnel_flags, 720),
        "funnel_totals_g720": _sessions(p.funnel_totals, 720),
        "funnel_rates_g720": _sessions(p.funnel_rates, 720),
        "event_sequences_g720": _sequences(720),
        "sequence_counts_g720": _events(lambda e: p.sequence_counts(e, 720)),
        "sequence_counts_g720_split": _events(
            lambda e: p.sequence_counts(e, 720, hot_rows=SPLIT_ROWS)
        ),
        "top_sequences_10_g720": _events(lambda e: p.top_sequences(p.sequence_counts(e, 720))),
        "top_sequences_10_by_digest_g720": _events(lambda e: p.top_sequences_by_digest(e, 720)),
        # time, returns, products
        **_time_queries(),
        "event_types_hourly": _events(b.event_types_by_hour),
        "daily_activity": _events(b.daily_activity),
        "user_return_gaps": _events(b.user_return_gaps),
        "user_return_gaps_split": _events(lambda e: b.user_return_gaps(e, SPLIT_ROWS)),
        "return_histogram": _events(b.return_histogram),
        "return_categories": _events(b.return_categories),
        "product_event_counts": _events(b.product_event_counts),
        "product_transitions": _events(b.product_transitions),
        "product_transitions_split": _events(lambda e: b.product_transitions(e, SPLIT_ROWS)),
        "event_profile": lambda spark, folder: event_profile(read_event_table(spark, folder), "ts"),
    }
