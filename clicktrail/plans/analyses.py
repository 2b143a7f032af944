"""The analyses a log user runs, each a function from input to DataFrames.

Nothing is printed or collected here, but for the bounded checks of the readers
and of `per_key_order`. Column names follow the raw log format the analysis
reads. Where one sessionization serves several results, a stored session table
can be passed as `table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktrail.functions.events import DEFAULT_GAP_MINUTES
from clicktrail.operators import behavior, rankings, reports, sessions
from clicktrail.operators.ordered import HOT_ROWS, Skew, hot_limit
from clicktrail.sources.readers import event_profile, read_csv_events, read_json_events, sample_rows

# What the CSV log calls the canonical columns.
CSV_NAMES = {"item_id": "ProductID", "event_type": "EventType"}


def csv_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CSV_NAMES)


def page_analysis(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Sessions with their pages, top pages."""
    pages = sessions.session_pages(events, gap_minutes, null_ts, hot_rows)
    return pages, rankings.top_pages(events)


def product_analysis(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    cart_scope: str = "viewed_rows",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Sessions with their products, product view statistics."""
    products = sessions.session_products(events, gap_minutes, null_ts, hot_rows)
    return products, csv_names(rankings.product_views(events, cart_scope))


def sessionize_logs(
    spark: SparkSession,
    input_path: str,
    session_gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """`page_analysis` of a JSON log."""
    events = read_json_events(spark, input_path)
    return page_analysis(events, session_gap_minutes, null_ts, hot_rows)


def process_clickstream(
    spark: SparkSession,
    input_path: str,
    session_gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    cart_scope: str = "viewed_rows",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """`product_analysis` of a CSV log."""
    events = read_csv_events(spark, input_path)
    return product_analysis(events, session_gap_minutes, null_ts, cart_scope, hot_rows)


def session_summary(product_sessions: DataFrame) -> DataFrame:
    """Summary of the first table of `product_analysis`."""
    return reports.session_summary(
        product_sessions.withColumnRenamed("session_duration_minutes", "duration_minutes")
    )


def top_five_products(products: DataFrame) -> DataFrame:
    """First five rows of the second table of `product_analysis`."""
    return products.limit(5)


def basic_report(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    table: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Totals, event types, session averages, dropped events, top 10 products."""
    if table is None:
        table = sessions.session_table(events, gap_minutes, null_ts)
    return {
        "basic_totals": reports.basic_totals(table),
        "event_types": csv_names(rankings.event_type_distribution(events)),
        "session_averages": reports.session_averages(table),
        "dropped_events": sessions.dropped_events(events, null_ts),
        "top_products": csv_names(rankings.top_products(events, 10)),
    }


def engagement_report(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    table: DataFrame | None = None,
    hot_rows: int | Skew | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """Dropped events, engagement, event positions, durations, funnel, top 10 sequences."""
    if table is None:
        table = sessions.session_table(events, gap_minutes, null_ts)
    limit = hot_limit(sessions.apply_null_ts(events, null_ts), "user_id", hot_rows)
    positions = reports.event_position_counts(events, gap_minutes, null_ts, limit)
    sequences = reports.sequence_counts(events, gap_minutes, null_ts, limit)
    return {
        "dropped_events": sessions.dropped_events(events, null_ts),
        "engagement": reports.engagement(table),
        "event_positions": csv_names(positions),
        "duration_distribution": reports.duration_distribution(table),
        "funnel_totals": reports.funnel_totals(table),
        "funnel_rates": reports.funnel_rates(table),
        "top_sequences": reports.top_sequences(sequences),
    }


def product_report(events: DataFrame) -> dict[str, DataFrame]:
    """Profile, sample rows, totals, products by views."""
    return {
        "profile": event_profile(events, "ts"),
        "sample": sample_rows(events),
        "raw_totals": rankings.raw_totals(events),
        "top_products": csv_names(rankings.viewed_products(events)),
    }


def timing_patterns(events: DataFrame, time_unit: str = "hour") -> dict[str, DataFrame]:
    """Events per time unit, and per time unit and event type."""
    found = {
        f"events_by_{time_unit}": behavior.events_by_time(events, time_unit),
        f"event_types_by_{time_unit}": csv_names(behavior.event_types_by_time(events, time_unit)),
    }
    if time_unit == "hour":
        found["event_types_hourly"] = csv_names(behavior.event_types_by_hour(events))
    return found


def return_gaps(events: DataFrame, hot_rows: int | Skew | None = HOT_ROWS) -> DataFrame:
    """Gaps between a user's events."""
    return csv_names(behavior.user_return_gaps(events, hot_rows))


def user_returns(gaps: DataFrame) -> dict[str, DataFrame]:
    """Histogram and categories of `return_gaps`, which a job stores first."""
    seconds = behavior.stored_gap_seconds(gaps)
    return {"histogram": behavior.gap_histogram(seconds), "categories": behavior.gap_categories(seconds)}


def product_behavior(
    events: DataFrame, hot_rows: int | Skew | None = HOT_ROWS
) -> dict[str, DataFrame]:
    """Events per product and type, and event transitions on a product."""
    return {
        "product_events": csv_names(behavior.product_event_counts(events)),
        "product_transitions": csv_names(behavior.product_transitions(events, hot_rows)),
    }


def overview(events: DataFrame) -> dict[str, DataFrame]:
    """Totals, event types and daily activity."""
    return {
        "totals": rankings.overview_totals(events),
        "event_types": csv_names(rankings.event_type_distribution(events)),
        "daily_activity": behavior.daily_activity(events),
    }
