"""Time-of-day and daily activity, user returns, product behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.events import (
    EVENT_ORDER,
    RETURN_CATEGORIES,
    seconds_between,
    weekday_label,
)
from clicktrail.operators.ordered import HOT_ROWS, Next, Ordered, Previous, Skew, per_key_order

TIME_UNITS = {"hour": F.hour, "day_of_week": F.dayofweek, "month": F.month}
HISTOGRAM_BINS = 50


# --- time of day, day of week, month, date -----------------------------------


def _time_unit(unit: str) -> tuple[Column, Column]:
    if unit not in TIME_UNITS:
        raise ValueError(f"time unit must be one of {list(TIME_UNITS)}, got {unit!r}")
    number = TIME_UNITS[unit]("ts")
    label = weekday_label(F.col("time_unit")) if unit == "day_of_week" else F.col("time_unit").cast("string")
    return number.alias("time_unit"), label.alias("time_label")


def events_by_time(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Events per hour, day of week (1 = Sunday) or month, in time order."""
    number, label = _time_unit(unit)
    return events.groupBy(number).count().select("time_unit", "count", label).orderBy("time_unit")


def event_types_by_time(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Events per time unit and event type."""
    number, label = _time_unit(unit)
    return (
        events.groupBy(number, "event_type")
        .count()
        .select("time_unit", "event_type", "count", label)
    )


def event_types_by_hour(events: DataFrame) -> DataFrame:
    """Events per hour of the day and event type: hour, event_type, count."""
    return events.groupBy(F.hour("ts").alias("hour"), "event_type").count()


def daily_activity(events: DataFrame) -> DataFrame:
    """Events per calendar date (text yyyy-MM-dd), in date order."""
    # Grouping by the date itself keeps text formatting out of the scan's hot
    # loop: it runs once per day instead of once per event.
    return (
        events.groupBy(F.to_date("ts").alias("day"))
        .count()
        .orderBy("day")
        .select(F.date_format("day", "yyyy-MM-dd").alias("date"), "count")
    )


# --- time between a user's consecutive events --------------------------------


def user_return_gaps(events: DataFrame, hot_rows: int | Skew | None = HOT_ROWS) -> DataFrame:
    """All events but each user's first, with prev_ts and gap_hours."""

    def build(rows: Ordered) -> DataFrame:
        frame = rows.add(prev_ts=Previous(F.col("ts"))).frame
        gap = seconds_between(F.col("prev_ts"), F.col("ts")) / F.lit(3600.0)
        return (
            frame.filter(F.col("prev_ts").isNotNull())
            .select(*events.columns, "prev_ts", gap.alias("gap_hours"))
        )

    # An event without timestamp has no gap and gives its successor none.
    timed = events.filter(F.col("ts").isNotNull())
    return per_key_order(timed, "user_id", EVENT_ORDER, build, hot_rows)


def _gap_seconds(events: DataFrame, hot_rows: int | Skew | None) -> DataFrame:
    """The gap before each event but the user's first, as gap_seconds."""

    def build(rows: Ordered) -> DataFrame:
        frame = rows.add(prev_ts=Previous(F.col("ts"))).frame
        gap = seconds_between(F.col("prev_ts"), F.col("ts"))
        return frame.filter(F.col("prev_ts").isNotNull()).select(gap.alias("gap_seconds"))

    timed = events.filter(F.col("ts").isNotNull()).select("user_id", "ts")
    return per_key_order(timed, "user_id", ["ts"], build, hot_rows)


def stored_gap_seconds(gaps: DataFrame) -> DataFrame:
    """The gaps of a stored result of `user_return_gaps`, as gap_seconds."""
    return gaps.select(seconds_between(F.col("prev_ts"), F.col("ts")).alias("gap_seconds"))


def return_histogram(
    events: DataFrame, bins: int = HISTOGRAM_BINS, hot_rows: int | Skew | None = HOT_ROWS
) -> DataFrame:
    """`gap_histogram` of the gaps between each user's events."""
    return gap_histogram(_gap_seconds(events, hot_rows), bins)


def return_categories(events: DataFrame, hot_rows: int | Skew | None = HOT_ROWS) -> DataFrame:
    """`gap_categories` of the gaps between each user's events."""
    return gap_categories(_gap_seconds(events, hot_rows))


def gap_histogram(gaps: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Gaps per bin, `bins` equal bins from the shortest to the longest gap.

    Columns: bin (from 1), bin_start and bin_end in hours, count. Empty bins
    are left out. If all gaps are equal they are in bin 1.
    """
    if bins < 1:
        raise ValueError(f"bins must be at least 1, got {bins}")
    # Equal gaps are counted first: the bounds and the bins need each value once,
    # and both share that shuffle.
    gaps = gaps.groupBy("gap_seconds").agg(F.count("*").alias("n")).select(
        (F.col("gap_seconds") / F.lit(3600.0)).alias("gap_hours"), "n"
    )
    span = gaps.agg(F.struct(F.min("gap_hours").alias("low"), F.max("gap_hours").alias("high")))
    placed = gaps.withColumn("span", span.scalar())
    low, high = F.col("span.low"), F.col("span.high")
    share = (F.col("gap_hours") - low) / (high - low)
    number = F.when(high == low, 1).otherwise(F.least(F.floor(share * bins) + 1, F.lit(bins)))
    width = (high - low) / F.lit(float(bins))
    return (
        placed.select(number.cast("bigint").alias("bin"), "span", "n")
        .groupBy("bin", "span")
        .agg(F.sum("n").alias("count"))
        .select(
            "bin",
            (low + width * (F.col("bin") - 1)).alias("bin_start"),
            (low + width * F.col("bin")).alias("bin_end"),
            "count",
        )
    )


def gap_categories(gaps: DataFrame) -> DataFrame:
    """Gaps per category, most frequent first; all four categories are listed.

    A gap belongs to the first category whose upper bound (1 h, 24 h, 168 h,
    none) it does not exceed. A gap of 0 belongs to none.
    """
    hour = 3600
    gap = F.col("gap_seconds")
    same_hour, same_day, same_week, longer = RETURN_CATEGORIES
    bounds = {
        same_hour: (gap > 0) & (gap <= hour),
        same_day: (gap > hour) & (gap <= 24 * hour),
        same_week: (gap > 24 * hour) & (gap <= 168 * hour),
        longer: gap > 168 * hour,
    }
    # One row of four counts, unfolded: the zeros need no join.
    totals = gaps.agg(
        *[F.count_if(within).alias(name) for name, within in bounds.items()]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("category"), F.col(f"`{n}`").alias("count")) for n in bounds]
    )
    return totals.select(F.inline(rows)).orderBy(F.desc("count"), "category")


# --- products ----------------------------------------------------------------


def product_event_counts(events: DataFrame) -> DataFrame:
    """Events per product and event type."""
    return (
        events.filter(F.col("item_id").isNotNull()).groupBy("item_id", "event_type").count()
    )


def product_transitions(events: DataFrame, hot_rows: int | Skew | None = HOT_ROWS) -> DataFrame:
    """How often one event type follows another on the same product.

    The successor is the product's next event by time, whoever caused it.
    """

    def build(rows: Ordered) -> DataFrame:
        frame = rows.add(next_event=Next(F.col("event_type"))).frame
        return frame.filter(F.col("next_event").isNotNull()).select("event_type", "next_event")

    of_products = events.filter(F.col("item_id").isNotNull()).select(
        "item_id", "ts", "event_id", "event_type"
    )
    return (
        per_key_order(of_products, "item_id", ["ts", "event_id", "event_type"], build, hot_rows)
        .groupBy("event_type", "next_event")
        .count()
    )
