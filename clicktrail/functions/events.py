"""Names and column expressions of the canonical event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event names, labels and the separator that appear in results.
PAGE_VIEW = "page_view"
PRODUCT_VIEW = "product_view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
SEQUENCE_SEPARATOR = " → "
DURATION_BUCKETS = ["Instant", "≤ 1 min", "1-5 mins", "5-15 mins", "> 15 mins"]
RETURN_CATEGORIES = ["Same Hour", "Same Day", "Same Week", "Longer"]
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]

# The order of one user's events. Only `ts` carries meaning; the rest makes
# the outcome repeatable when several events share an instant.
EVENT_ORDER = ["ts", "event_id", "event_type", "item_id"]
# Enough where results show no items.
TYPE_ORDER = ["ts", "event_id", "event_type"]

DEFAULT_GAP_MINUTES = 30


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of the two instants' whole seconds (fractions cut off first)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_2dp(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 2)


def is_event(name: str) -> Column:
    return F.col("event_type") == F.lit(name)


def count_events(name: str) -> Column:
    """Number of events called `name`; 0, not NULL, for a group without any."""
    return F.count(F.when(is_event(name), F.lit(1)))


def session_id(user: str = "user_id", ordinal: str = "session_seq") -> Column:
    """`<user>_<ordinal>`; a NULL user leaves only the ordinal."""
    return F.concat_ws("_", F.col(user), F.col(ordinal).cast("string"))


def check_gap(gap_minutes: int) -> int:
    """The gap in seconds; a session gap cannot be negative."""
    if isinstance(gap_minutes, bool) or int(gap_minutes) != gap_minutes or gap_minutes < 0:
        raise ValueError(f"gap_minutes must be a whole number >= 0, got {gap_minutes!r}")
    return int(gap_minutes) * 60


def duration_bucket(minutes: Column) -> Column:
    """Bucket label of a duration in minutes; upper bounds belong to the bucket."""
    instant, one, five, fifteen, longer = DURATION_BUCKETS
    return (
        F.when(minutes == 0, instant)
        .when(minutes <= 1, one)
        .when(minutes <= 5, five)
        .when(minutes <= 15, fifteen)
        .otherwise(longer)
    )


def bucket_order(bucket: Column) -> Column:
    """1-based rank of a duration bucket, shortest first."""
    labels = F.array(*[F.lit(label) for label in DURATION_BUCKETS])
    return F.array_position(labels, bucket)


def weekday_label(number: Column) -> Column:
    """Short day name for 1 (Sunday) to 7 (Saturday)."""
    return F.get(F.array(*[F.lit(day) for day in WEEKDAYS]), number - 1)
