"""Distinct users of any range of days, from small mergeable sketches stored per day.

A day's users are kept as a HyperLogLog sketch of a few KB at most. Sketches unite: those of
a range of days give the number of its users, within about 1 %, without reading an
event. A day may have several rows: late events add another one, and events that are
counted twice change nothing. As in a distinct count, NULL is no user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^14 registers: a standard error of 0.8 %.
REGISTERS_LOG2 = 14


def daily_user_sketches(events: DataFrame) -> DataFrame:
    """(day, events, users): per day the number of events and a sketch of the users; untimed events have day NULL."""
    day = F.to_date("ts").alias("day")
    return events.groupBy(day).agg(
        F.count("*").alias("events"), F.hll_sketch_agg("user_id", F.lit(REGISTERS_LOG2)).alias("users")
    )


def unite_days(sketches: DataFrame, *by: Column) -> DataFrame:
    """The sketches united per group: the columns of `by`, events, users."""
    return sketches.groupBy(*by).agg(F.sum("events").alias("events"), F.hll_union_agg("users").alias("users"))


def users_between(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """One row: events and approximate unique_users of the days `first` to `last`, both included."""
    days = sketches.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return unite_days(days).select(
        F.coalesce("events", F.lit(0)).alias("events"),
        F.coalesce(F.hll_sketch_estimate("users"), F.lit(0)).alias("unique_users"),
    )
