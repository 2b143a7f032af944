"""Canonical events from the `events` Parquet table of a test-data folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions.events import ADD_TO_CART, PAGE_VIEW, PRODUCT_VIEW, PURCHASE
from clicktrail.schema import require_columns, to_events

# Event names of the table and what they stand for. Event types
# not listed keep their name and concern no item.
PRODUCT_TYPES = {"view": PRODUCT_VIEW, "click": ADD_TO_CART, "purchase": PURCHASE}
PAGE_TYPES = {"view": PAGE_VIEW, "click": "click", "purchase": PURCHASE}
FLAVOURS = {"product": PRODUCT_TYPES, "page": PAGE_TYPES}
USED_COLUMNS = ["event_id", "ts", "user_id", "event_type", "props"]


def read_event_table(spark: SparkSession, folder: str) -> DataFrame:
    """The table as stored; a ValueError names the columns it lacks."""
    return require_columns(spark.read.parquet(f"{folder}/events.parquet"), USED_COLUMNS, "event table")


def table_events(table: DataFrame, flavour: str = "product") -> DataFrame:
    """Map the table's rows; the item is `k` of the JSON text in `props`."""
    types = FLAVOURS[flavour]
    kind = F.col("event_type")
    renamed = reduce(lambda c, old: c.when(kind == old, types[old]), types, F).otherwise(kind)
    return to_events(
        table,
        user_id=F.col("user_id"),
        ts=F.col("ts"),
        event_type=renamed,
        item_id=F.when(kind.isin(list(types)), F.get_json_object("props", "$.k")),
        event_id=F.col("event_id"),
    )


def read_table_events(spark: SparkSession, folder: str, flavour: str = "product") -> DataFrame:
    return table_events(read_event_table(spark, folder), flavour)
