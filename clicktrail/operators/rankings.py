"""Page and product rankings, and totals over plain events.

All of these take events without sessions, so filters and column choices reach
the scan, and every count is summed up before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.events import (
    ADD_TO_CART,
    PAGE_VIEW,
    PRODUCT_VIEW,
    count_events,
    is_event,
)

CART_SCOPES = ("viewed_rows", "all_events")


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def top_pages(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Page views per page, most viewed first; views of no page are kept."""
    pages = (
        events.filter(is_event(PAGE_VIEW))
        .groupBy(F.col("item_id").alias("page_id"))
        .agg(F.count("*").alias("views"))
        .orderBy(F.desc("views"), "page_id")
    )
    return _limited(pages, limit)


def product_views(
    events: DataFrame, cart_scope: str = "viewed_rows", limit: int | None = None
) -> DataFrame:
    """Views, distinct viewers and cart adds per product, most viewed first.

    `cart_scope="viewed_rows"` counts cart adds among the view events, which is
    always 0; `"all_events"` counts the product's add-to-cart events. Products
    without a view are left out in both.
    """
    if cart_scope not in CART_SCOPES:
        raise ValueError(f"cart_scope must be one of {CART_SCOPES}, got {cart_scope!r}")
    types = [PRODUCT_VIEW] if cart_scope == "viewed_rows" else [PRODUCT_VIEW, ADD_TO_CART]
    viewed = is_event(PRODUCT_VIEW)
    # One row per (product, user) first, so that the distinct count needs no
    # expansion and a hot product is spread over its users.
    per_viewer = (
        events.filter(F.col("event_type").isin(types) & F.col("item_id").isNotNull())
        .groupBy("item_id", "user_id")
        .agg(count_events(PRODUCT_VIEW).alias("views"), count_events(ADD_TO_CART).alias("adds"))
    )
    products = (
        per_viewer.groupBy("item_id")
        .agg(
            F.sum("views").alias("view_count"),
            F.count(F.when(F.col("views") > 0, F.col("user_id"))).alias("unique_viewers"),
            F.sum("adds").alias("cart_adds"),
        )
        .filter(F.col("view_count") > 0)
        .orderBy(F.desc("view_count"), "item_id")
    )
    return _limited(products, limit)


def top_products(events: DataFrame, limit: int = 10, cart_scope: str = "viewed_rows") -> DataFrame:
    """The `limit` most viewed products: item_id, views, unique_viewers, cart_adds."""
    ranked = product_views(events, cart_scope).withColumnRenamed("view_count", "views")
    return ranked.limit(limit)


def viewed_products(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Views and distinct viewers per product; views of no product form a group."""
    products = (
        events.filter(is_event(PRODUCT_VIEW))
        .groupBy("item_id", "user_id")
        .agg(F.count("*").alias("views"))
        .groupBy("item_id")
        .agg(F.sum("views").alias("views"), F.count("user_id").alias("unique_viewers"))
        .orderBy(F.desc("views"), "item_id")
    )
    return _limited(products, limit)


def _distinct_with_null(name: str) -> Column:
    """Number of distinct values, NULL being one of them; 0 without rows."""
    has_null = F.coalesce(F.max(F.when(F.col(name).isNull(), 1).otherwise(0)), F.lit(0))
    return F.count_distinct(F.col(name)) + has_null


def raw_totals(events: DataFrame) -> DataFrame:
    """total_events and unique_users, a NULL user counting as one."""
    return events.agg(
        F.count("*").alias("total_events"),
        _distinct_with_null("user_id").alias("unique_users"),
    )


def overview_totals(events: DataFrame) -> DataFrame:
    """total_events, unique_users, unique_products; NULL counts as a value.

    The two distinct counts are aggregations of their own, as Spark would write
    each row three times to do both in one.
    """
    products = events.agg(_distinct_with_null("item_id"))
    return raw_totals(events).withColumn("unique_products", products.scalar())


def event_type_distribution(events: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    return events.groupBy("event_type").count().orderBy(F.desc("count"), "event_type")
