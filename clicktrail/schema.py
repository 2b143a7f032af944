"""The canonical event table every operator takes.

| column     | type      | meaning                                        |
|------------|-----------|------------------------------------------------|
| user_id    | string    | who; NULL is a user of its own                 |
| ts         | timestamp | when; NULL where the source text is no instant |
| event_type | string    | what                                           |
| item_id    | string    | the page or product, NULL if none              |
| event_id   | bigint    | breaks ties of `ts`; NULL if the source has none |

More columns may follow; operators that return events pass them through.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_COLUMNS = ["user_id", "ts", "event_type", "item_id", "event_id"]


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """`df` itself, or a ValueError that names every column it lacks."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def to_events(
    df: DataFrame,
    *,
    user_id: Column,
    ts: Column,
    event_type: Column,
    item_id: Column,
    event_id: Column | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Project any table onto the canonical columns, followed by `keep`."""
    return df.select(
        user_id.cast("string").alias("user_id"),
        ts.cast("timestamp").alias("ts"),
        event_type.cast("string").alias("event_type"),
        item_id.cast("string").alias("item_id"),
        (F.lit(None) if event_id is None else event_id).cast("bigint").alias("event_id"),
        *keep,
    )
