"""Gap sessionization and the per-session tables built on it.

A session ends where a user's next event comes more than `gap_minutes` later,
counted in whole seconds. Sessions of a user are numbered from 1 in time order.

Two plans compute the same sessions:

* `session_table` needs totals only. It first adds up events per (user, time
  chunk as wide as the gap). Two events in one chunk are never more than the
  gap apart, so a session can only begin at a chunk's first event, and the
  window runs over chunks instead of events. A user has at most (time span /
  gap) chunks, however many events: ten years at 30 minutes are 175,320 rows.
  The span is measured; if it allows more than `hot_rows` chunks, the chunks
  themselves are put through `per_key_order`.
* `sessionize` labels every event and keeps the events in order, so it runs
  `per_key_order` over the events themselves.

Events without a timestamp (`null_ts`):

* `"drop"`: left out (count them with `event_profile`).
* `"keep_rows"`: each is a session of its own, before the user's other ones.
* `"keep_range"`: all of a user's k such events form one session numbered k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.functions.events import (
    ADD_TO_CART,
    DEFAULT_GAP_MINUTES,
    EVENT_ORDER,
    PRODUCT_VIEW,
    PURCHASE,
    SEQUENCE_SEPARATOR,
    TYPE_ORDER,
    check_gap,
    count_events,
    is_event,
    minutes_2dp,
    seconds_between,
    session_id,
)
from clicktrail.operators.ordered import (
    HOT_ROWS,
    Islands,
    KeySum,
    Ordered,
    Skew,
    per_key_order,
    rows_limit,
)

NULL_TS_POLICIES = ("drop", "keep_rows", "keep_range")
# Events per row of `session_item_parts`.
PART_SIZE = 100_000


def apply_null_ts(events: DataFrame, null_ts: str) -> DataFrame:
    if null_ts not in NULL_TS_POLICIES:
        raise ValueError(f"null_ts must be one of {NULL_TS_POLICIES}, got {null_ts!r}")
    return events.filter(F.col("ts").isNotNull()) if null_ts == "drop" else events


def dropped_events(events: DataFrame, null_ts: str = "drop") -> DataFrame:
    """One row: how many events `null_ts` leaves out of the sessions."""
    if null_ts not in NULL_TS_POLICIES:
        raise ValueError(f"null_ts must be one of {NULL_TS_POLICIES}, got {null_ts!r}")
    untimed = F.col("ts").isNull() if null_ts == "drop" else F.lit(False)
    return events.agg(F.count_if(untimed).alias("dropped_events"))


def _order(events: DataFrame) -> list[str]:
    """The order columns the events have: what no result shows, none carries."""
    return [c for c in EVENT_ORDER if c in events.columns]


# --- every event labelled with its session -----------------------------------


def _label(
    rows: Ordered,
    gap_minutes: int,
    null_ts: str,
    counted: Column | None = None,
    positions: bool = False,
) -> Ordered:
    """Add prev_ts, gap_minutes, new_session, session_seq, session_id.

    With `counted`, also _rank, the number of counted events of the user so
    far; with `positions`, also event_position, the same within the session:
    the rank less the user's rank just before the session.

    All windows share one sort by user and time, and slices exchange what they
    know in one pass.
    """
    check_gap(gap_minutes)
    untimed = F.col("ts").isNull()

    def gap(before: Column) -> Column:
        return seconds_between(before, F.col("ts")) / F.lit(60.0)

    def step(before: Column) -> Column:
        return F.when(before.isNull() | (gap(before) > gap_minutes), 1).otherwise(0)

    ranked = counted is not None
    if positions and not ranked:
        counted = F.lit(True)
    rows = rows.add(
        Islands(
            value=F.col("ts"), step=step, before="prev_ts", grows="new_session", number="session_seq",
            counted=None if counted is None else F.when(counted, 1).otherwise(0),
            rank="_rank" if ranked else None,
            position="event_position" if positions else None,
            # All of a user's untimed events are one session, counted from its first one.
            keeps=untimed if null_ts == "keep_range" else None,
        ),
        **({"_untimed": KeySum(F.when(untimed, 1).otherwise(0))} if null_ts == "keep_range" else {}),
    )
    rows = rows.with_column("gap_minutes", gap(F.col("prev_ts")))
    if null_ts == "keep_range":
        # They share the last of their ordinals.
        shared = F.when(untimed, F.col("_untimed")).otherwise(F.col("session_seq"))
        rows = rows.with_column("session_seq", shared)
    return rows.with_column("session_id", session_id())


def sessionize(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """The events with prev_ts, gap_minutes, new_session, session_seq, session_id."""
    added = ["prev_ts", "gap_minutes", "new_session", "session_seq", "session_id"]

    def build(rows: Ordered) -> DataFrame:
        return _label(rows, gap_minutes, null_ts).frame.select(*events.columns, *added)

    kept = apply_null_ts(events, null_ts)
    return per_key_order(kept, "user_id", _order(kept), build, hot_rows)


def event_positions(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """The events with session_id and their position in the session."""

    def build(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, positions=True).frame
        return labelled.select(*events.columns, "session_seq", "session_id", "event_position")

    kept = apply_null_ts(events, null_ts)
    return per_key_order(kept, "user_id", _order(kept), build, hot_rows)


# --- one row per session, totals only ----------------------------------------


def session_totals() -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        count_events(PRODUCT_VIEW).alias("product_views"),
        count_events(ADD_TO_CART).alias("cart_adds"),
        count_events(PURCHASE).alias("purchases"),
    ]


TOTALS = ["event_count", "product_views", "cart_adds", "purchases"]


def session_table(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """One row per session.

    Columns: user_id, session_seq, session_id, start_ts, end_ts,
    duration_seconds, duration_minutes (2 dp), event_count, product_views,
    cart_adds, purchases. Unused ones are pruned down to the scan.
    """
    gap_seconds = check_gap(gap_minutes)
    kept = apply_null_ts(events, null_ts)
    if null_ts == "keep_rows":
        # Untimed events become one session each, so they need numbers.
        labelled = sessionize(events, gap_minutes, null_ts, hot_rows)
        sessions = labelled.groupBy("user_id", "session_seq").agg(
            F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), *session_totals()
        )
        return finish_sessions(sessions)

    width = max(gap_seconds, 1)
    second = F.unix_timestamp("ts")
    chunks = (
        kept.withColumn("chunk", second - F.pmod(second, F.lit(width)))
        .groupBy("user_id", "chunk")
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), *session_totals())
    )

    def build(rows: Ordered) -> DataFrame:
        def step(prev_end: Column) -> Column:
            idle = seconds_between(prev_end, F.col("start_ts"))
            begins = F.when(idle <= gap_seconds, F.lit(0).cast("long")).otherwise(1)
            if null_ts == "keep_range":
                # The untimed events are the user's chunk NULL, sorted first.
                begins = F.when(F.col("chunk").isNull(), F.col("event_count")).otherwise(begins)
            return begins

        islands = Islands(F.col("end_ts"), step, before="prev_end", grows="begins", number="session_seq")
        numbered = rows.add(islands).frame
        return numbered.groupBy("user_id", "session_seq").agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            *[F.sum(name).alias(name) for name in TOTALS],
        )

    limit = None if hot_rows is None or _most_chunks(kept, width) <= rows_limit(hot_rows) else hot_rows
    return finish_sessions(per_key_order(chunks, "user_id", ["chunk"], build, limit))


def _most_chunks(events: DataFrame, width: int) -> int:
    """A bound on one user's chunks: those of the whole time span, and the untimed one."""
    second = F.unix_timestamp("ts")
    first, last = events.agg(F.min(second), F.max(second)).first()
    return 1 if first is None else (last - first) // width + 3


def _duration_seconds() -> Column:
    return seconds_between(F.col("start_ts"), F.col("end_ts"))


def finish_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "user_id",
        "session_seq",
        session_id().alias("session_id"),
        "start_ts",
        "end_ts",
        _duration_seconds().alias("duration_seconds"),
        minutes_2dp(_duration_seconds()).alias("duration_minutes"),
        *TOTALS,
    )


# --- one row per session, with lists -----------------------------------------


def _in_order(name: str, keep: Column | None, rank: str) -> Column:
    """The group's values of a column as a list, ordered by `rank`.

    Events for which `keep` is not true are left out before the collecting.
    """
    event = F.struct(rank, name)
    entry = event if keep is None else F.when(keep, event)
    return F.transform(F.array_sort(F.collect_list(entry)), lambda x: x[name])


def _part(size: int) -> Column:
    """Number of the session part an event falls into."""
    return F.floor((F.col("event_position") - 1) / F.lit(size)).alias("part")


def _sessions_with_list(
    events: DataFrame,
    gap_minutes: int,
    null_ts: str,
    hot_rows: int | Skew | None,
    counts: dict[str, Column],
    list_name: str,
    list_of: str,
    keep: Column | None = None,
    distinct: dict[str, str] | None = None,
    order: Sequence[str] = EVENT_ORDER,
) -> DataFrame:
    """One row per session: start_ts, end_ts, counts, distinct counts, a list.

    `counts` are counts, so that those of a session's parts add up. The lists of
    hot users are collected per part of `hot_rows` events and joined in the
    order of the parts, so no task sorts more than a part. A list too long for
    a row makes the job fail; `session_item_parts` gives it in parts.
    """
    keys = ["user_id", "session_seq"]
    spans = [F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts")]
    counted = [c.alias(n) for n, c in counts.items()]
    distinct = distinct or {}

    def plain(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, counted=F.lit(True)).frame
        unique = [F.size(F.collect_set(c)).cast("bigint").alias(n) for n, c in distinct.items()]
        items = _in_order(list_of, keep, "_rank").alias(list_name)
        return labelled.groupBy(*keys).agg(*spans, *counted, *unique, items)

    def sliced(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, positions=True).frame
        parts = labelled.groupBy(*keys, _part(rows_limit(hot_rows))).agg(
            *spans,
            *counted,
            *[F.collect_set(c).alias(n) for n, c in distinct.items()],
            _in_order(list_of, keep, "event_position").alias(list_name),
        )
        return parts.groupBy(*keys).agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            *[F.sum(n).alias(n) for n in counts],
            *[
                F.size(F.array_distinct(F.flatten(F.collect_list(n)))).cast("bigint").alias(n)
                for n in distinct
            ],
            F.flatten(_in_order(list_name, None, "part")).alias(list_name),
        )

    def build(rows: Ordered) -> DataFrame:
        return sliced(rows) if rows.hot else plain(rows)

    kept = apply_null_ts(events.select("user_id", *order), null_ts)
    return per_key_order(kept, "user_id", order, build, hot_rows).withColumn(
        "session_id", session_id()
    )


def session_pages(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """Session metrics with the ordered pages.

    `page_count` counts all events of the session, not only page views, and
    `pages_visited` has one entry per event.
    """
    counts = {"page_count": F.count("*")}
    sessions = _sessions_with_list(
        events, gap_minutes, null_ts, hot_rows, counts, "pages_visited", "item_id"
    )
    return sessions.select(
        "user_id",
        "session_id",
        "start_ts",
        "end_ts",
        _duration_seconds().alias("session_duration_seconds"),
        "page_count",
        "pages_visited",
    )


def session_products(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """Session metrics with the products.

    `unique_products_viewed` counts the products of all the session's events,
    whatever their type. `products_viewed` has the products of the view events
    in order, with repeats and without NULLs.
    """
    sessions = _sessions_with_list(
        events,
        gap_minutes,
        null_ts,
        hot_rows,
        {"event_count": F.count("*"), "items_added_to_cart": count_events(ADD_TO_CART)},
        "products_viewed",
        "item_id",
        keep=is_event(PRODUCT_VIEW) & F.col("item_id").isNotNull(),
        distinct={"unique_products_viewed": "item_id"},
    )
    return sessions.select(
        "user_id",
        "session_id",
        "start_ts",
        "end_ts",
        minutes_2dp(_duration_seconds()).alias("session_duration_minutes"),
        "event_count",
        "unique_products_viewed",
        "items_added_to_cart",
        "products_viewed",
    )


def session_sequences(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """Sessions with the list of their event types, in order, without NULLs."""
    sessions = _sessions_with_list(
        events,
        gap_minutes,
        null_ts,
        hot_rows,
        {"events": F.count("*")},
        "event_sequence",
        "event_type",
        keep=F.col("event_type").isNotNull(),
        order=TYPE_ORDER,
    )
    return sessions.select(
        "user_id",
        "session_id",
        "start_ts",
        "end_ts",
        minutes_2dp(_duration_seconds()).alias("duration_minutes"),
        "events",
        "event_sequence",
    )


def session_item_parts(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    value: str = "item_id",
    part_size: int = PART_SIZE,
    hot_rows: int | Skew | None = HOT_ROWS,
    keep: Column | None = None,
) -> DataFrame:
    """Every session's ordered values in parts of `part_size` events.

    Columns: user_id, session_id, part (from 0), first_position, values. The
    parts of a session, in order, are its whole list, however long. With `keep`
    only the values of events for which it is true are listed.
    """

    def build(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, positions=True).frame
        return (
            labelled.groupBy("user_id", "session_seq", _part(part_size))
            .agg(
                F.min("event_position").alias("first_position"),
                _in_order(value, keep, "event_position").alias("values"),
            )
            .select(
                "user_id", session_id().alias("session_id"), "part", "first_position", "values"
            )
        )

    kept = apply_null_ts(events.select("user_id", *{*EVENT_ORDER, value}), null_ts)
    return per_key_order(kept, "user_id", _order(kept), build, hot_rows)


def session_sequence_labels(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    null_ts: str = "drop",
    hot_rows: int | Skew | None = HOT_ROWS,
) -> DataFrame:
    """Per session its event sequence as text, and its number of steps.

    The texts of hot users are put together from parts of `hot_rows` steps.
    """
    typed = F.col("event_type").isNotNull()
    steps = F.count(F.when(typed, 1)).alias("steps")

    def text(rank: str) -> Column:
        return F.concat_ws(SEQUENCE_SEPARATOR, _in_order("event_type", typed, rank))

    def plain(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, counted=typed).frame
        sessions = labelled.groupBy("user_id", "session_seq")
        return sessions.agg(text("_rank").alias("sequence"), steps).select("sequence", "steps")

    def sliced(rows: Ordered) -> DataFrame:
        labelled = _label(rows, gap_minutes, null_ts, counted=typed, positions=True).frame
        # A part without steps adds no text: NULL, which the list leaves out.
        parts = labelled.groupBy("user_id", "session_seq", _part(rows_limit(hot_rows))).agg(
            F.when(steps > 0, text("event_position")).alias("text"), steps
        )
        whole = _in_order("text", F.col("text").isNotNull(), "part")
        return (
            parts.groupBy("user_id", "session_seq")
            .agg(F.concat_ws(SEQUENCE_SEPARATOR, whole).alias("sequence"), F.sum("steps").alias("steps"))
            .select("sequence", "steps")
        )

    def build(rows: Ordered) -> DataFrame:
        return sliced(rows) if rows.hot else plain(rows)

    kept = apply_null_ts(events.select("user_id", *TYPE_ORDER), null_ts)
    return per_key_order(kept, "user_id", TYPE_ORDER, build, hot_rows)
