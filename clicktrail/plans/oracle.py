"""The queries of `catalog` in DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

from clicktrail.functions.events import (
    DURATION_BUCKETS,
    RETURN_CATEGORIES,
    SEQUENCE_SEPARATOR,
    WEEKDAYS,
)

# Canonical events of the `events` table, product names and page names.
_EVENTS = """
e AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, ts,
         CASE event_type WHEN 'view' THEN '{view}' WHEN 'click' THEN '{click}' ELSE event_type END
           AS event_type,
         CASE WHEN event_type IN ('view', 'click', 'purchase')
              THEN json_extract_string(props, '$.k') END AS item_id,
         event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec
  FROM events)"""
PRODUCTS = _EVENTS.format(view="product_view", click="add_to_cart")
PAGES = _EVENTS.format(view="page_view", click="click")


def _nulled(column: str, every: int, events: str = PRODUCTS) -> str:
    """The events, every so many without a value in `column`."""
    renamed = events.replace("e AS (", "e0 AS (", 1)
    return f"""{renamed},
e AS (SELECT * REPLACE (CASE WHEN event_id % {every} <> 0 THEN {column} END AS {column}) FROM e0)"""


def _untimed(gap: int, frame: str) -> str:
    """Events labelled with sessions, one in ten without a time; untimed events come first."""
    rows = "PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id"
    ties = "PARTITION BY user_id ORDER BY ts NULLS FIRST"
    over = rows if frame == "ROWS" else ties
    return f"""WITH {_nulled("ts", 10)},
g AS (
  SELECT * REPLACE (CASE WHEN ts IS NOT NULL THEN sec END AS sec) FROM e),
d AS (
  SELECT *, lag(ts) OVER ({rows}) AS prev_ts, (sec - lag(sec) OVER ({rows})) / 60.0 AS gap_minutes FROM g),
f AS (
  SELECT *, CAST(CASE WHEN prev_ts IS NULL OR gap_minutes > {gap} THEN 1 ELSE 0 END AS BIGINT)
              AS new_session FROM d),
n AS (
  SELECT *, CAST(sum(new_session) OVER ({over}
                 {frame} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq FROM f)
SELECT {_EVENT_COLUMNS}, prev_ts, gap_minutes, new_session, session_seq,
       user_id || '_' || session_seq AS session_id FROM n"""


def _labelled(gap: int, events: str = PRODUCTS) -> str:
    """WITH list ending in `l`, the events with their session."""
    return f"""WITH {events},
g AS (
  SELECT *, lag(ts) OVER u AS prev_ts, (sec - lag(sec) OVER u) / 60.0 AS gap_minutes
  FROM e WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (
  SELECT *, CAST(CASE WHEN prev_ts IS NULL OR gap_minutes > {gap} THEN 1 ELSE 0 END AS BIGINT)
              AS new_session FROM g),
n AS (
  SELECT *, CAST(sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq FROM f),
l AS (SELECT *, concat_ws('_', user_id, session_seq) AS session_id FROM n)"""


def _sessions(gap: int, events: str = PRODUCTS) -> str:
    """WITH list ending in `t`, one row per session."""
    return f"""{_labelled(gap, events)},
t AS (
  SELECT user_id, session_id, min(ts) AS start_ts, max(ts) AS end_ts,
         max(sec) - min(sec) AS seconds, round((max(sec) - min(sec)) / 60.0, 2) AS minutes,
         count(*) AS n,
         count(*) FILTER (event_type = 'product_view') AS views,
         count(*) FILTER (event_type = 'add_to_cart') AS carts,
         count(*) FILTER (event_type = 'purchase') AS buys,
         count(DISTINCT item_id) AS products,
         string_agg(coalesce(item_id, ''), ',' ORDER BY ts, event_id) AS pages,
         coalesce(string_agg(CASE WHEN event_type = 'product_view' THEN item_id END, ','
                             ORDER BY ts, event_id), '') AS viewed,
         string_agg(event_type, ',' ORDER BY ts, event_id) AS steps,
         string_agg(event_type, '{SEQUENCE_SEPARATOR}' ORDER BY ts, event_id) AS sequence
  FROM l GROUP BY user_id, session_id)"""


_EVENT_COLUMNS = "user_id, ts, event_type, item_id, event_id"


def _sessionized(gap: int) -> str:
    return f"""{_labelled(gap)}
SELECT {_EVENT_COLUMNS}, prev_ts, gap_minutes, new_session, session_seq, session_id FROM l"""


def _scalar_metrics(gap: int) -> str:
    return f"""{_sessions(gap)}
SELECT user_id, session_id, start_ts, end_ts, seconds AS session_duration_seconds,
       n AS page_count FROM t"""


def _page_metrics(gap: int) -> str:
    return f"""{_sessions(gap, PAGES)}
SELECT user_id, session_id, start_ts, end_ts, seconds AS session_duration_seconds,
       n AS page_count, pages AS pages_visited FROM t"""


def _product_metrics(gap: int) -> str:
    return f"""{_sessions(gap)}
SELECT user_id, session_id, start_ts, end_ts, minutes AS session_duration_minutes,
       n AS event_count, products AS unique_products_viewed, carts AS items_added_to_cart,
       viewed AS products_viewed FROM t"""


def _item_parts(gap: int, size: int) -> str:
    return f"""{_labelled(gap)},
x AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS pos FROM l)
SELECT user_id, session_id, CAST((pos - 1) // {size} AS BIGINT) AS part,
       min(pos) AS first_position,
       string_agg(coalesce(item_id, ''), ',' ORDER BY pos) AS values
FROM x GROUP BY user_id, session_id, (pos - 1) // {size}"""


def _positions(gap: int) -> str:
    return f"""{_labelled(gap)},
x AS (SELECT event_type, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id)
        AS event_position FROM l)
SELECT event_type, event_position, count(*) AS count FROM x GROUP BY ALL"""


def _buckets(gap: int) -> str:
    instant, one, five, fifteen, longer = DURATION_BUCKETS
    return f"""{_sessions(gap)},
x AS (SELECT CASE WHEN minutes = 0 THEN 1 WHEN minutes <= 1 THEN 2 WHEN minutes <= 5 THEN 3
                  WHEN minutes <= 15 THEN 4 ELSE 5 END AS bucket_order FROM t)
SELECT CASE bucket_order WHEN 1 THEN '{instant}' WHEN 2 THEN '{one}' WHEN 3 THEN '{five}'
            WHEN 4 THEN '{fifteen}' ELSE '{longer}' END AS duration_bucket,
       CAST(bucket_order AS BIGINT) AS bucket_order, count(*) AS count
FROM x GROUP BY bucket_order"""


def _users(gap: int) -> str:
    return f"""{_sessions(gap)},
a AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS total_events, count(*) AS total_sessions,
             CAST(sum(buys) AS BIGINT) AS purchases, CAST(sum(carts) AS BIGINT) AS cart_adds
      FROM t GROUP BY user_id)"""


def _funnel(gap: int) -> str:
    return f"""{_sessions(gap)},
w AS (SELECT session_id, CAST(views > 0 AS BIGINT) AS reached_product,
             CAST(carts > 0 AS BIGINT) AS reached_cart,
             CAST(buys > 0 AS BIGINT) AS reached_purchase FROM t),
s AS (SELECT count(*) AS total_sessions, CAST(sum(reached_product) AS BIGINT) AS product_views,
             CAST(sum(reached_cart) AS BIGINT) AS cart_adds,
             CAST(sum(reached_purchase) AS BIGINT) AS purchases FROM w)"""


def _sequence_counts(gap: int) -> str:
    return f"""{_sessions(gap)}
SELECT sequence, count(*) AS count FROM t WHERE n > 1 GROUP BY sequence"""


def _products(cart_adds: str, extra: str = "", events: str = PRODUCTS) -> str:
    return f"""WITH {events}
SELECT item_id, count(*) FILTER (event_type = 'product_view') AS view_count,
       count(DISTINCT user_id) FILTER (event_type = 'product_view') AS unique_viewers,
       {cart_adds} AS cart_adds
FROM e WHERE item_id IS NOT NULL
GROUP BY item_id HAVING count(*) FILTER (event_type = 'product_view') > 0 {extra}"""


def _by_time(number: str, label: str, by_type: bool) -> str:
    kind = "event_type, " if by_type else ""
    return f"""WITH {PRODUCTS},
x AS (SELECT {kind}CAST({number} AS BIGINT) AS time_unit FROM e)
SELECT time_unit, {kind}count(*) AS count, {label} AS time_label FROM x GROUP BY ALL"""


_NUMBER_LABEL = "CAST(time_unit AS VARCHAR)"
_WEEKDAY_LABEL = (
    "CASE time_unit "
    + " ".join(f"WHEN {i} THEN '{day}'" for i, day in enumerate(WEEKDAYS, 1))
    + " END"
)

_GAPS = f"""WITH {PRODUCTS},
g AS (SELECT *, lag(ts) OVER u AS prev_ts, (sec - lag(sec) OVER u) / 3600.0 AS gap_hours
      FROM e WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
h AS (SELECT * FROM g WHERE gap_hours IS NOT NULL)"""

_RETURN_GAPS = f"""{_GAPS}
SELECT {_EVENT_COLUMNS}, prev_ts, gap_hours FROM h"""

_HISTOGRAM = f"""{_GAPS},
m AS (SELECT min(gap_hours) AS low, max(gap_hours) AS high FROM h),
x AS (SELECT low, high, CASE WHEN high = low THEN 1
        ELSE least(CAST(floor((gap_hours - low) / (high - low) * 50) AS BIGINT) + 1, 50) END AS bin
      FROM h, m)
SELECT CAST(bin AS BIGINT) AS bin, low + (high - low) / 50.0 * (bin - 1) AS bin_start,
       low + (high - low) / 50.0 * bin AS bin_end, count(*) AS count
FROM x GROUP BY bin, low, high"""

_CATEGORIES = f"""{_GAPS},
c AS (SELECT * FROM (VALUES ('{RETURN_CATEGORIES[0]}', 0, 1), ('{RETURN_CATEGORIES[1]}', 1, 24),
                            ('{RETURN_CATEGORIES[2]}', 24, 168),
                            ('{RETURN_CATEGORIES[3]}', 168, 1e300)) AS v(category, above, upto))
SELECT category, count(gap_hours) AS count
FROM c LEFT JOIN h ON gap_hours > above AND gap_hours <= upto GROUP BY category"""

_TRANSITIONS = f"""WITH {PRODUCTS},
x AS (SELECT event_type, lead(event_type) OVER (PARTITION BY item_id ORDER BY ts, event_id)
        AS next_event FROM e WHERE item_id IS NOT NULL)
SELECT event_type, next_event, count(*) AS count FROM x WHERE next_event IS NOT NULL GROUP BY ALL"""

_CARTS_ALL = "count(*) FILTER (event_type = 'add_to_cart')"
_CARTS_VIEWED = "count(*) FILTER (event_type = 'add_to_cart' AND event_type = 'product_view')"


# Lines of a faulty log: one in 23 isn't a record, one in 17 has no readable time, one in 19 has none.
_REJECTS = """SELECT CASE WHEN event_id % 23 = 0 THEN 'malformed' WHEN event_id % 17 = 0 THEN 'timestamp' ELSE 'event' END AS kind,
       count(*) AS lines, count(*) FILTER (event_id % 23 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0) AS timed
FROM events GROUP BY 1"""


def _readable(events: str) -> str:
    """The events of a faulty log that have a time."""
    renamed = events.replace("e AS (", "e0 AS (", 1)
    return f"""{renamed},
e AS (SELECT * FROM e0 WHERE event_id % 23 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0)"""


def oracle_sql() -> dict[str, str]:
    user_activity = f"{_users(720)} SELECT * FROM a"
    transitions = _TRANSITIONS
    event_sequences = f"""{_sessions(720)}
SELECT user_id, session_id, start_ts, end_ts, minutes AS duration_minutes, n AS events,
       steps AS event_sequence FROM t"""
    overview = """WITH {}
SELECT count(*) AS total_events,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM e)) AS unique_users,
       (SELECT count(*) FROM (SELECT DISTINCT item_id FROM e)) AS unique_products FROM e"""
    top_pages = f"""WITH {PAGES}
SELECT item_id AS page_id, count(*) AS views FROM e WHERE event_type = 'page_view'
GROUP BY item_id"""
    return {
        "sessionized_events_g30": _sessionized(30),
        "sessionized_events_rows_frame_g30": _sessionized(30),
        "sessionized_events_g720_split": _sessionized(720),
        "untimed_rows_frame_g30": _untimed(30, "ROWS"),
        "untimed_range_frame_g30": _untimed(30, "RANGE"),
        "dropped_events": "SELECT count(*) AS dropped_events FROM events WHERE ts IS NULL OR event_id % 10 = 0",
        "session_stats_null_user_g720": f"""{_sessions(720, _nulled("user_id", 7))}
SELECT session_id, start_ts, end_ts, minutes AS duration_minutes, n AS events,
       carts AS cart_adds FROM t""",
        "overview_totals_null_user": overview.format(_nulled("user_id", 7)),
        "overview_totals_null_item": overview.format(_nulled("item_id", 7)),
        "top_products_null_item": f"""WITH {_nulled("item_id", 7)}
SELECT item_id, count(*) AS views, count(DISTINCT user_id) AS unique_viewers
FROM e WHERE event_type = 'product_view' GROUP BY item_id""",
        "product_views_null_user": _products(_CARTS_VIEWED, events=_nulled("user_id", 7)),
        "json_log_rejects": _REJECTS,
        "csv_log_rejects": _REJECTS,
        "json_log_accepted_sessions_g720": f"""{_sessions(720, _readable(PAGES))}
SELECT user_id, session_id, start_ts, end_ts, n AS event_count FROM t""",
        "csv_log_accepted_sessions_g720": f"""{_sessions(720, _readable(PRODUCTS))}
SELECT user_id, session_id, start_ts, end_ts, n AS event_count FROM t""",
        "job_json_sessions_g720": _page_metrics(720),
        "job_json_top_pages": top_pages,
        "job_json_dropped_events": "SELECT count(*) AS dropped_events FROM events WHERE ts IS NULL",
        "job_csv_sessions_g720": _product_metrics(720),
        "job_csv_products": f"""SELECT item_id AS "ProductID", view_count, unique_viewers, cart_adds
FROM ({_products(_CARTS_VIEWED)})""",
        "missing_columns": """SELECT format, error, (SELECT count(*) FROM events) AS lines FROM (VALUES
  ('csv', 'CSV input lacks the columns [''Timestamp'', ''ProductID'']'),
  ('json', 'JSON input lacks the columns [''timestamp'', ''action'', ''page_id'']'),
  ('parquet', 'event table lacks the columns [''user_id'', ''ts'', ''event_type'', ''item_id'', ''event_id'']')
) AS v(format, error)""",
        "sessionized_events_bucketed_g720": _sessionized(720),
        "weekly_users_from_sketches": """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) AS events,
       true AS users_within_5_percent FROM events GROUP BY 1
UNION ALL SELECT 'all', count(*), true FROM events""",
        "sessionized_events_g720_many_hot": _sessionized(720),
        "session_pages_g720_many_hot": _page_metrics(720),
        "session_metrics_g30_many_hot": _scalar_metrics(30),
        "event_position_g720_many_hot": _positions(720),
        "user_return_gaps_many_hot": _RETURN_GAPS,
        "product_transitions_many_hot": transitions,
        "stored_sessions_g720": _scalar_metrics(720),
        "stored_sessions_late_g30": _scalar_metrics(30),
        "stored_sessions_late_g720": _scalar_metrics(720),
        "stored_session_stats_g720": f"""{_sessions(720)}
SELECT session_id, start_ts, end_ts, minutes AS duration_minutes, n AS events,
       carts AS cart_adds FROM t""",
        "stored_pages_late_g720": _page_metrics(720),
        "stored_products_late_g720": _product_metrics(720),
        "session_pages_g720_parts": _page_metrics(720),
        "session_product_metrics_g720_parts": _product_metrics(720),
        "event_sequences_g720_parts": event_sequences,
        "sequence_counts_g720_parts": _sequence_counts(720),
        "session_metrics_g30_split": _scalar_metrics(30),
        "session_summary_approx_users_g720": f"""{_sessions(720)}
SELECT count(*) AS total_sessions, true AS users_within_5_percent FROM t""",
        "json_log_mixed_timestamps": f"""WITH {PAGES}
SELECT user_id, event_type, item_id,
       CASE WHEN event_id < 2000 OR (event_id % 11 <> 0 AND event_id % 13 <> 0)
            THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS ts FROM e""",
        "events_parquet_round_trip": f"WITH {PRODUCTS} SELECT {_EVENT_COLUMNS} FROM e",
        "events_csv_round_trip": f"WITH {PRODUCTS} SELECT user_id, ts, event_type, item_id FROM e",
        "event_types_hourly": f"""WITH {PRODUCTS}
SELECT CAST(hour(ts) AS BIGINT) AS hour, event_type, count(*) AS count FROM e GROUP BY ALL""",
        "session_metrics_g30": _scalar_metrics(30),
        "session_metrics_g720": _scalar_metrics(720),
        "session_pages_g30": _page_metrics(30),
        "session_pages_g720": _page_metrics(720),
        "session_pages_g720_split": _page_metrics(720),
        "session_product_metrics_g720": _product_metrics(720),
        "session_product_metrics_g720_split": _product_metrics(720),
        "session_item_parts_g720": _item_parts(720, 4),
        "session_stats_g720": f"""{_sessions(720)}
SELECT session_id, start_ts, end_ts, minutes AS duration_minutes, n AS events,
       carts AS cart_adds FROM t""",
        "session_averages_g720": f"""{_sessions(720)}
SELECT round(avg(minutes), 2) AS avg_duration_min, round(avg(n), 2) AS avg_events,
       round(avg(carts), 2) AS avg_cart_adds FROM t""",
        "session_summary_g720": f"""{_sessions(720)}
SELECT count(*) AS total_sessions, round(avg(minutes), 2) AS avg_session_minutes,
       round(avg(n), 2) AS avg_events_per_session FROM t""",
        "json_log_sessions_g720": _page_metrics(720),
        "json_log_top_pages": top_pages,
        "csv_log_sessions_g720": _product_metrics(720),
        "csv_log_products": f"""SELECT item_id AS "ProductID", view_count, unique_viewers, cart_adds
FROM ({_products(_CARTS_VIEWED)})""",
        "top_pages": top_pages,
        "product_views": _products(_CARTS_VIEWED),
        "product_views_all_cart": _products(_CARTS_ALL),
        "top_products_10": f"""SELECT item_id, view_count AS views, unique_viewers, cart_adds
FROM ({_products(_CARTS_VIEWED, "ORDER BY view_count DESC, item_id LIMIT 10")})""",
        "top_products_5": _products(_CARTS_VIEWED, "ORDER BY view_count DESC, item_id LIMIT 5"),
        "top_products_with_null": f"""WITH {PRODUCTS}
SELECT item_id, count(*) AS views, count(DISTINCT user_id) AS unique_viewers
FROM e WHERE event_type = 'product_view' GROUP BY item_id""",
        "basic_totals_g30": f"""{_sessions(30)}
SELECT count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS total_sessions,
       CAST(sum(n) AS BIGINT) AS total_events FROM t""",
        "raw_totals": f"""WITH {PRODUCTS}
SELECT count(*) AS total_events,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM e)) AS unique_users FROM e""",
        "overview_totals": overview.format(PRODUCTS),
        "event_type_distribution": f"""WITH {PRODUCTS}
SELECT event_type, count(*) AS count FROM e GROUP BY event_type""",
        "user_activity_g720": user_activity,
        "engagement_g720": f"""{_users(720)}
SELECT count(user_id) AS total_users, avg(total_events) AS avg_events_per_user,
       avg(total_sessions) AS avg_sessions_per_user,
       count(*) FILTER (purchases > 0) AS users_with_purchase,
       count(*) FILTER (cart_adds > 0) AS users_with_cart_adds FROM a""",
        "event_position_g720": _positions(720),
        "event_position_g720_split": _positions(720),
        "duration_buckets_g720": _buckets(720),
        "funnel_flags_g720": f"{_funnel(720)} SELECT * FROM w",
        "funnel_totals_g720": f"{_funnel(720)} SELECT * FROM s",
        "funnel_rates_g720": f"""{_funnel(720)}
SELECT product_views / nullif(total_sessions, 0) * 100 AS product_view_rate,
       cart_adds / nullif(total_sessions, 0) * 100 AS add_to_cart_rate,
       purchases / nullif(total_sessions, 0) * 100 AS purchase_rate FROM s""",
        "event_sequences_g720": event_sequences,
        "sequence_counts_g720": _sequence_counts(720),
        "sequence_counts_g720_split": _sequence_counts(720),
        "top_sequences_10_g720": f"{_sequence_counts(720)} ORDER BY count DESC, sequence LIMIT 10",
        "top_sequences_10_by_digest_g720": f"{_sequence_counts(720)} ORDER BY count DESC, sequence LIMIT 10",
        "events_by_hour": _by_time("hour(ts)", _NUMBER_LABEL, False),
        "events_by_hour_by_type": _by_time("hour(ts)", _NUMBER_LABEL, True),
        "events_by_dow": _by_time("dayofweek(ts) + 1", _WEEKDAY_LABEL, False),
        "events_by_dow_by_type": _by_time("dayofweek(ts) + 1", _WEEKDAY_LABEL, True),
        "events_by_month": _by_time("month(ts)", _NUMBER_LABEL, False),
        "events_by_month_by_type": _by_time("month(ts)", _NUMBER_LABEL, True),
        "daily_activity": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS count
FROM events GROUP BY 1""",
        "user_return_gaps": _RETURN_GAPS,
        "user_return_gaps_split": _RETURN_GAPS,
        "return_histogram": _HISTOGRAM,
        "return_categories": _CATEGORIES,
        "product_event_counts": f"""WITH {PRODUCTS}
SELECT item_id, event_type, count(*) AS count FROM e WHERE item_id IS NOT NULL
GROUP BY item_id, event_type""",
        "product_transitions": transitions,
        "product_transitions_split": transitions,
        "event_profile": """SELECT count(*) AS row_count,
       count(*) FILTER (ts IS NULL) AS untimed_rows, CAST(6 AS BIGINT) AS column_count,
       'event_id,ts,user_id,event_type,value,props' AS columns,
       'struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>'
         AS schema FROM events""",
    }
