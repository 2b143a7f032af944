"""Plain-Python sessionization to compare with, for small inputs."""

import datetime as dt
from collections import defaultdict

EVENT_SCHEMA = "user_id string, ts timestamp, event_type string, item_id string, event_id bigint"
UTC = dt.timezone.utc
T0 = dt.datetime(2024, 3, 1, tzinfo=UTC)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def event(user, seconds, kind="product_view", item=None, event_id=None):
    return (user, at(seconds), kind, item, event_id)


def make_events(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def sort_value(value):
    return (value is not None, value if value is not None else 0)


def in_order(rows):
    return sorted(rows, key=lambda r: (
        (r[1] is not None, r[1].timestamp() if r[1] else 0), sort_value(r[4]),
        (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""),
    ))


def whole_second(ts):
    return int((ts - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(seconds=1))


def label(rows, gap_minutes, null_ts="drop"):
    """[(row, prev_ts, session_seq, position)] for all rows, in user order."""
    users = defaultdict(list)
    for row in rows:
        if row[1] is not None or null_ts != "drop":
            users[row[0]].append(row)
    result = []
    for own in users.values():
        untimed = sum(r[1] is None for r in own)
        previous, seq, position = None, 0, 0
        for row in in_order(own):
            ts = row[1]
            starts = ts is None or previous is None or (
                whole_second(ts) - whole_second(previous) > gap_minutes * 60
            )
            if starts:
                seq += 1
                position = 0
            if ts is None and null_ts == "keep_range" and seq > 1:
                position = seq - 1
            position += 1
            shown = untimed if ts is None and null_ts == "keep_range" else seq
            result.append((row, previous, shown, position))
            previous = ts
    return result


def session_id(user, seq):
    return str(seq) if user is None else f"{user}_{seq}"


def sessions(rows, gap_minutes, null_ts="drop"):
    """{(user, seq): [rows in order]}"""
    found = defaultdict(list)
    for row, _, seq, _ in label(rows, gap_minutes, null_ts):
        found[(row[0], seq)].append(row)
    return found
