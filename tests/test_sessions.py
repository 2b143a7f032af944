"""Sessionization rules, on small fixtures and against plain Python."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from clicktrail.operators import behavior
from clicktrail.operators import sessions as s
from clicktrail.operators.ordered import Skew
from clicktrail.sources.event_table import read_table_events
from tests.brute import event, label, make_events, session_id, sessions, whole_second

TESTDATA = "/root/testdata/sf0.01"
KINDS = ["product_view", "add_to_cart", "purchase", "signup", None]


def skewed_rows(seed=1):
    """Bot with a third of the rows, copies, ties, NULL users, times and items."""
    rnd = random.Random(seed)
    rows = []

    def one(user, seconds):
        kind = rnd.choice(KINDS)
        item = rnd.choice([None, "a", "b", "c", "d"])
        rows.append(event(user, seconds, kind, item, rnd.choice([None, rnd.randrange(50)])))

    for _ in range(250):
        one("bot", rnd.randrange(0, 40_000) + rnd.choice([0, 0.25, 0.9]))
    for _ in range(60):  # one burst, and copies of one row
        one("bot", 50_000)
        rows.append(event("bot", 60_000, "product_view", "a", 7))
    for _ in range(90):
        rows.append(event(None, 60_000, "add_to_cart", "b", None))
        one(None, rnd.randrange(0, 400_000))
    for _ in range(50):
        rows.append(event("bot", None, rnd.choice(KINDS), "a", rnd.randrange(5)))
    for n in range(30):
        for _ in range(rnd.randrange(1, 14)):
            one(f"u{n}", rnd.choice([None, rnd.randrange(0, 30_000), rnd.randrange(0, 90_000)]))
    rnd.shuffle(rows)
    return rows


ROWS = skewed_rows()


@pytest.fixture(scope="module")
def skewed(spark):
    return make_events(spark, ROWS).repartition(6).cache()


def test_sample_log(spark):
    rows = [
        event("ann", 30, "page_view", "start"), event("ann", 75, "page_view", "help"),
        event("ann", 75 + 1801, "page_view", "start"), event("bob", 10, "signup", None),
        event("bob", 1200, "page_view", "prices"), event("bob", 2900, "page_view", "start"),
    ]
    found = s.session_pages(make_events(spark, rows)).orderBy("session_id").collect()
    assert [(r.session_id, r.page_count, r.session_duration_seconds, r.pages_visited) for r in found] == [
        ("ann_1", 2, 45, ["start", "help"]),
        ("ann_2", 1, 0, ["start"]),
        ("bob_1", 3, 2890, [None, "prices", "start"]),
    ]


@pytest.mark.parametrize("plan", ["table", "events"])
def test_gap_counts_whole_seconds(spark, plan):
    rows = [
        event("a", 0), event("a", 1800), event("b", 0), event("b", 1800.9),
        event("c", 0.9), event("c", 1801), event("d", 0), event("d", 1801),
    ]
    events = make_events(spark, rows)
    if plan == "table":
        frame = s.session_table(events)
    else:
        frame = s.sessionize(events).select("user_id", "session_seq").distinct()
    counts = {r.user_id: r["count"] for r in frame.groupBy("user_id").count().collect()}
    assert counts == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_untimed_events(spark):
    rows = [event("u", None, event_id=i) for i in range(3)] + [event("u", 0), event("u", 0), event("u", 600)]
    events = make_events(spark, rows)

    def ordinals(null_ts):
        return sorted(r.session_seq for r in s.sessionize(events, 30, null_ts).collect())

    assert ordinals("keep_rows") == [1, 2, 3, 4, 4, 4]
    assert ordinals("keep_range") == [3, 3, 3, 4, 4, 4]
    assert ordinals("drop") == [1, 1, 1]
    for null_ts, expected in {"drop": [(1, 3)], "keep_range": [(3, 3), (4, 3)],
                              "keep_rows": [(1, 1), (2, 1), (3, 1), (4, 3)]}.items():
        table = s.session_table(events, 30, null_ts).collect()
        assert sorted((r.session_seq, r.event_count) for r in table) == expected


def test_null_user_is_one_user(spark):
    found = s.sessionize(make_events(spark, [event(None, 0), event(None, 60), event("", 0)])).collect()
    assert sorted(r.session_id for r in found) == ["1", "1", "_1"]


@pytest.mark.parametrize("gap", [-1, 1.5, True])
def test_bad_gap(spark, gap):
    with pytest.raises(ValueError):
        s.session_table(make_events(spark, [event("a", 0)]), gap)
    with pytest.raises(ValueError):
        s.sessionize(make_events(spark, [event("a", 0)]), gap)


def test_bad_null_policy(spark):
    with pytest.raises(ValueError):
        s.sessionize(make_events(spark, [event("a", 0)]), 30, "ignore")


@pytest.mark.parametrize("null_ts", s.NULL_TS_POLICIES)
@pytest.mark.parametrize("hot_rows", [None, 1000, 40, 3])
def test_sessionize_matches_plain_python(skewed, null_ts, hot_rows):
    gap = 12
    found = s.sessionize(skewed, gap, null_ts, hot_rows).select(
        "user_id", F.unix_micros("ts"), "session_id", F.unix_micros("prev_ts"), "new_session", "gap_minutes"
    )
    expected = []
    for row, previous, seq, _ in label(ROWS, gap, null_ts):
        minutes = None
        if row[1] is not None and previous is not None:
            minutes = (whole_second(row[1]) - whole_second(previous)) / 60.0
        starts = int(minutes is None or minutes > gap)
        ids = (row[0], micros(row[1]), session_id(row[0], seq))
        expected.append((*ids, micros(previous), starts, minutes))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def micros(ts):
    return None if ts is None else round(ts.timestamp() * 1_000_000)


@pytest.mark.parametrize("null_ts", s.NULL_TS_POLICIES)
@pytest.mark.parametrize("gap", [0, 1, 12, 720])
@pytest.mark.parametrize("hot_rows", [s.HOT_ROWS, 30])
def test_session_table_matches_plain_python(skewed, null_ts, gap, hot_rows):
    # With a row limit of 30, the chunks of gaps 0, 1 and 12 take the sliced plan.
    found = {
        (r.user_id, r.session_seq): (r.session_id, r.event_count, r.cart_adds, r.purchases, r.product_views, r.duration_seconds)
        for r in s.session_table(skewed, gap, null_ts, hot_rows).collect()
    }
    expected = {}
    for (user, seq), own in sessions(ROWS, gap, null_ts).items():
        times = [whole_second(r[1]) for r in own if r[1] is not None]
        kinds = [r[2] for r in own]
        expected[(user, seq)] = (
            session_id(user, seq), len(own), kinds.count("add_to_cart"), kinds.count("purchase"),
            kinds.count("product_view"), max(times) - min(times) if times else None,
        )
    assert found == expected


@pytest.mark.parametrize("null_ts", s.NULL_TS_POLICIES)
@pytest.mark.parametrize("hot_rows", [None, 40, 3])
def test_positions_match_plain_python(skewed, null_ts, hot_rows):
    found = s.event_positions(skewed, 12, null_ts, hot_rows)
    seen = found.groupBy("session_id", "event_position", "event_type", "item_id").count().collect()
    expected = sorted(
        str((session_id(row[0], seq), position, row[2], row[3], 1))
        for row, _, seq, position in label(ROWS, 12, null_ts)
    )
    assert sorted(str(tuple(r)) for r in seen) == expected


@pytest.mark.parametrize("hot_rows", [None, 200, 40, 3])
def test_lists_match_plain_python(skewed, hot_rows):
    gap = 12
    groups = sessions(ROWS, gap)
    pages = {r.session_id: r.pages_visited for r in s.session_pages(skewed, gap, hot_rows=hot_rows).collect()}
    assert pages == {
        session_id(*k): [r[3] for r in own] for k, own in groups.items()
    }
    products = {
        r.session_id: (r.event_count, r.unique_products_viewed, r.items_added_to_cart, r.products_viewed)
        for r in s.session_products(skewed, gap, hot_rows=hot_rows).collect()
    }
    assert products == {
        session_id(*k): (
            len(own), len({r[3] for r in own} - {None}), sum(r[2] == "add_to_cart" for r in own),
            [r[3] for r in own if r[2] == "product_view" and r[3] is not None],
        )
        for k, own in groups.items()
    }
    sequences = {
        r.session_id: (r.events, r.event_sequence)
        for r in s.session_sequences(skewed, gap, hot_rows=hot_rows).collect()
    }
    assert sequences == {
        session_id(*k): (len(own), [r[2] for r in own if r[2] is not None])
        for k, own in groups.items()
    }


@pytest.mark.parametrize("hot_rows", [None, 2000, 100])
def test_user_over_many_years(spark, hot_rows):
    """22 years and stray times: the chunks are counted, not assumed."""
    day = 86_400
    rows = [event("old", n * 30 * day) for n in range(270)] + [event("old", n * 30 * day + 60) for n in range(270)]
    rows += [event("stray", 0), event("stray", 7000 * 365 * day), event("stray", -1900 * 365 * day)]
    table = s.session_table(make_events(spark, rows), 30, hot_rows=hot_rows)
    assert {r.user_id: r["count"] for r in table.groupBy("user_id").count().collect()} == {"old": 270, "stray": 3}
    assert table.agg(F.sum("event_count")).first()[0] == len(rows)


def test_slices_only_where_the_span_needs_them(spark, monkeypatch):
    limits = []
    real = s.per_key_order
    monkeypatch.setattr(s, "per_key_order", lambda *args: limits.append(args[-1]) or real(*args))
    events = make_events(spark, [event("u", 0), event("u", 10 * 1800)])
    s.session_table(events, 30, hot_rows=13)
    s.session_table(events, 30, hot_rows=12)
    assert limits == [None, 12]


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_map_columns_pass_through(spark, hot_rows):
    rows = [("u", n % 5, {"a": n % 2, "b": 1} if n % 3 else None, [{"k": n % 2}]) for n in range(20)] * 2
    frame = spark.createDataFrame(rows, "user_id string, t int, props map<string,int>, more array<map<string,int>>")
    events = frame.select(
        "user_id", F.timestamp_seconds("t").alias("ts"), F.lit("x").alias("event_type"),
        F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("bigint").alias("event_id"), "props", "more",
    )
    found = s.sessionize(events, 30, hot_rows=hot_rows)
    assert sorted(str((r.props, r.more)) for r in found.collect()) == sorted(str((r[2], r[3])) for r in rows)
    assert found.agg(F.sum("new_session")).first()[0] == 1
    gaps = behavior.user_return_gaps(events, hot_rows)
    assert gaps.count() == len(rows) - 1


def test_dropped_events(spark):
    events = make_events(spark, [event("a", None), event("a", 1), event(None, None)])
    assert [s.dropped_events(events, policy).first()[0] for policy in s.NULL_TS_POLICIES] == [2, 0, 0]
    with pytest.raises(ValueError, match="null_ts"):
        s.dropped_events(events, "other")


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_parts_of_chosen_events(skewed, hot_rows):
    keep = F.col("event_type") == "purchase"
    parts = s.session_item_parts(skewed, 12, part_size=7, hot_rows=hot_rows, keep=keep).collect()
    whole = {}
    for r in sorted(parts, key=lambda r: (r.session_id, r.part)):
        whole.setdefault(r.session_id, []).extend(r["values"])
    assert whole == {
        session_id(*k): [r[3] for r in own if r[2] == "purchase"] for k, own in sessions(ROWS, 12).items()
    }


@pytest.mark.parametrize("hot_rows", [None, 40, 3])
def test_parts_are_whole_lists(skewed, hot_rows):
    parts = s.session_item_parts(skewed, 12, part_size=7, hot_rows=hot_rows).collect()
    whole = {}
    for r in sorted(parts, key=lambda r: (r.session_id, r.part)):
        assert len(r["values"]) <= 7
        assert r.first_position == r.part * 7 + 1
        whole.setdefault(r.session_id, []).extend(r["values"])
    assert whole == {session_id(*k): [r[3] for r in own] for k, own in sessions(ROWS, 12).items()}


@pytest.mark.parametrize("gap", [30, 240, 720])
def test_session_window_finds_the_same_sessions(spark, gap):
    events = read_table_events(spark, TESTDATA)
    own = s.session_table(events, gap).select("user_id", "start_ts", "end_ts", "event_count")
    other = (
        events.withColumn("second", F.date_trunc("second", "ts"))
        .groupBy("user_id", F.session_window("second", f"{gap} minutes"))
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("event_count"))
        .drop("session_window")
    )
    assert own.exceptAll(other).isEmpty() and other.exceptAll(own).isEmpty()


def test_invariants(spark):
    events = read_table_events(spark, TESTDATA)
    total = events.count()
    labelled = s.sessionize(events, 240)
    assert labelled.count() == total
    inside = labelled.filter("new_session = 0").agg(F.max("gap_minutes")).first()[0]
    between = labelled.filter("new_session = 1").agg(F.min("gap_minutes")).first()[0]
    assert inside <= 240 < between
    counts = [s.session_table(events, gap).count() for gap in (0, 30, 240, 720, 100_000)]
    assert counts == sorted(counts, reverse=True)
    assert counts[-1] == events.select("user_id").distinct().count()
    assert s.session_table(events, 240).agg(F.sum("event_count")).first()[0] == total


@pytest.mark.parametrize("hot_rows", [None, 40, Skew(40, 0)])
def test_extra_columns_of_clashing_names(skewed, hot_rows):
    """Source columns may have any name that isn't the operators' own."""
    names = ["first", "last", "count", "growth", "begun", "total", "k", "f", "v", "rank", "position"]
    wide = skewed.select("*", *[F.concat(F.lit(f"{name} "), F.coalesce("item_id", F.lit("none"))).alias(name) for name in names])
    found = s.event_positions(wide, 12, hot_rows=hot_rows)
    plain = s.event_positions(skewed, 12, hot_rows=None)
    rows = found.select(*plain.columns)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    wrong = [F.col(f"`{name}`") != F.concat(F.lit(f"{name} "), F.coalesce("item_id", F.lit("none"))) for name in names]
    assert found.where(functools.reduce(lambda a, b: a | b, wrong)).isEmpty()
