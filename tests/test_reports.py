"""Reports, rankings and behaviour on small fixtures."""

import pytest
from pyspark.sql import functions as F

from clicktrail.functions.events import DURATION_BUCKETS, duration_bucket, minutes_2dp
from clicktrail.operators import behavior as b
from clicktrail.operators import rankings as r
from clicktrail.operators import reports as p
from clicktrail.operators import sessions as s
from clicktrail.plans import analyses
from clicktrail.sources.event_table import read_table_events
from tests.brute import event, make_events
from tests.test_sessions import ROWS, sessions


@pytest.fixture(scope="module")
def skewed(spark):
    return make_events(spark, ROWS).repartition(6).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return make_events(spark, [])


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_duration_buckets(spark):
    seconds = spark.createDataFrame([(x,) for x in (0, 1, 60, 61, 300, 301, 900, 901, None)], "x int")
    counts = dict(tuples(
        seconds.groupBy(duration_bucket(minutes_2dp(F.col("x"))).alias("bucket")).count()
    ))
    assert [counts[label] for label in DURATION_BUCKETS] == [1, 2, 2, 2, 2]


def test_return_categories(spark):
    hours = [0, 0.5, 1.0, 1.5, 24.0, 200]
    rows = []
    for n, gap in enumerate(hours):
        rows += [event(f"u{n}", 0), event(f"u{n}", gap * 3600)]
    found = tuples(b.return_categories(make_events(spark, rows)))
    assert found == [("Same Day", 2), ("Same Hour", 2), ("Longer", 1), ("Same Week", 0)]


def test_return_histogram(spark):
    rows = [event("a", 0), event("a", 3600), event("a", 3 * 3600), event("b", 0), event("b", 11 * 3600)]
    events = make_events(spark, rows)
    found = {x.bin: x["count"] for x in b.return_histogram(events).collect()}
    assert found == {1: 1, 6: 1, 50: 1}
    assert sum(found.values()) == b.user_return_gaps(events).count()
    same = make_events(spark, [event("a", 0), event("a", 60), event("a", 120)])
    assert tuples(b.return_histogram(same)) == [(1, 60 / 3600, 60 / 3600, 2)]
    with pytest.raises(ValueError):
        b.return_histogram(events, 0)


def test_gaps_skip_untimed_events(spark):
    events = make_events(spark, [event("a", None), event("a", 0), event("a", None), event("a", 7200)])
    assert [(x.gap_hours) for x in b.user_return_gaps(events).collect()] == [2.0]


@pytest.mark.parametrize("hot_rows", [None, 40, 3])
def test_behaviour_is_the_same_sliced(skewed, hot_rows):
    plain = {
        "gaps": b.user_return_gaps(skewed, None).orderBy(*["user_id", "ts", "event_id", "event_type", "item_id"]),
        "histogram": b.return_histogram(skewed, hot_rows=None).orderBy("bin"),
        "categories": b.return_categories(skewed, None),
        "transitions": b.product_transitions(skewed, None).orderBy("event_type", "next_event"),
        "sequences": p.sequence_counts(skewed, 12, hot_rows=None).orderBy("sequence"),
        "positions": p.event_position_counts(skewed, 12, hot_rows=None),
    }
    sliced = {
        "gaps": b.user_return_gaps(skewed, hot_rows).orderBy(*["user_id", "ts", "event_id", "event_type", "item_id"]),
        "histogram": b.return_histogram(skewed, hot_rows=hot_rows).orderBy("bin"),
        "categories": b.return_categories(skewed, hot_rows),
        "transitions": b.product_transitions(skewed, hot_rows).orderBy("event_type", "next_event"),
        "sequences": p.sequence_counts(skewed, 12, hot_rows=hot_rows).orderBy("sequence"),
        "positions": p.event_position_counts(skewed, 12, hot_rows=hot_rows),
    }
    for name in plain:
        got, want = sorted(map(str, tuples(sliced[name]))), sorted(map(str, tuples(plain[name])))
        assert got == want, name


def test_long_sequences_are_whole(spark):
    rows = []
    for user, kinds in {"a": "xyxyxyx", "b": "xyxyxyx", "c": "xyxyxyy", "d": "xy"}.items():
        rows += [event(user, i, kind) for i, kind in enumerate(kinds)]
        rows.append(event(user, 2.5 if user == "a" else 4.5, None))  # untyped: not a step
    rows += [event("e", i, None) for i in range(9)] + [event("e", 9, "z"), event("e", 10, "z")]
    counts = dict(tuples(p.sequence_counts(make_events(spark, rows), 30, hot_rows=3)))
    joined = {kinds: " → ".join(kinds) for kinds in ("xyxyxyx", "xyxyxyy", "xy", "zz")}
    assert counts == {joined["xyxyxyx"]: 2, joined["xyxyxyy"]: 1, joined["xy"]: 1, joined["zz"]: 1}


def test_sequences_and_positions(skewed):
    gap = 12
    expected = {}
    for own in sessions(ROWS, gap).values():
        kinds = [x[2] for x in own if x[2] is not None]
        if len(kinds) > 1:
            text = " → ".join(kinds)
            expected[text] = expected.get(text, 0) + 1
    counts = p.sequence_counts(skewed, gap)
    assert dict(tuples(counts)) == expected
    assert p.event_position_counts(skewed, gap, limit=3).count() == 3
    best = sorted(expected.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert tuples(p.top_sequences(counts)) == best


def test_product_views(spark):
    rows = [
        event("u", 0, "product_view", "p"), event("u", 1, "product_view", "p"),
        event("u", 2, "add_to_cart", "p"), event("v", 3, "product_view", None),
        event(None, 4, "product_view", "q"), event("w", 5, "add_to_cart", "only-carted"),
    ]
    events = make_events(spark, rows)
    assert tuples(r.product_views(events)) == [("p", 2, 1, 0), ("q", 1, 0, 0)]
    assert tuples(r.product_views(events, "all_events")) == [("p", 2, 1, 1), ("q", 1, 0, 0)]
    assert tuples(r.top_products(events, 1)) == [("p", 2, 1, 0)]
    assert tuples(r.viewed_products(events)) == [("p", 2, 1), (None, 1, 1), ("q", 1, 0)]
    assert tuples(r.viewed_products(events, 1)) == [("p", 2, 1)]
    with pytest.raises(ValueError):
        r.product_views(events, "some")


def test_top_pages(spark):
    rows = [event("u", i, "page_view", x) for i, x in enumerate(["a", "b", "b", None])]
    rows.append(event("u", 9, "click", "a"))
    assert tuples(r.top_pages(make_events(spark, rows))) == [("b", 2), (None, 1), ("a", 1)]
    assert tuples(r.top_pages(make_events(spark, rows), 1)) == [("b", 2)]


def test_distinct_counts_with_and_without_null(spark):
    rows = [event("u", 0, item="a"), event(None, 1, item="b"), event(None, 2)]
    events = make_events(spark, rows)
    assert tuples(r.raw_totals(events)) == [(3, 2)]
    assert tuples(r.overview_totals(events)) == [(3, 2, 3)]
    assert tuples(p.basic_totals(s.session_table(events))) == [(1, 2, 3)]


def test_untimed_events_in_totals(spark):
    rows = [event("u", None), event("u", None), event("u", 0), event("v", 0)]
    events = make_events(spark, rows)
    totals = {
        policy: tuples(p.basic_totals(s.session_table(events, 30, policy)))[0]
        for policy in s.NULL_TS_POLICIES
    }
    assert totals == {"drop": (2, 2, 2), "keep_rows": (2, 4, 4), "keep_range": (2, 3, 4)}
    buckets = tuples(p.duration_distribution(s.session_table(events, 30, "keep_range")))
    assert buckets == [("Instant", 1, 2), ("> 15 mins", 5, 1)]


def test_funnel(spark):
    rows = [
        event("a", 0, "product_view"), event("a", 1, "add_to_cart"), event("a", 2, "add_to_cart"),
        event("b", 0, "purchase"), event("c", 0, "signup"), event("d", 0, "product_view"),
    ]
    table = s.session_table(make_events(spark, rows))
    assert sorted(tuples(p.funnel_flags(table))) == [
        ("a_1", 1, 1, 0), ("b_1", 0, 0, 1), ("c_1", 0, 0, 0), ("d_1", 1, 0, 0)
    ]
    assert tuples(p.funnel_totals(table)) == [(4, 2, 1, 1)]
    assert tuples(p.funnel_rates(table)) == [(50.0, 25.0, 25.0)]
    assert tuples(p.engagement(table)) == [(4, 1.5, 1.0, 1, 1)]


def test_empty_input(empty):
    table = s.session_table(empty)
    assert tuples(p.funnel_totals(table)) == [(0, 0, 0, 0)]
    assert tuples(p.funnel_rates(table)) == [(None, None, None)]
    assert tuples(p.session_averages(table)) == [(None, None, None)]
    assert tuples(p.session_summary(table)) == [(0, 0, None, None)]
    assert tuples(p.basic_totals(table)) == [(0, 0, 0)]
    assert tuples(p.engagement(table)) == [(0, None, None, 0, 0)]
    assert tuples(r.raw_totals(empty)) == [(0, 0)]
    assert tuples(r.overview_totals(empty)) == [(0, 0, 0)]
    assert [x[1] for x in tuples(b.return_categories(empty))] == [0, 0, 0, 0]
    for frame in (s.session_pages(empty), b.return_histogram(empty), p.sequence_counts(empty)):
        assert frame.isEmpty()


def test_time_units(spark):
    # 2024-03-01 was a Friday.
    events = make_events(spark, [event("a", 0), event("a", 3600), event("b", 86400 * 31), event("c", None)])
    hours = tuples(b.events_by_time(events))
    assert hours == [(None, 1, None), (0, 2, "0"), (1, 1, "1")]
    days = tuples(b.events_by_time(events, "day_of_week"))
    assert days == [(None, 1, None), (2, 1, "Mon"), (6, 2, "Fri")]
    assert tuples(b.events_by_time(events, "month")) == [(None, 1, None), (3, 2, "3"), (4, 1, "4")]
    assert tuples(b.daily_activity(events)) == [(None, 1), ("2024-03-01", 2), ("2024-04-01", 1)]
    with pytest.raises(ValueError):
        b.events_by_time(events, "week")


def test_transitions_count_successors(skewed):
    of_products = skewed.filter("item_id is not null")
    untyped = of_products.filter("event_type is null").count()
    last = of_products.select("item_id").distinct().count()
    found = b.product_transitions(skewed).agg(F.sum("count")).first()[0]
    # Every event has a successor but each product's last; untyped successors
    # are not counted. The last of a product may be untyped itself.
    assert of_products.count() - untyped - last <= found <= of_products.count() - untyped


def test_reports_of_analyses(skewed):
    basic = analyses.basic_report(skewed, 12)
    engagement = analyses.engagement_report(skewed, 12)
    for name, frame in {**basic, **engagement, **analyses.product_report(skewed),
                        **analyses.timing_patterns(skewed), **analyses.user_returns(analyses.return_gaps(skewed)),
                        **analyses.product_behavior(skewed), **analyses.overview(skewed)}.items():
        assert frame.columns, name
        assert not frame.isEmpty(), name
    assert "ProductID" in basic["top_products"].columns
    assert "EventType" in engagement["event_positions"].columns
    total = engagement["duration_distribution"].agg(F.sum("count")).first()[0]
    assert total == basic["basic_totals"].first()["total_sessions"] == len(sessions(ROWS, 12))


@pytest.mark.parametrize(("prefix", "most", "limit"), [(64, 10_000, 10), (3, 10_000, 10), (1, 2, 25), (64, 10_000, 100_000)])
def test_top_sequences_by_digest(spark, monkeypatch, prefix, most, limit):
    """The same as by text, also where many sequences tie and share their beginning."""
    monkeypatch.setattr(p, "PREFIX", prefix)
    monkeypatch.setattr(p, "MOST_CANDIDATES", most)
    events = read_table_events(spark, "/root/testdata/sf0.01")
    expected = p.top_sequences(p.sequence_counts(events, 720), limit)
    found = p.top_sequences_by_digest(events, 720, limit)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]


def test_texts_of_sequences_are_not_shuffled(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans, real = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self: plans.append(self) or real(self))
    events = read_table_events(spark, "/root/testdata/sf0.01")
    found = p.top_sequences_by_digest(events, 720)
    (counted,) = plans
    plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 2 and not any("sequence" in line for line in moved)
    # The last pass joins by broadcast; behind it only the candidates' texts move.
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
