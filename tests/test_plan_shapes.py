"""The physical plans: where data is moved, and that nothing runs in one task."""

import re

import pytest

from clicktrail.operators import behavior, ordered as o, rankings, reports, sessions
from clicktrail.sources.event_table import read_table_events

TESTDATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return read_table_events(spark, TESTDATA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)(?:\(([^()]*))?", plan(df))


def keys(df):
    found = []
    for kind, columns in exchanges(df):
        names = re.findall(r"(\w+)#\d+", columns or "")
        found.append((kind, tuple(names)))
    return found


def test_session_lists_take_one_shuffle(events):
    assert keys(sessions.session_pages(events)) == [("hashpartitioning", ("user_id",))]
    assert keys(sessions.session_products(events)) == [("hashpartitioning", ("user_id",))]
    assert keys(sessions.sessionize(events)) == [("hashpartitioning", ("user_id",))]


def test_session_table_shuffles_chunks(events):
    assert keys(sessions.session_table(events)) == [
        ("hashpartitioning", ("user_id",)),
        ("hashpartitioning", ("user_id", "chunk")),
    ]
    lines = plan(sessions.session_table(events)).splitlines()
    chunk_shuffle = next(i for i, line in enumerate(lines) if re.search(r"Exchange.*chunk", line))
    assert "partial_count" in lines[chunk_shuffle + 1]


def test_user_reports_add_one_row_per_task(events):
    found = keys(reports.engagement(sessions.session_table(events)))
    assert [kind for kind, _ in found] == ["SinglePartition", "hashpartitioning", "hashpartitioning"]


def test_overview_writes_no_row_three_times(events):
    assert "Expand" not in plan(rankings.overview_totals(events))


def test_unused_columns_are_not_read(events):
    scan = next(x for x in plan(reports.basic_totals(sessions.session_table(events))).splitlines() if "FileScan" in x)
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>", scan)


def test_top_k_sorts_no_more_than_k(events):
    assert "TakeOrderedAndProject" in plan(rankings.top_products(events, 10))
    assert "TakeOrderedAndProject" in plan(reports.top_sequences(reports.sequence_counts(events)))


def test_single_partition_only_after_partial_aggregation(events):
    table = sessions.session_table(events)
    for df in (
        reports.basic_totals(table), reports.session_summary(table), reports.funnel_rates(table),
        rankings.raw_totals(events), rankings.overview_totals(events), behavior.return_categories(events),
    ):
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                assert "partial_" in lines[i + 1], line


@pytest.mark.parametrize("name", ["Python", "CartesianProduct", "BroadcastNestedLoopJoin"])
def test_no_slow_operators(events, name):
    table = sessions.session_table(events)
    for df in (
        sessions.session_pages(events), reports.event_position_counts(events), reports.sequence_counts(events),
        behavior.return_histogram(events), behavior.product_transitions(events), reports.engagement(table),
        behavior.user_return_gaps(events, 60),
    ):
        assert name not in plan(df)


def moved(df):
    """Exchanges and scans of a plan."""
    return [line for line in plan(df).splitlines() if re.search("Exchange|Scan", line)]


def test_sliced_lists_take_few_nodes(events):
    assert len(moved(sessions.session_pages(events, 720, hot_rows=60))) <= 7
    assert len(moved(sessions.session_products(events, 720, hot_rows=60))) <= 7
    assert len(moved(sessions.sessionize(events, 720, hot_rows=60))) <= 5
    assert len(moved(behavior.product_transitions(events, 60))) <= 8


def test_few_hot_keys_are_filtered_at_the_scan(events):
    found = plan(sessions.sessionize(events, 720, hot_rows=67))
    scan = next(x for x in found.splitlines() if "FileScan" in x)
    assert "left_anti" not in found.lower().replace(" ", "") and "user_id" in scan.split("DataFilters")[1]


@pytest.fixture
def checkpointed(monkeypatch):
    """Plans of the frames that are checkpointed while a result is built, with their columns."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, real = [], DataFrame.checkpoint

    def checkpoint(self, *args, **kwargs):
        seen.append((self.columns, plan(self)))
        return real(self, *args, **kwargs)

    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    return seen


def exchanged_on(text):
    """The columns of each hash exchange of a plan."""
    return [
        re.findall(r"(\w+)#\d+", columns) for columns in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    ]


@pytest.mark.parametrize("name", ["product_transitions", "event_positions", "user_return_gaps", "sessionize"])
def test_rows_of_many_hot_keys_never_move_by_key(events, checkpointed, name):
    """At least 50 hot keys of which 3 may be listed."""
    limit = o.Skew(50, listed=3)
    key = "item_id" if name == "product_transitions" else "user_id"
    hot = o.find_hot_keys(events.where(f"{key} IS NOT NULL"), key, limit)
    assert hot.count >= 50 and hot.keys is None
    build = getattr(behavior, name, None) or getattr(sessions, name)
    result = build(events, hot_rows=limit)
    rows, summaries = [], []
    for columns, text in [*checkpointed, (result.columns, plan(result))]:
        (summaries if "_carry_key" in columns else rows).append(text)
    assert len(rows) == 2 and len(summaries) == 1
    for text in rows:
        assert [key] not in exchanged_on(text)
    assert "rangepartitioning" in rows[0] and [key, "_slice"] in exchanged_on(rows[0])
    # What moves by key is one row per slice and key that reaches over a slice's start.
    assert "LeftSemi" in summaries[0]


@pytest.mark.parametrize("listed", [3, 1000])
def test_hot_keys_reach_the_driver_from_one_task(events, monkeypatch, listed):
    from pyspark.sql.classic.dataframe import DataFrame

    seen, real = [], DataFrame.collect

    def collect(self):
        found = real(self)
        seen.append((len(found), plan(self)))
        return found

    monkeypatch.setattr(DataFrame, "collect", collect)
    hot = o.find_hot_keys(events, "user_id", o.Skew(50, listed=listed))
    assert hot.count >= 50 and (hot.keys is None) == (listed == 3)
    assert seen
    for rows, text in seen:
        # Otherwise each task sends as many keys as may be listed.
        assert rows == 1 and "TakeOrderedAndProject" not in text


def test_summaries_are_of_keys_that_reach_over_a_slices_start(spark, events, monkeypatch):
    seen = []
    real = o.Ordered._carried

    def carried(self, *args):
        seen.append((self.slices, real(self, *args)))
        return seen[-1][1]

    monkeypatch.setattr(o.Ordered, "_carried", carried)
    sessions.sessionize(events, 720, hot_rows=o.Skew(20, listed=3))
    (slices, found), = seen
    assert 0 < found.count() <= 2 * slices < events.select("user_id").distinct().count()
