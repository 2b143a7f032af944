"""The sliced plan gives what a plain window gives, in bounded slices."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clicktrail.operators import ordered as o

ORDER = ["t", "n"]


@pytest.fixture(scope="module")
def rows(spark):
    # Key 0 and the NULL key hold a third each; v is NULL now and then, and
    # every row of key 0 occurs three times.
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None)
        .otherwise(F.col("id") % 50 + 1).cast("int").alias("k"),
        (F.xxhash64("id") % 500).alias("t"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("v"),
        (F.col("id") % 4).alias("n"),
    )
    copies = base.filter("k = 0")
    return base.unionByName(copies).unionByName(copies).repartition(5).cache()


def steps():
    return {
        "total": o.RunningSum(F.lit(1)),
        "vsum": o.RunningSum(F.coalesce("v", F.lit(0))),
        "vmax": o.RunningMax(F.col("v")),
        "ksum": o.KeySum(F.coalesce("v", F.lit(0))),
        "before": o.Previous(F.col("t")),
        "after": o.Next(F.col("t")),
    }


def build(ordered):
    return ordered.add(**steps()).frame.select("k", "t", "v", "n", *steps())


def as_counts(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [10, 100, 900, 10_000])
def test_same_as_one_window(rows, hot_rows):
    # Rows equal in the order are told apart by v, so that results are unique.
    order = ["t", "n", "v"]
    w = Window.partitionBy("k").orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("k")
    v0 = F.coalesce("v", F.lit(0))
    expected = rows.select(
        "k", "t", "v", "n",
        F.sum(F.lit(1)).over(running).alias("total"),
        F.sum(v0).over(running).alias("vsum"),
        F.max("v").over(running).alias("vmax"),
        F.sum(v0).over(whole).alias("ksum"),
        F.lag("t").over(w).alias("before"),
        F.lead("t").over(w).alias("after"),
    )
    found = o.per_key_order(rows, "k", order, build, hot_rows)
    assert as_counts(found) == as_counts(expected)


def test_neighbour_that_is_null(spark):
    rows = spark.createDataFrame([(1, t, None if t % 2 else str(t)) for t in range(20)], "k int, t int, v string")

    def neighbours(ordered):
        return ordered.add(p=o.Previous(F.col("v")), n=o.Next(F.col("v"))).frame.select("t", "v", "p", "n")

    plain = o.per_key_order(rows, "k", ["t"], neighbours, None)
    sliced = o.per_key_order(rows, "k", ["t"], neighbours, 2)
    assert as_counts(plain) == as_counts(sliced)


@pytest.mark.parametrize("other", ["0", "id"], ids=["copies", "ties"])
def test_slices_are_bounded_for_copies_and_ties(spark, monkeypatch, other):
    monkeypatch.setattr(o, "COPIES_PER_BLOCK", 64)
    rows = spark.range(6000).select(F.lit("bot").alias("k"), F.lit(1).alias("t"), F.expr(other).alias("x"))
    seen = {}

    def keep(ordered):
        if ordered.hot:
            seen["sizes"] = [r["count"] for r in ordered.frame.groupBy("k", o.SLICE).count().collect()]
        return ordered.frame.select("k", "t")

    result = o.per_key_order(rows, "k", ["t"], keep, 100)
    assert result.count() == 6000
    assert sum(seen["sizes"]) == 6000
    tasks = o._slice_count(spark, 6000, 100)
    assert len(seen["sizes"]) == tasks == 8
    assert max(seen["sizes"]) <= 2 * 6000 / tasks


def test_slice_count(spark):
    assert o._slice_count(spark, 1_500_000, 1_000_000) == 8  # the session's partitions
    assert o._slice_count(spark, 3 * 10**11, 1_000_000) == 18_750  # 16 million rows each
    assert o._slice_count(spark, 101, 100) == 8
    assert o._slice_count(spark, 5, 100) == 2


def test_slices_do_not_follow_a_small_limit(spark):
    # Slices are dealt out by as many tasks: 75,000 of them are 5.6 billion index entries.
    assert o._slice_count(spark, 6_000_000, 5) == 8
    assert o._slice_count(spark, 36_000_000, 5) == 36
    assert o._slice_count(spark, 36_000_000, 60) == 36
    rows = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    seen = []

    def keep(ordered):
        seen.append(ordered.frame.rdd.getNumPartitions() if ordered.hot else 0)
        return ordered.add(total=o.RunningSum(F.lit(1))).frame.select("k", "t", "total")

    found = o.per_key_order(rows, "k", ["t"], keep, o.Skew(5, listed=1))
    assert as_counts(found) == as_counts(o.per_key_order(rows, "k", ["t"], keep, None))
    assert max(seen) == 8


@pytest.mark.parametrize("limits", [(2, 100_000), (10_000, 0), (2, 0)])
def test_too_many_keys_to_broadcast(rows, monkeypatch, limits):
    expected = as_counts(o.per_key_order(rows, "k", ["t", "n", "v"], build, None))
    monkeypatch.setattr(o, "BROADCAST_KEYS", limits[0])
    monkeypatch.setattr(o, "BROADCAST_SLICES", limits[1])
    assert as_counts(o.per_key_order(rows, "k", ["t", "n", "v"], build, 10)) == expected


@pytest.mark.parametrize("listed", [0, 1, 2])
def test_all_rows_sliced_without_a_list_of_keys(rows, listed):
    order = ["t", "n", "v"]
    expected = as_counts(o.per_key_order(rows, "k", order, build, None))
    assert as_counts(o.per_key_order(rows, "k", order, build, o.Skew(10, listed=listed))) == expected


def islands(ordered):
    """Islands that begin where t jumps by more than 2, counted in steps of n."""
    own = o.Islands(
        F.col("t"), lambda before: F.when(before.isNull() | (F.col("t") - before > 2), 1 + F.col("n") % 2).otherwise(0),
        before="b", grows="g", number="i", counted=F.when(F.col("n") < 3, 1).otherwise(0), rank="r", position="p",
        keeps=F.col("n") == 2,
    )
    found = ordered.add(own, total=o.KeySum(F.col("n")), reach=o.MaxBefore(F.col("v")), low=o.KeyMin(F.col("v")))
    return found.frame.select("k", "t", "v", "n", *own.columns, "total", "reach", "low")


@pytest.mark.parametrize("limit", [10, 100, 900, 10_000, o.Skew(10, 0), o.Skew(100, 1)])
def test_islands_over_any_cut(rows, limit):
    order = ["t", "n", "v"]
    by_key = {}
    for row in rows.collect():
        by_key.setdefault(row["k"], []).append(row)
    expected = []
    for key, own in by_key.items():
        own.sort(key=lambda x: (x["t"], x["n"], x["v"] is not None, x["v"] or 0))
        before = number = rank = start = 0
        reach = low = None
        known = [x["v"] for x in own if x["v"] is not None]
        low = min(known) if known else None
        for place, x in enumerate(own):
            jump = place == 0 or x["t"] - before > 2
            grows = 1 + x["n"] % 2 if jump else 0
            one = int(x["n"] < 3)
            if grows and x["n"] != 2:
                start = rank
            number, rank = number + grows, rank + one
            expected.append((
                key, x["t"], x["v"], x["n"], None if place == 0 else before, grows, number, rank, rank - start,
                sum(y["n"] for y in own), reach, low,
            ))
            before = x["t"]
            if x["v"] is not None:
                reach = x["v"] if reach is None else max(reach, x["v"])
    assert as_counts(o.per_key_order(rows, "k", order, islands, limit)) == sorted(map(str, expected))


def test_few_hot_keys_are_listed_by_value(rows, monkeypatch):
    hot = o.find_hot_keys(rows, "k", 900)
    assert sorted(hot.values, key=str) == [0, None]
    monkeypatch.setattr(o, "LITERAL_KEYS", 1)
    assert o.find_hot_keys(rows, "k", 900).values is None
    order = ["t", "n", "v"]
    expected = as_counts(o.per_key_order(rows, "k", order, build, None))
    assert as_counts(o.per_key_order(rows, "k", order, build, 900)) == expected


def test_hot_keys(rows):
    hot = o.find_hot_keys(rows, "k", 900)
    assert sorted((r[0] is None, r[0]) for r in hot.keys.collect()) == [(False, 0), (True, None)]
    assert (hot.count, hot.rows) == (2, 4000)
    assert o.find_hot_keys(rows, "k", 5000) is None
    assert o.hot_limit(rows, "k", 5000) is None
    assert o.hot_limit(rows, "k", 900) == 900
    assert o.hot_limit(rows, "k", None) is None
