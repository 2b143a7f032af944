"""Top-k against plain Python integers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clicktrail.llm import catalog, topk
from tests.llm.helpers import tables

SCHEMA = "vec_id long, embedding array<float>, label int, score string, tile string"


def brute(rows, every, k=5):
    kept = []
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * x) for x in vector]))
    found = []
    for q, a in kept:
        if q % every == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in kept if i != q and len(a) == len(b)
            )
            found += [(q, rank, i, -loss) for rank, (loss, i) in enumerate(scored[:k], start=1)]
    return sorted(found)


def vectors(count, seed=1):
    rng = random.Random(seed)
    rows = [(i, [round(rng.uniform(-1, 1) * 8) / 8 for _ in range(6)]) for i in range(count)]
    rows += [(count + i, rows[3][1]) for i in range(20)]
    rows += [
        (500, None), (501, []), (502, [1.0] * 5 + [None]), (503, [float("nan")] * 6), (505, [float("inf")] * 6),
        (None, [1.0] * 6), (510, [1.0, 2.0]), (515, [2.0, 1.0]), (520, []), (0, [0.5] * 6), (7, rows[7][1]),
    ]
    return rows


@pytest.mark.parametrize(("shard", "query", "fan_in"), [(2048, 512, 16), (9, 4, 2)])
def test_against_brute_force(spark, monkeypatch, shard, query, fan_in):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", query)
    monkeypatch.setattr(topk, "FAN_IN", fan_in)
    rows = vectors(90)
    df = spark.createDataFrame([(*row, 1, "s", "t") for row in rows], SCHEMA)
    found = topk.top_k(df, F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, found)) == brute(rows, 5)


def test_products_beyond_doubles(spark):
    rows = [(i, [float(2**20 + i) + 0.5, -float(2**19 - 3 * i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") % 4 == 0).collect()
    assert sorted(map(tuple, found)) == brute(rows, 4)


def test_scores_beyond_64_bits_tie(spark):
    rows = [(i, [1e30 * (i + 1)]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") == 3).collect()
    assert [tuple(row) for row in found] == [(3, k + 1, k, 2**63 - 1) for k in range(3)]


def test_fewer_vectors_than_k_and_no_queries(spark):
    rows = [(0, [1.0]), (3, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(row) for row in topk.top_k(df, F.col("vec_id") % 5 == 0).collect()] == [(0, 1, 3, 256 * 512)]
    assert topk.top_k(df, F.col("vec_id") > 99).collect() == []


def test_empty_table(spark, tmp_path):
    assert catalog.topk(spark, tables(spark, tmp_path / "t")).collect() == []
