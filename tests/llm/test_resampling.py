"""Weights, draws and ranks against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktrail.llm import catalog, resampling, words
from tests.llm.helpers import ascii_lower, by_id, documents, edge_rows, random_texts, tables

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_n):
    found = WORD.findall(ascii_lower(text or ""))
    return [
        zlib.crc32(" ".join(found[at : at + n]).encode()) for n in range(1, max_n + 1) for at in range(len(found) - n + 1)
    ], len(found)


def brute(rows, target, buckets=10_000, max_n=1, least_words=20, percent=10):
    corpus = Counter(x % buckets for _, text in rows for x in features(text, max_n)[0])
    wanted = Counter(x % buckets for text in target for x in features(text, max_n)[0])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())

    def gain(bucket):
        ratio = (wanted[bucket] + 1) * (s_all + buckets) / ((corpus[bucket] + 1) * (t_all + buckets))
        return math.floor(1000 * math.log(ratio))

    scored = []
    for doc_id, text in rows:
        own, count = features(text, max_n)
        weight = sum(gain(x % buckets) for x in own) // len(own) if own else 0
        digest = hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = int(digest[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(own), weight, score, count))
    able = sorted(
        (x for x in scored if x[4] >= least_words),
        key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[2]),
    )
    drawn = [(*x[:4], rank) for rank, x in enumerate(able[: len(able) * percent // 100], start=1)]
    rest = [(*x[:4], None) for x in able[len(drawn) :]] + [(*x[:4], None) for x in scored if x[4] < least_words]
    return by_id(drawn + rest)


def some_rows():
    rows = edge_rows() + [(100 + n, text) for n, text in enumerate(random_texts(1, 150))]
    rows += [(90, random_texts(2, 1)[0])] * 60  # one row many times
    rows += [(91, text) for text in random_texts(3, 40)]  # one id, many texts
    return rows + [(None, text) for text in random_texts(4, 40)]


def target_texts():
    return random_texts(1, 20) + ["Quite Other words", "", None]


@pytest.mark.parametrize("block", [3, 100_000])
def test_query_on_odd_documents(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(resampling, "COPIES_PER_BLOCK", block)
    items = spark.createDataFrame(list(enumerate(target_texts())), "item_id long, text string")
    folder = tables(spark, tmp_path / "t", documents=documents(spark, some_rows(), clashing=True), benchmark=items)
    found = catalog.resampling(spark, folder)
    assert by_id(found.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute(some_rows(), target_texts())


@pytest.mark.parametrize(("max_n", "percent", "window"), [(2, 50, 40), (3, 100, 1 << 22), (3, 30, 16), (1, 0, 64)])
def test_longer_runs_and_other_settings(spark, monkeypatch, max_n, percent, window):
    monkeypatch.setattr(words, "WINDOW_BYTES", window)
    monkeypatch.setattr(resampling, "KNOWN_WORDS", 50)
    target = spark.createDataFrame([(text,) for text in target_texts()], "text string")
    found = resampling.importance_ranks(
        documents(spark, some_rows()), target, buckets=97, max_n=max_n, least_words=5, percent=percent
    )
    assert by_id(found.select("doc_id", "n_features", "weight", "score", "rank").collect()) == brute(
        some_rows(), target_texts(), 97, max_n, 5, percent
    )


def test_drawn_documents_are_whole(spark):
    rows = [(n, text) for n, text in enumerate(random_texts(1, 100))]
    target = spark.createDataFrame([(text,) for text in target_texts()], "text string")
    drawn = resampling.resample(documents(spark, rows, clashing=True), target, least_words=1, percent=30).collect()
    assert sorted(row["rank"] for row in drawn) == list(range(1, 31))
    assert all(row["document"]["text"] == rows[row["document"]["doc_id"]][1] for row in drawn)
    assert drawn[0]["document"]["score"].startswith("x")


def test_the_draw_follows_the_target(spark):
    """Half of the documents are written in the target's words: they are drawn far more often."""
    near, far = random_texts(5, 300, vocabulary=40), random_texts(6, 300, vocabulary=40)
    rows = [(n, text) for n, text in enumerate(near + far)]
    target = spark.createDataFrame([(text,) for text in random_texts(5, 30, vocabulary=40)], "text string")
    found = resampling.importance_ranks(documents(spark, rows), target, least_words=5, percent=20)
    drawn = [row["doc_id"] for row in found.where(F.col("rank").isNotNull()).collect()]
    assert len([n for n in drawn if n < 300]) > 0.75 * len(drawn)


def test_empty_tables(spark, tmp_path):
    assert catalog.resampling(spark, tables(spark, tmp_path / "a")).collect() == []
    rows = [(1, "one two"), (2, None)]
    folder = tables(spark, tmp_path / "b", documents=documents(spark, rows))
    found = catalog.resampling(spark, folder).select("doc_id", "n_features", "weight", "score", "rank")
    assert by_id(found.collect()) == brute(rows, [])


def test_bounds_of_distinct_scores():
    """What the driver adds up is bounded: gains by the logarithm of 64-bit counts, draws by 32 bits."""
    most = resampling.bucket_gains(np.array([0, 2**62]), np.array([2**62, 0]))
    lowest, highest = (math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))) for h in (0, 2**32 - 1))
    assert most.max() - most.min() + highest - lowest < 130_000
