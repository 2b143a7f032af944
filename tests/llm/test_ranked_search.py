"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clicktrail.llm import catalog, ranked_search, words
from tests.llm.helpers import EDGE_TEXTS, ascii_lower, by_id, documents, edge_rows, random_texts, tables

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SETTINGS = [(1 << 22, 1 << 20, 1 << 22, 4096), (50, 60, 200, 7)]


def terms(text):
    return [ascii_lower(word) for word in WORD.findall(text or "")]


def brute(rows, items, k=50):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_all, l_all = len(bags), sum(sum(bag.values()) for _, bag in bags)
    frequencies = Counter(term for _, bag in bags for term in bag)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    found = []
    for item_id, own in wanted.items():
        scored = []
        for doc_id, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * n_all) // l_all
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * frequencies[term] + 1)))
                * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 20 * m))
                for term in own if bag[term]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (loss, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], start=1):
            found.append((item_id, rank, doc_id, -loss))
    return by_id(found)


def some_rows():
    rng = random.Random(8)
    texts = random_texts(1, 200, words=30, vocabulary=120)
    rows = edge_rows() + [(100 + n, text) for n, text in enumerate(texts)]
    rows += [(1000 + n, texts[3]) for n in rng.sample(range(500), 120)]  # a large class
    rows += [(2000 - n, " ".join(reversed(texts[4].split())).upper()) for n in range(70)]  # the same bag in other texts
    rows += [(50, texts[5])] * 80  # one row many times
    rows += [(None, texts[3])] * 3 + [(51, text) for text in texts[:20]]
    # The same vocabulary words beside others: bags are equal, lengths aren't.
    return rows + [(3000 + n, texts[3] + " other" * n) for n in range(5)]


def some_items():
    texts = random_texts(1, 12, words=12, vocabulary=120)
    items = list(enumerate(texts)) + [(3, "word One 日本語"), (None, texts[0]), (None, "zzz"), (20, None), (21, ""), (22, "nowhere-found")]
    return items + [(30 + n, text) for n, text in enumerate(EDGE_TEXTS)]


@pytest.mark.parametrize(("window", "block", "portion", "rows"), SETTINGS)
def test_query_on_odd_documents(spark, tmp_path, monkeypatch, window, block, portion, rows):
    monkeypatch.setattr(words, "WINDOW_BYTES", window)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(ranked_search, "SCORED_AT_ONCE", portion)
    monkeypatch.setattr(ranked_search, "SLICE_ROWS", rows)
    items = spark.createDataFrame(some_items(), "item_id long, text string")
    folder = tables(spark, tmp_path / "t", documents=documents(spark, some_rows(), clashing=True), benchmark=items)
    found = catalog.search(spark, folder).select("item_id", "rank", "doc_id", "score")
    assert by_id(found.collect()) == brute(some_rows(), some_items())


def test_a_class_sends_no_more_than_k_members(spark):
    vocabulary = {b"a": 0, b"b": 1}
    docs = documents(spark, [(900 - n, "a b a" if n % 2 else "A, b: a!") for n in range(400)] + [(5, "b c"), (6, "c")])
    found = ranked_search.bags(docs.repartition(3), vocabulary, "doc_id", "text")
    assert ranked_search.corpus_statistics(found, 2)[:2] == (402, 1203)
    assert ranked_search.corpus_statistics(found, 2)[2].tolist() == [400, 401]
    classes = ranked_search.bag_classes(found, 402, 1203, 50)
    plan = classes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(h") == 1 and "WindowGroupLimit" in plan.split("hashpartitioning(h")[-1]
    members = {np.frombuffer(row["bag"], "<u4").tolist()[1]: row["members"] for row in classes.collect()}
    assert members == {2: list(range(501, 551)), 1: [5]}


def test_impacts_beyond_doubles_are_exact():
    postings = ranked_search.Postings([(0, str(n).encode()) for n in range(3)])
    weights = np.array([2**53, 1, 1])
    bag = np.array([0, 1, 1, 1], "<u4").tobytes()
    (_, _, scores), = ranked_search.class_scores(np.array([49_999_950]), [bag], postings, weights)
    one = 1_000_000_000 // (1000 + 20 * 49_999_950)
    assert scores.tolist() == [[2**53 * one + one]]


def test_empty_tables(spark, tmp_path):
    assert catalog.search(spark, tables(spark, tmp_path / "a")).collect() == []
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert catalog.search(spark, tables(spark, tmp_path / "b", benchmark=items)).collect() == []
    docs = documents(spark, [(1, "a b"), (2, None)])
    assert catalog.search(spark, tables(spark, tmp_path / "c", documents=docs)).collect() == []
    found = catalog.search(spark, tables(spark, tmp_path / "d", documents=docs, benchmark=items)).collect()
    assert by_id(found) == brute([(1, "a b"), (2, None)], [(1, "a b")])
