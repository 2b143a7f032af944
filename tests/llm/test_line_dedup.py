"""Line dedup against plain Python, and the minimal perfect hash by itself."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktrail.llm import catalog, line_dedup
from tests.llm.helpers import CLASHING, ascii_lower, by_id, documents, edge_rows, random_texts, tables


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc_id is not None:
                holders[key(line)].add(doc_id)
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if doc_id is None or len(holders[key(line)]) < min_docs or max(holders[key(line)]) == doc_id
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        found.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return by_id(found)


def repeated_rows():
    lines = [text[:60] for text in random_texts(1, 40)] + ["short", "", "Æ" * 19, "Æ" * 20, "  Twenty chars or more HERE \t"]
    rows = []
    for doc_id in range(120):
        mine = [lines[(doc_id * k * k + k) % len(lines)] for k in range(doc_id % 9 + 1)]
        rows.append((doc_id, "\n".join([*mine, "a line that every document holds".upper() if doc_id % 2 else "A line that every document holds "])))
    return rows


@pytest.mark.parametrize("shard_keys", [4, 1 << 12])
def test_against_brute_force(spark, tmp_path, monkeypatch, shard_keys):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", shard_keys)
    rows = repeated_rows() + [(1000 + (i or 0) if i is not None else None, t) for i, t in edge_rows()]
    rows += [(7, rows[7][1]), (3, rows[0][1])]
    folder = tables(spark, tmp_path / "t", documents=documents(spark, rows, clashing=True))
    assert by_id(catalog.line_dedup(spark, folder).collect()) == brute(rows)


def test_empty_table(spark, tmp_path):
    folder = tables(spark, tmp_path / "t")
    assert catalog.line_dedup(spark, folder).collect() == []


def test_other_columns_come_along(spark):
    docs = documents(spark, [(1, "a"), (2, "b")], clashing=True)
    row = line_dedup.drop_repeated_lines(docs).first()
    assert set(row["rest"].asDict()) == {"lang", "source", "n_chars", *CLASHING}


@pytest.mark.parametrize("size", [0, 1, 2, 1000])
def test_minimal_perfect_hash(size):
    rng = np.random.default_rng(size)
    h1, h2 = (rng.integers(-(2**63), 2**63 - 1, size) for _ in range(2))
    counts, keepers = np.arange(size) + 3, np.arange(size) * 7
    index = line_dedup.LineIndex(**line_dedup.build_index(h1, h2, counts, keepers))
    found = index.probe(h1, h2)
    assert sorted(found) == list(range(size))
    assert (index.counts[found] == counts).all() and (index.keepers[found] == keepers).all()
    other = rng.integers(-(2**63), 2**63 - 1, 500)
    assert (index.probe(other, other) == -1).all()


def test_keys_with_equal_first_half():
    h1, h2 = np.zeros(50, np.int64), np.arange(50)
    index = line_dedup.LineIndex(**line_dedup.build_index(h1, h2, h2, h2))
    assert sorted(index.probe(h1, h2)) == list(range(50))


def test_keys_that_no_level_places(monkeypatch):
    monkeypatch.setattr(line_dedup, "LEVELS", 1)
    h1, h2 = np.arange(40) % 3, np.arange(40)
    index = line_dedup.LineIndex(**line_dedup.build_index(h1, h2, h2, h2))
    assert (index.keepers[index.probe(h1, h2)] == h2).all()


def test_counts_in_the_index_decide(spark):
    """All distinct hashes are indexed, and large counts don't wrap."""
    rows = repeated_rows()
    lines = line_dedup.line_hashes(documents(spark, rows), 20, "doc_id", "text")
    counted = lines.groupBy("h1", "h2").count().count()
    totals = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    index = line_dedup.line_index(totals, 4).collect()
    assert sum(len(row["counts"]) // 4 for row in index) == counted
    assert min(min(np.frombuffer(row["counts"], "<u4")) for row in index) < 3
    assert {len(row["prints"]) for row in index} == {len(row["counts"]) for row in index}
    big = line_dedup.build_index(np.array([1]), np.array([2]), np.array([2**33 + 1]), np.array([7]))
    assert line_dedup.LineIndex(**big).counts.tolist() == [2**32 - 1]
    found = {tuple(r) for r in line_dedup.repeated_in(lines, 3).collect()}
    assert found and all(row[0] != max(r["doc_id"] for r in lines.collect() if (r["h1"], r["h2"]) == row[1:]) for row in list(found)[:5])
