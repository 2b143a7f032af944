"""Fingerprints, links and components against all pairs in plain Python."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from clicktrail.llm import catalog, components, simhash
from tests.llm.helpers import SMALL_DIR, ascii_lower, by_id, documents, edge_rows, random_texts, tables


def plain_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    shingles = [words[k : k + width] for k in range(max(1, len(words) - width + 1))] if words else []
    ones = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(" ".join(shingle).encode(), 42)
        for bit in range(64):
            ones[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def plain_components(nodes):
    """{number: smallest number} of (number, print) pairs."""
    root = {number: number for number, _ in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(nodes, 2):
        if (x ^ y).bit_count() <= 4:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {number: find(number) for number, _ in nodes}


def brute(rows):
    prints = [(doc_id, plain_print(text)) for doc_id, text in rows]
    # Rows with the same id and different texts link by their own text.
    first = {}
    for doc_id, value in prints:
        if doc_id is not None:
            first[value] = min(doc_id, first.get(value, doc_id))
    least = plain_components([(n, value) for n, value in enumerate(sorted(first))])
    values = sorted(first)
    smallest = {}
    for n, value in enumerate(values):
        smallest[least[n]] = min(first[value], smallest.get(least[n], first[value]))
    component = {value: smallest[least[n]] for n, value in enumerate(values)}
    return by_id((i, format(v, "016x"), None if i is None else component[v]) for i, v in prints)


def near_copies():
    texts = random_texts(3, 30, words=400)
    rng = random.Random(4)
    rows = []
    for text in texts:
        for _ in range(rng.choice([1, 1, 3, 12])):
            words = text.split()
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = "changed"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows, start=50))


@pytest.mark.parametrize("block", [2, 2048])
def test_against_all_pairs(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = near_copies() + edge_rows(repeat=False)[1:] + [(None, "row without id"), (60, near_copies()[3][1]), (61, "")]
    rows = [row for n, row in enumerate(rows) if row[0] is None or row[0] not in [r[0] for r in rows[:n]]]
    folder = tables(spark, tmp_path / "t", documents=documents(spark, rows, clashing=True))
    assert by_id(catalog.simhash(spark, folder).collect()) == brute(rows)


def test_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert by_id(catalog.simhash(spark, SMALL_DIR).collect()) == brute(rows)


def test_every_four_positions_hold_a_triple():
    triples = simhash.position_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


@pytest.mark.parametrize("block", [16, 2048])
def test_links_of_one_large_group(spark, monkeypatch, block):
    """A chain of fingerprints and a cloud around one: the links connect what pairs would."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(150):
        prints.add(base ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(1, 5))))
    value = base ^ (2**64 - 1)
    for _ in range(150):
        value ^= sum(1 << bit for bit in rng.sample(range(64), 4))
        prints.add(value)
    nodes = list(enumerate(sorted(prints)))
    signed = [(int(np.uint64(value).astype(np.int64)), number) for number, value in nodes]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "print long, doc long"))
    found = {number: number for number, _ in nodes} | dict(map(tuple, components.smallest_reachable(links).collect()))
    assert found == plain_components(nodes)


def test_components_of_chains_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(5, 5), (100, 101), (101, 100), (103, 100)]
    found = dict(map(tuple, components.smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(1, 61)} | {101: 100, 103: 100}


def test_one_row_of_each_group_stays(spark):
    text = random_texts(8, 1, words=300)[0]
    rows = [(4, text), (2, text), (2, text), (9, "something else entirely here"), (None, text), (None, "")]
    kept = simhash.one_of_each_group(documents(spark, rows, clashing=True))
    assert by_id(kept.select("doc_id", "text").collect()) == by_id([rows[1], rows[3], rows[4], rows[5]])


def test_empty_table(spark, tmp_path):
    assert catalog.simhash(spark, tables(spark, tmp_path / "t")).collect() == []


def test_rows_of_one_id_become_one_before_they_move(spark):
    """A hot repeated id is reduced in its own tasks, and rows without id aren't moved."""
    rows = [(1, "b text of the id one here"), (1, None), (2, "c")] * 500 + [(None, f"row {n} without an id") for n in range(700)]
    frame = documents(spark, rows, clashing=True).repartition(6)
    found = simhash.one_of_each_group(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert re.search(r"SortAggregate\(key=\[id#\d+L\], functions=\[partial_min_by", plan)
    kept = found.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in kept if r["doc_id"] is not None) == [
        (False, 1, None), (False, 2, "c")
    ]
    assert sum(r["doc_id"] is None for r in kept) == 700
