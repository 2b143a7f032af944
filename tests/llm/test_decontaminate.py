"""Contamination against the alignment of every item with every document."""

import random

import numpy as np
import pytest

from clicktrail.llm import catalog, decontaminate
from tests.llm.helpers import SMALL_DIR, by_id, documents, edge_rows, random_texts, tables


def plain_score(item, words):
    """Smith-Waterman in plain Python: the score, and the most matching words among alignments with it."""
    before, best = [(0, 0)] * (len(words) + 1), (0, 0)
    for a in item:
        row = [(0, 0)]
        for j, b in enumerate(words):
            same = a == b
            score, matching = before[j]
            match = (score + (decontaminate.MATCH if same else decontaminate.MISMATCH), matching + same)
            gaps = [(x[0] + decontaminate.GAP, x[1]) for x in (before[j + 1], row[-1])]
            found = max(match, *gaps)
            row.append(found if found[0] > 0 else (0, 0))
        before, best = row, max(best, *row)
    return best


def brute(docs, items, threshold=0.5):
    found = []
    for doc_id, text in docs:
        words = decontaminate.words_of(text)
        for item_id, item_text in items:
            item = decontaminate.words_of(item_text)
            if item_id is None or len(item) < decontaminate.SEED_WORDS or not set(item) & set(words):
                continue
            score, matching = plain_score(item, words)
            similarity = score / (decontaminate.MATCH * len(item))
            if similarity >= threshold and (matching >= 8 or similarity == 1):
                found.append((doc_id, item_id, round(similarity, 9)))
    return by_id(found)


def rounded(rows):
    return by_id((row["doc_id"], row["item_id"], round(row["similarity"], 9)) for row in rows)


def planted():
    """Items whole, edited, in part, twice in a document and not at all."""
    rng = random.Random(3)
    items = list(enumerate(random_texts(11, 25, words=40, vocabulary=900)))
    docs = []
    for number, text in enumerate(random_texts(12, 90, words=200, vocabulary=900)):
        words = items[number % 25][1].split()
        kind = number % 6
        if kind == 1:
            words = [w for w in words if rng.random() > 0.1]
        elif kind == 2:
            for k in range(5, len(words), 6):
                words[k] = "edited"
        elif kind == 3:
            words = words[: len(words) * 3 // 4]
        elif kind == 4:
            words = [*words, "between", *words]
        own = text.split()
        at = rng.randrange(len(own))
        docs.append((number, " ".join(own[:at] + (words if kind < 5 else []) + own[at:]).title()))
    return docs, items


def odd_items():
    return [(None, "an item without id " * 5), (70, None), (71, ""), (72, "two words"), (73, "one two three"), (74, "one two three")]


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_against_brute_force(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    docs, items = planted()
    docs += [(None if i is None else i + 500, text) for i, text in edge_rows() if len(text or "") < 9000]
    docs += [docs[1], (None, docs[0][1])]
    items += odd_items()
    items.append(items[4])
    folder = tables(
        spark, tmp_path / "t",
        documents=documents(spark, docs, clashing=True),
        benchmark=spark.createDataFrame([(*row, 1) for row in items], "item_id long, text string, score int"),
    )
    found = rounded(catalog.decontamination(spark, folder).collect())
    assert found == brute(docs, items)
    assert len(found) > 50


def test_copies_with_scattered_edits(spark):
    """Every fourth word replaced, or a quarter of them at random, with and without a whole copy elsewhere."""
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(900)]
    items = [(number, " ".join(rng.choices(pool, k=16 if number < 30 else 40))) for number in range(60)]
    docs = []
    for number, text in items:
        words = text.split()
        fourth = [f"new{k}" if k % 4 == 3 else word for k, word in enumerate(words)]
        replaced = set(rng.sample(range(len(words)), len(words) // 4))
        mixed = [f"new{k}" if k in replaced else word for k, word in enumerate(words)]
        docs += [(3 * number, "x y " + " ".join(fourth)), (3 * number + 1, " ".join(mixed))]
        if number % 2:
            docs.append((3 * number + 2, text))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = rounded(decontaminate.contaminated(documents(spark, docs), bench).collect())
    assert found == brute(docs, items)
    assert {3 * number for number, _ in items} <= {row[0] for row in found}


def test_span_of_the_passage(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = documents(spark, [(1, "x y z " + item.replace("delta", "DELTA, extra") + " tail"), (2, "clean text")])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    row = decontaminate.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["first_word"], r["last_word"]) for r in row] == [(1, 9, 3, 13)]
    assert [r["doc_id"] for r in decontaminate.without_items(docs, bench).collect()] == [2]


def test_whole_small_table(spark):
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{SMALL_DIR}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    # The full alignment of long documents takes long in plain Python.
    short = [row for row in docs if len(row[1]) < 2000]
    kept = {row[0] for row in short}
    found = [row for row in catalog.decontamination(spark, SMALL_DIR).collect() if row["doc_id"] in kept]
    assert rounded(found) == brute(short, items)


def test_alignment_scores():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item, window = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(1, 30))
        found = decontaminate.align(item, window)
        assert (found[0], found[3]) == plain_score(item.tolist(), window.tolist())


def test_short_items_count_matching_words(spark):
    """Ten words of which eight match score 0.7; of nine with seven matching none is reported."""
    ten = "one two three four five six seven eight nine ten"
    docs = documents(spark, [
        (1, "x " + ten.replace("four", "a").replace("eight", "b") + " y"), (2, ten.replace("four", "a").replace("seven", "b").replace("nine", "c")),
    ])
    bench = spark.createDataFrame([(1, ten), (2, " ".join(ten.split()[:9]))], "item_id long, text string")
    found = rounded(decontaminate.contaminated(docs, bench).collect())
    assert found == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [(1, ten), (2, " ".join(ten.split()[:9]))])
    assert (1, 1, 0.7) in found and not [row for row in found if row[0] == 2]


def test_scripts_without_spaces(spark):
    """Each character is a word, so a copy in the middle of a clause is found, edited too."""
    item = "今日は天気がとても良いので散歩に行きました"
    assert decontaminate.words_of("abc今日def ไทย") == ["abc", "今", "日", "def", "ไ", "ท", "ย"]
    docs = [(1, f"昔々{item}終わり。"), (2, "昔々" + item.replace("散歩", "買物") + "です"), (3, "これは別の文章であり関係がない"), (4, "семь слов " * 3)]
    items = [(1, item), (2, "семь слов по русски в этом примере есть")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = rounded(decontaminate.contaminated(documents(spark, docs), bench).collect())
    assert found == brute(docs, items) and [row[:2] for row in found] == [(1, 1), (2, 1)]


@pytest.mark.parametrize("benchmark", [True, False])
def test_empty_tables(spark, tmp_path, benchmark):
    made = {"benchmark": spark.createDataFrame(planted()[1], "item_id long, text string")} if benchmark else {
        "documents": documents(spark, planted()[0])
    }
    assert catalog.decontamination(spark, tables(spark, tmp_path / "t", **made)).collect() == []
