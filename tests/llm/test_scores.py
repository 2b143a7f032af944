"""Quality and toxicity: held-out accuracy, odd documents, degenerate labels."""

import math
import zlib

import pytest
from pyspark.sql import functions as F

from clicktrail.llm import catalog, quality, toxicity
from clicktrail.llm.samples import class_odds, labelled_sample, with_odds
from tests.llm.helpers import SF_DIR, documents, edge_rows, random_texts, tables


def auc(pairs):
    ones, zeros = ([score for score, label in pairs if label == value] for value in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize(
    ("query", "label", "folds", "out", "least"),
    [(catalog.quality, "quality", 3, 1, 0.93), (catalog.toxic, "toxic", 5, 0, 0.95)],
)
def test_held_out_accuracy(spark, query, label, folds, out, least):
    rows = query(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    labels = {row["doc_id"]: row[label] for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % folds == out)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
    held = [(row["score"], labels[row["doc_id"]]) for row in rows if row["held_out"] and row["doc_id"] in labels]
    assert auc(held) > least
    assert sum((score >= 0.5) == label for score, label in held) / len(held) > 0.95


def labelled(spark, tmp_path, label_rows):
    rows = edge_rows() + list(enumerate(random_texts(1, 40), start=20))
    return tables(
        spark, tmp_path / "t",
        documents=documents(spark, rows, clashing=True),
        labels=spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int, text string"),
    ), len(rows)


@pytest.mark.parametrize("query", [catalog.quality, catalog.toxic])
@pytest.mark.parametrize(
    ("label_rows", "constant"),
    [
        ([], 0.5),
        ([(i, 1, 1, "x") for i in range(60)], 1.0),
        ([(i, 0, 0, None) for i in range(60)], 0.0),
        ([(i, None, None, None) for i in range(60)], 0.5),
        ([*((i, i % 2, i % 2, None) for i in [*range(60), 30, 30]), (None, 1, 1, None), (30, 1, 1, "x")], None),
        ([(22, 1, 1, None), (23, 0, 0, None), (24, 1, 1, None), (25, 0, 0, None)], None),
    ],
)
def test_odd_documents_and_labels(spark, tmp_path, query, label_rows, constant):
    folder, count = labelled(spark, tmp_path, label_rows)
    rows = query(spark, folder).collect()
    assert len(rows) == count
    assert all(0 <= row["score"] <= 1 for row in rows)
    if constant is not None:
        assert {row["score"] for row in rows} == {constant}


@pytest.mark.parametrize("query", [catalog.quality, catalog.toxic])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, tables(spark, tmp_path / "t")).collect() == []


def test_sample_is_bounded_and_fixed(spark):
    docs = documents(spark, [(i, f"text {i} " + "x" * (i % 7 * 20)) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    wanted = F.col("doc_id") % 5 != 0
    one = labelled_sample(docs, labels, "quality", wanted, rows=20, most_bytes=100)
    assert one == labelled_sample(docs.repartition(5), labels.repartition(3), "quality", wanted, rows=20, most_bytes=100)
    assert 0 < len(one[0]) <= 20 and 0 < len(one[1]) <= 20
    for label, texts in zip((1, 0), one, strict=True):
        for text in texts:
            number = int(text.split()[1])
            assert number % 2 == label and number % 5 and len(text) <= 100


def test_quality_score_follows_whole_text():
    good = [text + "." for text in random_texts(1, 300)]
    bad = [text.upper().replace(" ", "!! ") for text in random_texts(2, 300)]
    model = quality.fit(good, bad)
    scores = model.scores(["".join(good[:9]).encode(), "".join(good[:1] + bad[:9]).encode()])
    assert scores[0] > 0.5 > scores[1]


def test_offending_sentences_are_located(spark):
    texts = random_texts(3, 1600)
    quads = [texts[k : k + 4] for k in range(0, 1600, 4)]
    clean = [". ".join(quad) for quad in quads[:200]]
    toxic = [f"{a}. {b} vile{'abcdefg'[k % 7]}x {c}! {d}" for k, (a, b, c, d) in enumerate(quads[200:])]
    model = toxicity.fit(toxic, clean)
    score, found = model.score("first one. Second vilebx here?\nthird. VILECX", 0.5)
    assert score > 0.9 and [row["sentence"] for row in found] == [1, 3]
    assert found[0]["text"] == "Second vilebx here" and all(row["score"] >= 0.5 for row in found)
    # The document's score is the noisy-or of its sentences.
    parts = [model.score(text, 0.5)[0] for text in ("first one", "Second vilebx here", "third", "VILECX")]
    left = 1.0
    for p in parts:
        left *= 1 - p
    assert score == pytest.approx(1 - left)
    docs = documents(spark, [(1, "a b. vilefx"), (2, None)])
    rows = docs.select("doc_id", toxicity.toxicity(model).alias("t")).orderBy("doc_id").collect()
    assert [len(row["t"]["offending"]) for row in rows] == [1, 0] and rows[1]["t"]["score"] == 0


def test_one_text_per_sampled_id(spark):
    """An id that very many rows hold meets the driver once."""
    rows = [(7, f"text {i:05}") for i in range(10_000)] + [(i, "other text") for i in range(20, 60)] + [(7, None)]
    labels = spark.createDataFrame([(7, 1)] * 50 + [(i, i % 2) for i in range(20, 60)], "doc_id long, quality int")
    ones, zeros = labelled_sample(documents(spark, rows), labels, "quality", F.lit(True), rows=30)
    assert len(ones) == 21 and len(zeros) == 20
    assert [text for text in ones if text != "other text"] == ["text 00000"]


def test_scores_mean_the_same_at_any_size(spark):
    """Fitted on as many of either class, and put right by the classes' share among all labels."""
    labels = spark.createDataFrame([(i, int(i % 10 < 8)) for i in range(1000)] + [(3, None), (None, 1)], "doc_id long, quality int")
    assert class_odds(labels, "quality", F.lit(True), rows=5000) == 1.0
    assert class_odds(labels, "quality", F.lit(True), rows=500) == pytest.approx(1.6)
    assert class_odds(labels, "quality", F.lit(True), rows=50) == pytest.approx(4.0)
    assert class_odds(labels.unionByName(labels), "quality", F.lit(True), rows=50) == pytest.approx(4.0)
    assert class_odds(labels.where("quality = 1"), "quality", F.lit(True)) == 1.0
    assert with_odds(0.5, 4.0) == pytest.approx(0.8) and with_odds(0.0, 4.0) == 0.0 and with_odds(1.0, 0.1) == 1.0


@pytest.mark.parametrize(("fit", "query", "label"), [
    (quality.fit_quality, catalog.quality, "quality"), (toxicity.fit_toxicity, catalog.toxic, "toxic"),
])
def test_scores_of_the_fitted_model_in_plain_python(spark, fit, query, label):
    """Every row of the query against the fitted model, sentence by sentence or size by size."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    found = {row["doc_id"]: row["score"] for row in query(spark, SF_DIR).collect()}
    for row in docs.limit(120).collect():
        if label == "quality":
            centre, scale, weights = model.calibration
            sizes = [len(quality._compressor(data).compress(row["text"].encode())) for data in (model.good, model.bad)]
            length = len(row["text"].encode()) + 20
            x = [(sizes[1] - sizes[0]) / length, (sizes[1] - sizes[0]) / sum(sizes), sizes[0] / length, math.log(length)]
            x += [x[i] * x[j] for i in range(4) for j in range(i, 4)]
            z = weights[0] + sum((a - c) / s * w for a, c, s, w in zip(x, centre, scale, weights[1:], strict=True))
            p = 1 / (1 + math.exp(-min(30, max(-30, z))))
        else:
            left = 1.0
            for _, words in toxicity.sentences(row["text"]):
                known = {stem for word in words for stem in toxicity.stems(word) if stem in model.weights}
                left *= 1 - 1 / (1 + math.exp(-model.bias - sum(model.weights[stem] for stem in known)))
            p = 1 - left
        expected = p * model.odds / (p * model.odds + 1 - p)
        assert found[row["doc_id"]] == pytest.approx(expected, rel=1e-6, abs=1e-9)
