"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 4000  # documents of each class
SAMPLE_BYTES = 1 << 16  # longer documents are not fitted on


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def _known(labels: DataFrame, label: str, wanted: Column, id_col: str) -> DataFrame:
    """(chosen_id, is): the label of each id, the larger one where rows differ."""
    known = labels.where(F.col(id_col).isNotNull() & wanted).select(
        F.col(id_col).cast("long").alias("chosen_id"), F.col(label).cast("int").alias("is")
    )
    return known.where(F.col("is").isin(0, 1)).groupBy("chosen_id").agg(F.max("is").alias("is"))


def class_odds(
    labels: DataFrame, label: str, wanted: Column, rows: int = SAMPLE_ROWS, id_col: str = "doc_id"
) -> float:
    """How much more often label 1 is, beside label 0, among all labels than among those sampled.

    Scores fitted on the sample are put right by it, so that they mean the same
    at any size of the tables.
    """
    counts = {row["is"]: row["n"] for row in _known(labels, label, wanted, id_col).groupBy("is").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    return (ones / zeros) / (min(ones, rows) / min(zeros, rows)) if ones and zeros else 1.0


def with_odds(score, odds: float):
    """A probability, or an array of them, whose odds are `odds` times those of `score`."""
    return score * odds / (score * odds + (1 - score))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    wanted: Column,
    rows: int = SAMPLE_ROWS,
    most_bytes: int = SAMPLE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[list[str], list[str]]:
    """Texts with label 1 and with label 0, at most `rows` of each, in a fixed mixed order.

    `wanted` is a condition on the labels' ids. The ids are chosen by their
    hash; at most 2 * `rows` of them meet the documents, which are not shuffled.
    Documents of more than `most_bytes` bytes or without text are left out; of
    several documents with a chosen id the smallest text is taken.
    """
    known = _known(labels, label, wanted, id_col)
    mixed = [F.xxhash64("chosen_id"), F.col("chosen_id")]
    classes = [known.where(F.col("is") == value).orderBy(*mixed).limit(rows) for value in (0, 1)]
    chosen = classes[0].unionByName(classes[1])
    texts = docs.where(F.octet_length(text_col).between(1, most_bytes)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    # One text per id, so that the driver gets no more than it asked for ids.
    single = joined.groupBy("doc_id", "is").agg(F.min("text").alias("text"))
    found = single.select(F.xxhash64("doc_id").alias("mix"), "doc_id", "text", "is").collect()
    found.sort(key=lambda row: (row["mix"], row["doc_id"], row["text"], row["is"]))
    return [row["text"] for row in found if row["is"] == 1], [row["text"] for row in found if row["is"] == 0]


def logistic(features, labels, ridge: float = 1.0, rounds: int = 30):
    """(centre, scale, weights) of a ridge-penalised logistic regression, by Newton's method."""
    import numpy as np

    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.c_[np.ones(len(features)), (features - centre) / scale]
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curvature = (x * (p * (1 - p))[:, None]).T @ x + penalty
        weights -= np.linalg.solve(curvature, x.T @ (p - labels) + penalty @ weights)
    return centre, scale, weights
