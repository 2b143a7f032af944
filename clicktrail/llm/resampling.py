"""Resampling of documents towards a target distribution by hashed n-gram features.

How: a feature is a run of 1 to `max_n` consecutive words; its bucket is the
unsigned CRC-32 of its words, joined by one space, modulo `buckets`. A batch's
texts are joined and searched for words once (see `words`); runs that would
reach over the end of a text are masked by the numbers of their words' texts,
and `bincount` adds up what is left. One pass counts the buckets of the corpus,
one those of the target texts. With s of the corpus' S and t of the target's T
features, a bucket's gain is floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) for B
buckets. A document's weight is the floored mean of its features' gains, its
score the weight and a Gumbel draw that a hash of the seed and the id gives, so
the highest scores are a draw without replacement.

Ranks take no total sort: the driver adds up documents per score, as many
numbers as scores can differ (the range of the gains and that of a 32-bit
Gumbel draw, under 130,000), and finds the score that the draw ends at. Only
the rows from there on are sorted, by range, and equal rows travel as one row
with a count. The driver also holds the two arrays of `buckets` numbers.

Rules: a NULL or empty text has no features and weight 0. A NULL id is hashed
like an empty one and comes last among equal scores. Each row is a document,
also if its id or all of it is repeated; equal rows share out their ranks. Only
documents of at least `least_words` words can be drawn, `percent` in a hundred
of them, rounded down; ties go to the smaller id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import Numbering, batch_of, byte_texts, stored, text_slices
from clicktrail.llm.words import word_windows

BUCKETS = 10_000
MAX_N = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
KNOWN_WORDS = 500_000  # distinct words whose sums a task keeps
COPIES_PER_BLOCK = 100_000  # ranks of equal rows that are made at a time
SLICE_ROWS = 4096


class Features:
    """Buckets of the features of texts; sums of words seen before are kept."""

    def __init__(self, buckets: int = BUCKETS, max_n: int = MAX_N):
        self.buckets, self.max_n = buckets, max_n
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbering()
        self.names: list[bytes] = []
        self.sums = np.zeros(0, np.int64)

    def _numbered(self, words: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if new := len(self.numbers) - len(self.names):
            self.names.extend(list(self.numbers)[-new:])
            sums = np.fromiter(map(zlib.crc32, self.names[-new:]), np.int64, new)
            self.sums = np.concatenate([self.sums, sums])
        return numbers

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(text, bucket, n): arrays of the features of n words, in portions."""
        if len(self.numbers) > KNOWN_WORDS:
            self.forget()
        kept = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for words, text in word_windows(texts):
            # The last words of the window before, for runs that begin there.
            number = np.concatenate([kept[0], self._numbered(words)])
            text = np.concatenate([kept[1], text])
            carried = len(kept[0])
            kept = number[max(0, len(number) - self.max_n + 1) :], text[max(0, len(text) - self.max_n + 1) :]
            sums = self.sums[number]
            for n in range(1, self.max_n + 1):
                if n > 1:
                    sums = self._longer(sums[:-1], number[n - 1 :])
                first = max(0, carried - n + 1)
                whole = text[first : len(sums)] == text[first + n - 1 : len(sums) + n - 1]
                yield text[first : len(sums)][whole], sums[first:][whole] % self.buckets, n

    def _longer(self, sums: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The sums of runs with one more word behind."""
        pairs, place = np.unique(sums << 32 | number[: len(sums)], return_inverse=True)
        made = [zlib.crc32(b" " + self.names[pair & 0xFFFFFFFF], pair >> 32) for pair in pairs.tolist()]
        return np.array(made, np.int64)[place] if made else sums


def feature_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, max_n), np.zeros(buckets, np.int64)
        for batch in batches:
            for start, end in text_slices(batch.column(0), SLICE_ROWS):
                for _, bucket, _ in features.of(byte_texts(batch.column(0), start, end)):
                    total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield batch_of([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature in each bucket adds to a document's weight, in thousandths."""
    s, t = corpus.astype(float), target.astype(float)
    size = float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


@dataclass(frozen=True)
class ImportanceModel:
    """Gains of all buckets, and how features are made."""

    gains: np.ndarray
    max_n: int = MAX_N


def fit_importance(
    docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text",
    buckets: int = BUCKETS, max_n: int = MAX_N,
) -> ImportanceModel:
    """Count the features of all documents and of all target texts."""
    corpus = feature_counts(docs, text_col, buckets, max_n)
    return ImportanceModel(bucket_gains(corpus, feature_counts(target, target_col, buckets, max_n)), max_n)


def importance(model: ImportanceModel, text_col: str = "text") -> Column:
    """A struct column: n_words, n_features, weight."""
    gains, max_n = model.gains, model.max_n

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(len(gains), max_n)
        for texts in batches:
            words, count, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for start, end in text_slices(texts, SLICE_ROWS):
                here, size = slice(start, end), end - start
                for text, bucket, n in features.of(byte_texts(texts, start, end)):
                    found = np.bincount(text, minlength=size)
                    count[here] += found
                    if n == 1:
                        words[here] += found
                    # Sums of whole numbers far below 2^53 are exact.
                    total[here] += np.bincount(text, gains[bucket], size).astype(np.int64)
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.StructArray.from_arrays(
                [pa.array(words), pa.array(count), pa.array(weight)], ["n_words", "n_features", "weight"]
            )

    return weigh(F.col(text_col).cast("string"))


def gumbel_score(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """The weight and a draw, in thousandths, that the seed and the id alone decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    draw = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weight + draw


def _last_score(scored: DataFrame, eligible: Column, percent: int) -> tuple[int, int | None]:
    """How many documents are drawn, and the lowest score among them."""
    counts = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n")).collect()
    most = sum(row["n"] for row in counts) * percent // 100
    left = most
    for row in sorted(counts, key=lambda row: -row["score"]):
        left -= row["n"]
        if left <= 0 < most:
            return most, row["score"]
    return most, None


def _in_order(rows: DataFrame) -> DataFrame:
    """(the columns of `rows`, rank): ranks from 1 by falling score, then rising id."""
    names = rows.columns
    copies = rows.groupBy(*names).agg(F.count("*").alias("copies"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = before + np.cumsum(batch.column("copies").to_numpy())
            first = np.r_[before, ends[:-1]]
            before = int(ends[-1]) if len(ends) else before
            parts = pa.array(np.full(len(first), part))
            yield batch_of([*batch.columns, parts, pa.array(first)], [*batch.schema.names, "part", "first"])

    sorted_rows = copies.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in copies.schema)
    placed = stored(sorted_rows.mapInArrow(place, f"{schema}, part long, first long"), "ranks")
    # One row per task of the sort.
    sizes = placed.groupBy("part").agg(F.sum("copies").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    block = F.lit(COPIES_PER_BLOCK)
    blocks = placed.join(F.broadcast(starts), "part").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / block)))
    )
    before = F.col("start") + F.col("first")
    low = before + F.col("block") * block + 1
    high = F.least(low + block - 1, before + F.col("copies"))
    return blocks.select(*names, F.explode(F.sequence(low, high)).alias("rank"))


def importance_ranks(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    buckets: int = BUCKETS, max_n: int = MAX_N, least_words: int = LEAST_WORDS, percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is NULL for those not drawn."""
    model = fit_importance(docs, target, text_col, target_col, buckets, max_n)
    weighed = docs.select(F.col(id_col).cast("long").alias("doc_id"), importance(model, text_col).alias("found"))
    scored = stored(
        weighed.select("doc_id", "found.*").withColumn("score", gumbel_score(F.col("doc_id"), F.col("weight"), seed)),
        "importance",
    )
    eligible = F.col("n_words") >= least_words
    most, last = _last_score(scored, eligible, percent)
    names = ["doc_id", "n_features", "weight", "score"]
    candidate = F.lit(False) if last is None else eligible & (F.col("score") >= last)
    others = scored.where(~candidate).select(*names, F.lit(None).cast("long").alias("rank"))
    if last is None:
        return others
    rank = F.when(F.col("rank") <= most, F.col("rank")).alias("rank")
    return others.unionByName(_in_order(scored.where(candidate).select(*names)).select(*names, rank))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """The drawn documents with all their columns in the struct `document`, and their rank.

    Ids must be unique here, as they lead from the draw back to the documents;
    a row whose id another row has too comes once for each rank of that id.
    """
    ranks = importance_ranks(docs, target, id_col, text_col, **settings).where("rank IS NOT NULL")
    drawn = ranks.select("doc_id", "weight", "score", "rank")
    whole = docs.select(F.col(id_col).cast("long").alias("own_id"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("document"))
    return drawn.join(whole, drawn["doc_id"].eqNullSafe(whole["own_id"])).select("rank", "weight", "score", "document")
