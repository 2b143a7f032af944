"""Ranked lexical search of a set of items over all documents, by classes of equal bags.

How: the terms of the items are the vocabulary. One pass over the documents
counts each document's terms and restricts it to its bag: the numbers and counts
of its vocabulary terms. Sums over the bags give N, L and the document
frequencies. Documents with the same bag and the same length factor m score the
same for every item, so they form one class: rows are dealt by a hash of (m,
bag) and compared by the values themselves, each task sends on no more than the
k smallest ids of a class, and a class is scored once. Scoring adds a term's
impacts to the items on the term's posting list. A task keeps per item the k
best classes by (score, smallest id): further classes can't reach the item's
first k documents. Classes become documents in ascending order of their ids
last, and the tasks' lists are merged.

Terms are weighed by floor(1000 ln((2N+2) / (2 df+1))), a document's score is
the sum over the item's distinct terms of

    weight * ((10^9 tf) div (1000 tf + 20 m)),  m = 100 - b + ((b n N) div L)

with b = 50, n the document's terms, N the documents with terms, L all terms.

Items are searched in blocks of bounded size, each with a pass of its own over
the documents, and each block's result is stored before the next begins: the
driver and the tasks hold one block's terms and postings.

Rules: NULL and empty texts have no terms, are not counted and never found. Rows
of items with the same id, NULL included, are one item with the terms of all.
Each row of documents is a document, also if its id or all of it is repeated;
of equal scores the smaller id comes first, NULL last. Scores of 0 aren't listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, settled, stored, text_slices
from clicktrail.llm.words import word_windows

TOP_K = 50
LENGTH_SHARE = 50  # b above: of 100, how much the length counts
BLOCK_TERMS = 1 << 20  # about how many terms of items are searched in one pass
SCORED_AT_ONCE = 1 << 22  # sums, and additions to them, that a task holds
SLICE_ROWS = 4096
LAST = np.iinfo(np.int64).max

RESULT = "item_id long, doc_id long, score long"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the distinct terms of each item, in bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                found: set[bytes] = set()
                for words, _ in word_windows(byte_texts(batch.column(1), row, row + 1)):
                    found.update(words)
                ids = pa.array(batch.column(0).slice(row, 1).to_pylist() * len(found), pa.int64())
                yield batch_of([ids, pa.array(sorted(found), pa.binary())], ["item_id", "term"])

    named = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(split, "item_id long, term binary").distinct()


class Postings:
    """The terms of a block of items, numbered, and the items that hold each."""

    def __init__(self, pairs: list[tuple[int | None, bytes]]):
        self.item_ids = sorted({item for item, _ in pairs}, key=lambda item: (item is None, item or 0))
        self.vocabulary = {term: number for number, term in enumerate(sorted({term for _, term in pairs}))}
        place = {item: number for number, item in enumerate(self.item_ids)}
        rows = np.array(sorted((self.vocabulary[term], place[item]) for item, term in pairs), np.int64).reshape(-1, 2)
        self.sizes = np.bincount(rows[:, 0], minlength=len(self.vocabulary))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.items = rows[:, 1].copy()


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, bag) of every document with terms.

    `bag` has the numbers of the document's vocabulary terms in ascending order
    and how often each occurs, by turns, as little-endian unsigned 32-bit integers.
    """
    size = len(vocabulary)

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(word: bytes) -> int:
            return vocabulary.get(word, -1)

        for batch in batches:
            for start, end in text_slices(batch.column(1), SLICE_ROWS):
                length = np.zeros(end - start, np.int64)
                keys, counts = [], []
                for words, text in word_windows(byte_texts(batch.column(1), start, end)):
                    length += np.bincount(text, minlength=end - start)
                    numbers = np.fromiter(map(number, words), np.int64, len(words))
                    known = numbers >= 0
                    key, count = np.unique(text[known] * size + numbers[known], return_counts=True)
                    keys.append(key)
                    counts.append(count)
                # A text that reaches over several windows has its counts added up.
                key, place = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
                count = np.bincount(place, np.concatenate([*counts, np.zeros(0, np.int64)]), len(key))
                flat = np.stack([key % max(size, 1), count.astype(np.int64)], axis=1).astype("<u4").tobytes()
                ends = 8 * np.cumsum(np.bincount(key // max(size, 1), minlength=end - start))
                bounds = zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)
                values = pa.array([flat[i:j] for i, j in bounds], pa.binary())
                made = batch_of([batch.column(0).slice(start, end - start), pa.array(length), values], ["doc_id", "n", "bag"])
                yield made.filter(pa.array(length > 0))

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(restrict, "doc_id long, n long, bag binary")


def corpus_statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of each of the `size` terms, over all bags."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4")
            total[:size] += np.bincount(flat[0::2], minlength=size)
            total[size] += len(batch)
            total[size + 1] += pa.compute.sum(batch.column(0)).as_py() or 0
        at = np.flatnonzero(total)
        yield batch_of([pa.array(at), pa.array(total[at])], ["at", "n"])

    total = [0] * (size + 2)
    counted = found.select("n", "bag").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n"))
    for at, n in counted.collect():
        total[at] = n
    return total[size], total[size + 1], np.array(total[:size], np.int64)


def term_weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    ratio = (2 * documents + 2) / (2 * frequencies + 1).astype(float)
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def bag_classes(found: DataFrame, documents: int, terms: int, k: int) -> DataFrame:
    """(m, bag, members): each different pair once, with its k smallest ids in ascending order."""
    m = F.expr(f"{100 - LENGTH_SHARE}L + (({LENGTH_SHARE}L * n * {documents}L) div {max(terms, 1)}L)")
    rows = found.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    rows = rows.withColumn("h", F.xxhash64("m", "bag"))
    same = ["h", "m", "bag"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))
    members = F.array_sort(F.collect_list(F.struct("place", "doc_id")))
    first = rows.withColumn("place", place).where(F.col("place") <= k)
    return first.groupBy(*same).agg(members.alias("members")).select("m", "bag", F.col("members.doc_id").alias("members"))


class BestClasses:
    """For each item the k best classes so far, by (score, smallest id)."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a lower score can't be among the k best
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, first id, class
        self.fresh: list[list[np.ndarray]] = []
        self.count = 0
        self.members: dict[int, list] = {}

    def add(self, scores: np.ndarray, members: list[list], first: np.ndarray) -> None:
        """A (class, item) table of scores, and the classes' members."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        number = len(self.members) and max(self.members) + 1
        for at in np.unique(row).tolist():
            self.members[number + at] = members[at]
        self.fresh.append([item, scores[row, item], first[row], number + row])
        self.count += len(row)
        if self.count > 4 * self.k * len(self.least) + SCORED_AT_ONCE // 4:
            self.settle()

    def settle(self) -> None:
        item, score, first, number = (np.concatenate(x) for x in zip(self.held, *self.fresh, strict=True))
        order = np.lexsort((first, -score, item))
        item, score, first, number = item[order], score[order], first[order], number[order]
        begin = np.searchsorted(item, np.arange(len(self.least)))
        rank = np.arange(len(item)) - begin[item]
        kept = rank < self.k
        full = rank == self.k - 1
        self.least[item[full]] = score[full]
        self.held = [item[kept], score[kept], first[kept], number[kept]]
        self.fresh, self.count = [], 0
        used = set(self.held[3].tolist())
        self.members = {number: ids for number, ids in self.members.items() if number in used}

    def documents(self) -> Iterator[tuple[int, int | None, int]]:
        """(item, id, score) of each item's k best documents."""
        self.settle()
        item, score, _, number = (x.tolist() for x in self.held)
        begin = np.searchsorted(self.held[0], np.arange(len(self.least) + 1)).tolist()
        for i in range(len(self.least)):
            found = [
                (-score[at], member is None, member or 0, member)
                for at in range(begin[i], begin[i + 1])
                for member in self.members[number[at]]
            ]
            for loss, _, _, member in sorted(found, key=lambda x: x[:3])[: self.k]:
                yield item[begin[i]], member, -loss


def class_scores(
    m: np.ndarray, bag: list[bytes], postings: Postings, weights: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, scores of classes start..end for all items), in portions of bounded size."""
    sizes = np.array([len(value) // 8 for value in bag], np.int64)
    flat = np.frombuffer(b"".join(bag), "<u4").astype(np.int64)
    term, tf = flat[0::2], flat[1::2]
    row = np.repeat(np.arange(len(bag)), sizes)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
    term, row, impact = term[impact > 0], row[impact > 0], impact[impact > 0]
    adds = postings.sizes[term]
    per_class = np.bincount(row, adds, len(bag)).astype(np.int64) + len(postings.item_ids)
    portion = np.cumsum(per_class) // SCORED_AT_ONCE
    starts = np.flatnonzero(np.r_[True, portion[1:] != portion[:-1]])
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(bag)], strict=True):
        low, high = np.searchsorted(row, [start, end])
        n = adds[low:high]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(postings.starts[term[low:high]], n)
        scores = np.zeros((end - start) * len(postings.item_ids), np.int64)
        key = np.repeat((row[low:high] - start) * len(postings.item_ids), n) + postings.items[at]
        np.add.at(scores, key, np.repeat(impact[low:high], n))
        yield start, end, scores.reshape(end - start, -1)


def _search_block(docs: DataFrame, postings: Postings, k: int, id_col: str, text_col: str) -> DataFrame:
    found = stored(bags(docs, postings.vocabulary, id_col, text_col), "bags")
    documents, terms, frequencies = corpus_statistics(found, len(postings.vocabulary))
    weights = term_weights(frequencies, documents)
    postings.vocabulary = {}  # the bags hold numbers: the tasks need the words no more

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestClasses(len(postings.item_ids), k)
        for batch in batches:
            for low in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(low, SLICE_ROWS)
                members = part.column(2).to_pylist()
                first = np.array([LAST if ids[0] is None else ids[0] for ids in members], np.int64)
                m, bag = part.column(0).to_numpy(), part.column(1).to_pylist()
                for start, end, scores in class_scores(m, bag, postings, weights):
                    best.add(scores, members[start:end], first[start:end])
        rows = list(best.documents())
        columns = [
            pa.array([postings.item_ids[item] for item, _, _ in rows], pa.int64()),
            pa.array([doc_id for _, doc_id, _ in rows], pa.int64()),
            pa.array([score for _, _, score in rows], pa.int64()),
        ]
        yield batch_of(columns, ["item_id", "doc_id", "score"])

    scored = bag_classes(found, documents, terms, k).mapInArrow(score, RESULT)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return stored(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = TOP_K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, the best first."""
    terms = settled(item_terms(items, item_col, item_text))
    blocks = -(-terms.count() // BLOCK_TERMS)
    result = None
    for number in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        postings = Postings([(row["item_id"], bytes(row["term"])) for row in own.collect()])
        if postings.item_ids:
            part = _search_block(docs, postings, k, id_col, text_col)
            result = part if result is None else result.unionByName(part)
    if result is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result
