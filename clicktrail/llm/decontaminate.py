"""Finding test items in training documents: seeds, then local alignment.

How: texts become lower-case words. Every word 3-gram of the test items is a
seed, so any three words in a row that a document shares with an item are found.
Documents are scanned for the seeds in place, without a shuffle; around the hits of an item Smith-Waterman aligns the item's words with
the document's (match 2, mismatch and gap -1). The similarity is the alignment's
score as a fraction of the item's own, so edited and paraphrased copies score
by what is left. A window whose words can't reach the threshold even in the best
order isn't aligned.

The items go to the tasks in blocks of a bounded number of words, each with a
scan of its own, so that a large benchmark takes more scans and not more memory.

Rules: a document is contaminated by an item from similarity `threshold` on, if
at least `MIN_MATCH` words match or the whole item does. Items with NULL id or
text, or with fewer words than a seed, take no part; nor do NULL and empty
documents. Repeated items and documents are reported each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED_WORDS = 3
MIN_MATCH = 8
BLOCK_WORDS = 1 << 20  # words of test items that are searched in one scan; 2^21 fit a seed's key
MATCH, MISMATCH, GAP = 2, -1, -1
COUNT_BITS = 24  # of an alignment's matching words, beside its score
# Blocks of scripts that put no space between words; there each character is a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(f"[{UNSPACED}]|[^\\W{UNSPACED}]+")
HITS = "array<struct<item_id:long,similarity:double,first_word:long,last_word:long>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class SeedIndex:
    """Seeds of a block of test items: all their 3-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.item_ids: list[int] = []
        self.items: list[np.ndarray] = []
        for item_id, text in items:
            words = words_of(text)
            if len(words) >= SEED_WORDS:
                numbers = [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words]
                self.item_ids.append(item_id)
                self.items.append(np.array(numbers, np.int64))
        grams = [self.grams(item) for item in self.items]
        at = [(key, number, place) for number, keys in enumerate(grams) for place, key in enumerate(keys.tolist())]
        rows = np.array(sorted(at), np.int64).reshape(-1, 3)
        self.keys, self.starts = np.unique(rows[:, 0], return_index=True)
        self.stops = np.r_[self.starts[1:], len(rows)].astype(np.int64)
        self.postings = rows

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """Key of each 3-gram, -1 if a word is in no item."""
        a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
        size = len(self.vocabulary)
        return np.where((a >= 0) & (b >= 0) & (c >= 0), (a * size + b) * size + c, -1)

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter((self.vocabulary.get(word, -1) for word in words), np.int64, len(words))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the document and the indexes of the seeds there."""
        keys = self.grams(numbers) if len(numbers) >= SEED_WORDS else np.zeros(0, np.int64)
        places = np.flatnonzero(keys >= 0)
        if not len(places) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.minimum(np.searchsorted(self.keys, keys[places]), len(self.keys) - 1)
        same = self.keys[found] == keys[places]
        return places[same], found[same]


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int, int]:
    """(score, last place in the item, last place in the window, matching words) of the best local alignment.

    Of alignments with the same score the one with the most matching words is
    the best: they are counted in the lower bits of the scores.
    """
    one = 1 << COUNT_BITS
    places = -GAP * one * np.arange(len(window) + 1)
    before = np.zeros(len(window) + 1, np.int64)
    best, at = 0, (-1, -1)
    for i, word in enumerate(item):
        row = np.zeros(len(window) + 1, np.int64)
        row[1:] = before[:-1] + np.where(window == word, MATCH * one + 1, MISMATCH * one)
        np.maximum(row, before + GAP * one, out=row)
        row[row < one] = 0
        before = np.maximum.accumulate(row + places) - places
        before[before < one] = 0
        j = int(before.argmax())
        if before[j] > best:
            best, at = int(before[j]), (i, j - 1)
    return best >> COUNT_BITS, *at, best & one - 1


def _contained(index: SeedIndex, numbers: np.ndarray, threshold: float) -> list[dict]:
    """The items that a document contains, each by its best alignment."""
    places, seeds = index.hits(numbers)
    if not len(places):
        return []
    repeat = index.stops[seeds] - index.starts[seeds]
    at = np.repeat(index.starts[seeds], repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    item_of = index.postings[at, 1]
    shift = np.repeat(places, repeat) - index.postings[at, 2]
    order = np.lexsort((shift, item_of))
    item_of, shift = item_of[order], shift[order]
    found = []
    for number in np.unique(item_of).tolist():
        item = index.items[number]
        size, slack = len(item), len(item) // 2 + 2
        shifts = np.unique(shift[item_of == number])
        parts = np.split(shifts, np.flatnonzero(np.diff(shifts) > size + 2 * slack) + 1)
        present = np.bincount(item)
        best = None
        for part in parts:
            low = max(0, int(part[0]) - slack)
            window = numbers[low : int(part[-1]) + size + slack]
            here = window[(window >= 0) & (window < len(present))]
            shared = np.minimum(present, np.bincount(here, minlength=len(present))).sum()
            if shared < threshold * size:
                continue
            score, last_item, last, matching = align(item, window)
            if best is None or (score, matching) > (best[0], best[3]):
                back = align(item[: last_item + 1][::-1], window[: last + 1][::-1])
                best = (score, low + last - back[2], low + last, matching)
        if best is None:
            continue
        similarity = best[0] / (MATCH * size)
        if similarity >= threshold and (best[3] >= MIN_MATCH or similarity == 1):
            found.append({
                "item_id": index.item_ids[number], "similarity": similarity, "first_word": best[1], "last_word": best[2]
            })
    return found


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items with about BLOCK_WORDS words each, in the driver one after the other."""
    items = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")
    )
    # No text has more words than characters.
    words = F.ceil(F.length("text") / F.lit(2)) + F.regexp_count("text", F.lit(f"[{UNSPACED}]"))
    total = items.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    blocks = 1 + total // BLOCK_WORDS
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted(tuple(row) for row in mine.collect())


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.5,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> Column:
    """A column of `docs`: the items that each document contains.

    An array of item_id, similarity, and the document's first and last word
    (from 0) that the best alignment covers.
    """

    def search(index: SeedIndex) -> Column:
        @F.pandas_udf(HITS)
        def hits(texts: pd.Series) -> pd.Series:
            return pd.Series([_contained(index, index.numbers(text), threshold) for text in texts])

        return hits(F.col(text_col))

    found = []
    for block in _item_blocks(benchmark, item_id_col, item_text_col):
        index = SeedIndex(block)
        if index.items:
            found.append(search(index))
    return F.concat(*found) if found else F.array().cast(HITS)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, last_word) of each item in each document."""
    hits = docs.select(F.col(id_col).alias("doc_id"), F.explode(contained_items(docs, benchmark, threshold)).alias("hit"))
    return hits.select("doc_id", "hit.*")


def without_items(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that contain no item."""
    return docs.where(F.size(contained_items(docs, benchmark, threshold)) == 0)
