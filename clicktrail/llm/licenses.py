"""Scanning texts for licences by a positional index of rare licence words.

How: the words of the licence templates are counted over all documents, which
gives each word's inverse document frequency. Of each template the `ANCHORS`
words with the highest are looked up in a text; each place of an anchor in the
text and in the template gives a relative position, and a template whose
anchors agree on one is aligned there. The aligned words are weighed by their
inverse document frequency, and the template counts if at least `LEAST_SHARE`
of its weight stands where it should and one of its mandatory key phrases
stands within the aligned stretch.

The base labels need no template: they are the places where a phrase's words
stand one after the other. A template adds its label to them.

Rules: words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are
lower-cased; a NULL or empty text has none. Every place of a text is searched.
The score is the largest share of a template that counts, or, where only base
phrases are found, `BASE_SCORE`; 0 without labels.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, text_slices

ANCHORS = 4
LEAST_SHARE = 0.6
BASE_SCORE = 0.5
RESULT = (
    "struct<n_words:long,places:array<struct<label:string,word:long>>,"
    "found:array<struct<label:string,template:int,word:long,share:double>>,score:double>"
)

# The phrases of the base labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and key phrases of public licences, in lower-case words.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation",
     ["gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ["lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
     ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met",
     ["redistribution and use in source and binary forms"]),
    ("bsd", "released under the bsd license", ["bsd license"]),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0", "cc by 3 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0", "creative commons attribution 3 0"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted",
     ["with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["released into the public domain"]),
    ("proprietary", "copyright all rights reserved", ["all rights reserved"]),
]

# Upper-case letters become lower-case, other ASCII but digits and letters a space.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class LicenceIndex:
    """Vocabulary of templates and phrases, and postings of each template's anchors."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.vocabulary: dict[bytes, int] = {}
        self.labels = [label for label, _, _ in templates]
        self.templates = [self._numbers(text) for _, text, _ in templates]
        self.keys = [[self._numbers(phrase) for phrase in phrases] for _, _, phrases in templates]
        self.base = [(label, self._numbers(phrase)) for phrase, label in base.items()]
        self.weigh(np.ones(len(self.vocabulary)))

    def _numbers(self, text: str) -> np.ndarray:
        return np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text.encode())], np.int64)

    def weigh(self, idf: np.ndarray) -> None:
        """Choose the anchors: of each template the words with the highest idf, and all their places."""
        self.idf = idf
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, words in enumerate(self.templates):
            rarest = sorted(set(words.tolist()), key=lambda w: (-idf[w], w))[:ANCHORS]
            for place, word in enumerate(words.tolist()):
                if word in rarest:
                    self.postings[word].append((number, place))
        # The last entry answers for -1, a word outside the vocabulary.
        self.is_anchor = np.zeros(len(idf) + 1, bool)
        self.is_anchor[list(self.postings)] = True

    def numbers(self, words: list[bytes]) -> np.ndarray:
        known = self.vocabulary
        return np.fromiter((known.get(word, -1) for word in words), np.int64, len(words))

    def scan(self, text: bytes) -> dict:
        """n_words, all places of base phrases, the aligned templates and the score."""
        words = words_of(text)
        numbers = self.numbers(words)
        places = [
            {"label": label, "word": place} for label, phrase in self.base for place in _places(numbers, phrase).tolist()
        ]
        found = self._aligned(numbers)
        shares = [hit["share"] for hit in found]
        score = max(shares) if shares else BASE_SCORE if places else 0.0
        return {"n_words": len(words), "places": places, "found": found, "score": score}

    def _aligned(self, numbers: np.ndarray) -> list[dict]:
        votes: dict[tuple[int, int], set[int]] = defaultdict(set)
        for place in np.flatnonzero(self.is_anchor[numbers]).tolist():
            word = int(numbers[place])
            for template, at in self.postings[word]:
                votes[template, place - at].add(word)
        best: dict[int, dict] = {}
        for (template, shift), agreed in votes.items():
            words = self.templates[template]
            if 2 * len(agreed) < min(ANCHORS, len(set(words.tolist()))):
                continue
            there = np.full(len(words), -1, np.int64)
            low, high = max(0, shift), min(len(numbers), shift + len(words))
            there[low - shift : high - shift] = numbers[low:high]
            weights = self.idf[words]
            share = float(weights[there == words].sum() / weights.sum()) if weights.sum() else 0.0
            if share < LEAST_SHARE or not any(len(_places(there, key)) for key in self.keys[template]):
                continue
            if template not in best or (share, -low) > (best[template]["share"], -best[template]["word"]):
                best[template] = {"label": self.labels[template], "template": template, "word": low, "share": share}
        return [best[template] for template in sorted(best)]


def _places(numbers: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand one after the other."""
    count = len(numbers) - len(phrase) + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    same = np.ones(count, bool)
    for offset, word in enumerate(phrase.tolist()):
        same &= numbers[offset : offset + count] == word
    return np.flatnonzero(same)


def document_frequencies(docs: DataFrame, index: LicenceIndex, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each word of the index occurs, and the number of documents."""
    size = len(index.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for text in (t for at in text_slices(texts) for t in byte_texts(texts, *at)):
                known = {index.vocabulary.get(word, size) for word in set(words_of(text))}
                total[[word for word in known if word < size]] += 1
                total[size] += 1
        yield batch_of([pa.array(np.arange(size + 1)), pa.array(total)], ["word", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "word long, n long")
    found = np.zeros(size + 1, np.int64)
    for word, n in counted.groupBy("word").agg(F.sum("n")).collect():
        found[word] = n
    return found[:size], int(found[size])


def licence_scan(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, base=BASE) -> Column:
    """A struct column of `docs`: n_words, places (base phrases), found (templates), score."""
    index = LicenceIndex(templates, base)
    frequencies, total = document_frequencies(docs, index, text_col)
    index.weigh(np.array([log((total + 1) / (n + 1)) + 1 for n in frequencies.tolist()]))

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [index.scan((text or "").encode()) for text in texts]
            yield pd.DataFrame(rows, columns=["n_words", "places", "found", "score"])

    return scan(F.col(text_col))
