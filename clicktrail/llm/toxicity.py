"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

How: a sentence's probability is logistic in the words it holds and in their
first letters (stems of 3 to 6), with weights of 0 or more. A document's is the
noisy-or of its sentences: toxic if any sentence is. The weights are trained on
the documents' labels alone, by gradient steps on the noisy-or likelihood with
an L1 penalty; the stems to weigh are those that stand out in sentences of toxic
documents. The same sentence probabilities then locate the offending sentences.

The fit is on at most `samples.SAMPLE_ROWS` documents of a class, of at most
`samples.SAMPLE_BYTES` bytes each; scores are of whole texts.

Rules: sentences end at . ! ? and line feeds; those without letters are none. A
text without sentences (NULL, empty) has probability 0. With labels of one class
only every score is that class; without labels it is 0.5; no sentence offends
then.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.samples import class_odds, fold, labelled_sample, with_odds

SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
STEMS = (3, 4, 5, 6)
MOST_STEMS = 4000
LEAST_SEEN = 4  # sentences of toxic documents that hold a stem
STANDS_OUT = 2.5  # standard deviations above the expected number
ROUNDS = 200
RATE = 0.1
PENALTY = 1e-4
RESULT = "struct<score:double,offending:array<struct<sentence:int,score:double,text:string>>>"


def stems(word: str) -> list[str]:
    return [f"{word}$", *(word[:size] for size in STEMS if len(word) > size)]


def sentences(text: str) -> Iterator[tuple[str, list[str]]]:
    for sentence in SENTENCE.split(text):
        words = WORD.findall(sentence.lower())
        if words:
            yield sentence, words


def _stems_of(words: list[str]) -> set[str]:
    return {stem for word in words for stem in stems(word)}


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    constant: float | None = None
    odds: float = 1.0
    words: dict[str, tuple] = field(default_factory=dict, repr=False)

    def _known(self, word: str) -> tuple:
        found = self.words.get(word)
        if found is None:
            if len(self.words) > 200_000:
                self.words.clear()
            found = self.words[word] = tuple(stem for stem in stems(word) if stem in self.weights)
        return found

    def score(self, text: str, threshold: float) -> tuple[float, list[dict]]:
        """The document's probability and its sentences from `threshold` on."""
        if self.constant is not None:
            return self.constant, []
        clean, offending = 0.0, []
        plain = -np.logaddexp(0, self.bias)
        for number, (sentence, words) in enumerate(sentences(text)):
            known = {stem for word in words for stem in self._known(word)}
            if known:
                logit = self.bias + sum(self.weights[stem] for stem in sorted(known))
                clean -= np.logaddexp(0, logit)
                p = 1 / (1 + np.exp(-logit))
                if p >= threshold:
                    offending.append({"sentence": number, "score": float(p), "text": sentence.strip()})
            else:
                clean += plain
        return with_odds(float(-np.expm1(clean)), self.odds), offending


def _candidates(toxic: list[str], clean: list[str]) -> list[str]:
    """Stems that occur in more sentences of toxic documents than their share of sentences lets expect."""
    seen, counts = (Counter(), Counter()), [0, 0]
    for of, texts in enumerate((toxic, clean)):
        for text in texts:
            for _, words in sentences(text):
                seen[of].update(_stems_of(words))
                counts[of] += 1
    share = counts[0] / max(1, sum(counts))
    excess = {}
    for stem, n in seen[0].items():
        expected = share * (n + seen[1][stem])
        excess[stem] = (n - expected) / np.sqrt(expected + 1)
    kept = [stem for stem, value in excess.items() if value > STANDS_OUT and seen[0][stem] >= LEAST_SEEN]
    return sorted(kept, key=lambda stem: (-excess[stem], stem))[:MOST_STEMS]


def fit(toxic: list[str], clean: list[str]) -> ToxicityModel:
    """The model of texts with label 1 and label 0."""
    if not toxic or not clean:
        return ToxicityModel({}, 0.0, 1.0 if toxic else 0.0 if clean else 0.5)
    names = _candidates(toxic, clean)
    index = {name: i for i, name in enumerate(names)}
    stem_of, sentence_of, doc_of = [], [], []
    for number, text in enumerate(toxic + clean):
        for _, words in sentences(text):
            known = sorted(index[stem] for stem in _stems_of(words) if stem in index)
            stem_of.extend(known)
            sentence_of.extend([len(doc_of)] * len(known))
            doc_of.append(number)
    stem_of, sentence_of, doc_of = (np.array(x, np.int64) for x in (stem_of, sentence_of, doc_of))
    labels = np.repeat([1.0, 0.0], [len(toxic), len(clean)])
    n_docs, n_stems = len(labels), len(names)

    # Adam on the mean log-likelihood; weights are kept at 0 or more.
    x = np.r_[np.zeros(n_stems), -7.0]
    mean, square = np.zeros(n_stems + 1), np.zeros(n_stems + 1)
    for step in range(1, ROUNDS + 1):
        logit = x[-1] + np.bincount(sentence_of, x[stem_of], len(doc_of))
        p = 1 / (1 + np.exp(-logit))
        doc = np.clip(-np.expm1(np.bincount(doc_of, -np.logaddexp(0, logit), n_docs)), 1e-6, 1 - 1e-6)
        slope = np.where(labels[doc_of] == 1, (1 - doc[doc_of]) / doc[doc_of] * p, -p)
        towards = np.bincount(stem_of, slope[sentence_of], n_stems) / n_docs - PENALTY
        towards = np.r_[towards, slope.sum() / n_docs]
        mean, square = 0.9 * mean + 0.1 * towards, 0.99 * square + 0.01 * towards**2
        x += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        x[:-1] = np.maximum(x[:-1], 0)
    weights = {name: float(x[i]) for i, name in enumerate(names) if x[i] > 0}
    return ToxicityModel(weights, float(x[-1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> ToxicityModel:
    """Fit on the labelled documents outside the held-out fold of ids."""
    wanted = fold(F.col("doc_id"), folds) != held_out
    model = fit(*labelled_sample(docs, labels, "toxic", wanted))
    return replace(model, odds=class_odds(labels, "toxic", wanted))


def toxicity(model: ToxicityModel, threshold: float = 0.5, text_col: str = "text") -> Column:
    """A struct of each text's score and its offending sentences (number, score, text)."""

    @F.pandas_udf(RESULT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [model.score(text or "", threshold) for text in texts]
            yield pd.DataFrame(found, columns=["score", "offending"])

    return score(F.col(text_col))
