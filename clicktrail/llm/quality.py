"""Quality scores from compressed sizes.

How: one zstandard dictionary is built from labelled good texts and one from bad
ones. A text is compressed with both; a good text shrinks more with the good
dictionary. The difference of the two sizes, normalised by the text's length
and by the sizes' sum, becomes a score by a logistic calibration, together with
the compressed size by length and the length, which tell how far to trust the
difference (repetitive texts shrink with any dictionary).

Two thirds of the sample build the dictionaries, the rest the calibration. Lines
that occur in at least `SHARED` of the dictionary texts are taken out of them,
since boilerplate of both classes tells nothing. The fit is on at most
`samples.SAMPLE_ROWS` documents of a class, of at most `samples.SAMPLE_BYTES`
bytes each; scores are of whole texts.

Rules: NULL and empty texts score like a text of no bytes. With labels of one
class only every score is that class; without labels it is 0.5. Classes too
small for zstandard's dictionary builder give their plain text as dictionary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.samples import class_odds, fold, labelled_sample, logistic, with_odds

DICTIONARY_BYTES = 112_640
PART = 2000  # bytes of a sample that the dictionary builder takes at a time
SHARED = 3
LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    calibration: tuple | None  # centre, scale, weights
    constant: float = 0.5
    odds: float = 1.0

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.constant)
        centre, scale, weights = self.calibration
        x = (features(self.good, self.bad, texts) - centre) / scale
        return with_odds(1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30))), self.odds)


def dictionary(texts: list[bytes]) -> bytes:
    parts = [text[i : i + PART] for text in texts for i in range(0, len(text), PART)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False)


def features(good: bytes, bad: bytes, texts: list[bytes]) -> np.ndarray:
    """Normalised size differences, compressed size and length, and their products."""
    if not texts:
        return np.zeros((0, 14))
    compressors = [_compressor(good), _compressor(bad)]
    sizes = np.array([[len(c.compress(text)) for c in compressors] for text in texts], float)
    length = np.array([len(text) for text in texts], float) + 20
    difference = sizes[:, 1] - sizes[:, 0]
    plain = [difference / length, difference / sizes.sum(axis=1), sizes[:, 0] / length, np.log(length)]
    return np.stack([*plain, *(plain[i] * plain[j] for i in range(4) for j in range(i, 4))], axis=1)


def fit(good: list[str], bad: list[str]) -> QualityModel:
    """The model of texts with label 1 and label 0."""
    if not good or not bad:
        return QualityModel(b"", b"", None, 1.0 if good else 0.0 if bad else 0.5)
    cuts = [max(1, 2 * len(texts) // 3) for texts in (good, bad)]
    kept = [[text.encode() for text in texts[:cut]] for texts, cut in zip((good, bad), cuts, strict=True)]
    seen = Counter(line for texts in kept for text in texts for line in set(text.split(b"\n")))
    trimmed = [
        [b"\n".join(line for line in text.split(b"\n") if seen[line] < SHARED) for text in texts] for texts in kept
    ]
    dictionaries = [dictionary(texts) for texts in trimmed]
    # A class of one text has no other text to calibrate on.
    rest = [[t.encode() for t in texts[cut:] or texts] for texts, cut in zip((good, bad), cuts, strict=True)]
    x = features(*dictionaries, rest[0] + rest[1])
    return QualityModel(*dictionaries, logistic(x, np.repeat([1.0, 0.0], [len(rest[0]), len(rest[1])])))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> QualityModel:
    """Fit on the labelled documents outside the held-out fold of ids."""
    wanted = fold(F.col("doc_id"), folds) != held_out
    model = fit(*labelled_sample(docs, labels, "quality", wanted))
    return replace(model, odds=class_odds(labels, "quality", wanted))


def quality_score(model: QualityModel, text_col: str = "text") -> Column:
    """The score of each text: 0 to 1, higher where label 1 is likelier."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([(text or "").encode() for text in texts]))

    return score(F.col(text_col))
