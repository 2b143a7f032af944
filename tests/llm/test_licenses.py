"""Licence scans against plain Python."""

import re
from math import log

import numpy as np
import pytest

from clicktrail.llm import catalog, licenses
from tests.llm.helpers import SF_DIR, ascii_lower, by_id, documents, edge_rows, random_texts, tables


def plain_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def brute(rows):
    """Every alignment of every template is tried, from the rarest words on or not."""
    documents_words = [plain_words(text) for _, text in rows]
    templates = [(label, text.split(), [key.split() for key in keys]) for label, text, keys in licenses.TEMPLATES]
    vocabulary = {w for _, words, _ in templates for w in words} | {w for phrase in licenses.BASE for w in phrase.split()}
    order = list(dict.fromkeys(w for _, words, _ in templates for w in words))
    idf = {w: log((len(rows) + 1) / (sum(w in set(d) for d in documents_words) + 1)) + 1 for w in vocabulary}

    def places(words, phrase):
        return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]

    found = []
    for (doc_id, _), words in zip(rows, documents_words, strict=True):
        base = [(k, label) for phrase, label in licenses.BASE.items() for k in places(words, phrase.split())]
        labels, shares = {label for _, label in base}, []
        for label, template, keys in templates:
            number = {w: i for i, w in enumerate(order)}
            anchors = sorted(set(template), key=lambda w: (-idf[w], number[w]))[: licenses.ANCHORS]
            for shift in range(-len(template) + 1, len(words)):
                there = [words[shift + i] if 0 <= shift + i < len(words) else None for i in range(len(template))]
                agreed = {w for w, t in zip(there, template, strict=True) if w == t and w in anchors}
                share = sum(idf[t] for w, t in zip(there, template, strict=True) if w == t) / sum(idf[t] for t in template)
                if 2 * len(agreed) >= len(anchors) and share >= licenses.LEAST_SHARE and any(places(there, k) for k in keys):
                    labels.add(label)
                    shares.append(share)
        score = max(shares) if shares else licenses.BASE_SCORE if base else 0.0
        starts = [k for k, _ in base]
        found.append((
            doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), round(score, 9),
        ))
    return by_id(found)


def rounded(rows):
    return by_id((*row[:-1], round(row[-1], 9)) for row in map(tuple, rows))


def licence_rows():
    rng = np.random.default_rng(1)
    texts = random_texts(5, 60, words=30)
    rows = []
    for number, text in enumerate(texts):
        words = licenses.TEMPLATES[number % len(licenses.TEMPLATES)][1].split()
        for _ in range(number // 20):
            words[rng.integers(len(words))] = "other"
        rows.append((number, f"{text}\n# {' '.join(words).title()}. {texts[0]} MIT license" if number % 3 else text))
    rows.append((900, "Apache, License. apache  license general PUBLIC-license mit\nlicense " * 3))
    return rows


def test_against_brute_force(spark, tmp_path):
    rows = licence_rows() + [(None if i is None else i + 1000, text) for i, text in edge_rows() if len(text or "") < 9000]
    folder = tables(spark, tmp_path / "t", documents=documents(spark, rows, clashing=True))
    found = rounded(catalog.licenses(spark, folder).collect())
    assert found == brute(rows)
    assert len({row[6] for row in found}) > 10


def test_base_columns_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = []
    for doc_id, text in rows:
        words = plain_words(text)
        at = [
            (k, label) for phrase, label in licenses.BASE.items()
            for k in range(len(words)) if words[k] == phrase.split()[0] and words[k : k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in at]
        labels = ",".join(sorted({label for _, label in at}))
        want.append((doc_id, len(words), len(at), min(starts, default=None), max(starts, default=None), labels))
    found = catalog.licenses(spark, SF_DIR).collect()
    assert by_id(tuple(row)[:6] for row in found) == by_id(want)
    for row in found:
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


@pytest.mark.parametrize("text", ["x" * 20000, "license " * 20000])
def test_long_texts(spark, tmp_path, text):
    folder = tables(spark, tmp_path / "t", documents=documents(spark, [(1, text)]))
    assert catalog.licenses(spark, folder).first()["n_words"] == len(text.split())


def test_empty_table(spark, tmp_path):
    assert catalog.licenses(spark, tables(spark, tmp_path / "t")).collect() == []
