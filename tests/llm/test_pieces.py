"""Merge rounds against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from clicktrail.llm import catalog, pieces
from tests.llm.helpers import EDGE_TEXTS, SF_DIR, by_id, documents, edge_rows, tables

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


def encoded(model, texts):
    ids, counts = model.encode(texts)
    ends = counts.cumsum()
    return [ids[end - count : end].tolist() for end, count in zip(ends, counts, strict=True)]


def odd_texts(count):
    parts = [
        "a", "the", " ", "  ", "▁", "\n", "é", "日本", "😀", "12", " in", "ing", "<s>", "<0x0A>", "\x00", "\t",
        "aaaa", "zz", "́", "%%%", "THE", " " * 7, "ab" * 3,
    ]
    rng = random.Random(5)
    return ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(count)]


def test_odd_texts(model):
    texts = odd_texts(1500) + [text or "" for text in EDGE_TEXTS]
    assert encoded(model, texts) == model.library.encode(texts)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_heap_finishes_what_rounds_leave(model, monkeypatch, rounds):
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    texts = odd_texts(200) + [" " * 300 + "x" * 99, "é" * 50 + "abc" * 60]
    assert encoded(model, texts) == model.library.encode(texts)


def test_segments(model, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENT", 10)
    texts = odd_texts(200)
    assert encoded(model, texts) == model.library.encode(texts)


def expected(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    found = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        found.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")))
    return by_id(found)


def test_query_on_odd_documents(spark, tmp_path):
    folder = tables(spark, tmp_path / "t", documents=documents(spark, edge_rows(), clashing=True))
    assert by_id(catalog.sentencepiece(spark, folder).collect()) == expected(edge_rows())


def test_query_on_the_whole_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert by_id(catalog.sentencepiece(spark, SF_DIR).collect()) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert catalog.sentencepiece(spark, tables(spark, tmp_path / "t")).collect() == []
