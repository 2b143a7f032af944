"""Encoding against the library, windows against the texts' ids, and neighbours against plain BM25."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clicktrail.llm import catalog, packing
from tests.llm.helpers import EDGE_TEXTS, SF_DIR, documents, edge_rows, random_texts, tables

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("known", [0, 300_000])
def test_parts_give_the_ids_of_whole_texts(library, monkeypatch, known):
    monkeypatch.setattr(packing, "KNOWN_PARTS", known)
    parts = [
        "a", "The", " ", "\n", "é", "É", "日本", "😀", "12", "in", "'s", "'", "don't", "I'LL", "\x00", "\t", "%%%", "<|endoftext|>",
        "ÿ", "Ÿ", "ſ", "×", "÷", "İ", "ı", "ŉ", "ª", ".", "!", "_", "\xa0", "​", "\x1c", "\x85", "é", "́", "ǅ", "ﬁ", "한", " ",
    ]
    rng = random.Random(2)
    encoder = packing.WordEncoder(PATH)
    for _ in range(3):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(500)]
        texts += ["".join(chr(rng.randint(0, 0x250)) for _ in range(50)) for _ in range(300)] + [t or "" for t in EDGE_TEXTS]
        ids, ends = encoder.encode([text.encode() for text in texts])
        found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]


def check_pieces(pieces, library, rows, window):
    """Every id lies in one piece, sequences are whole and nothing is padded."""
    whole = Counter()
    texts = {}
    for doc_id, text in rows:
        ids = ids_of(library, text)
        whole[doc_id, tuple(ids)] += 1
        texts.setdefault(doc_id, []).append(ids)
    sequences = {}
    for piece in pieces:
        sequences.setdefault(piece["sequence_id"], []).append(piece)
    for found in sequences.values():
        found.sort(key=lambda piece: piece["offset"])
        assert [piece["offset"] for piece in found] == [sum(p["length"] for p in found[:n]) for n in range(len(found))]
        total = sum(piece["length"] for piece in found)
        assert total <= window and (total == window or total & (total - 1) == 0)
        assert all(piece["length"] > 0 for piece in found)
    # Repeated ids are told apart by the length and the sums of what the pieces hold.
    covered = Counter()
    for piece in pieces:
        start, end = piece["start"], piece["start"] + piece["length"]
        sums = [
            ids for ids in texts[piece["doc_id"]]
            if len(ids) == piece["doc_tokens"]
            and zlib.crc32(np.array(ids[start:end], "<u4").tobytes()) == piece["ids_crc32"]
        ]
        assert sums, piece
        for at in range(start, end):
            covered[piece["doc_id"], piece["doc_tokens"], at] += 1
    expected = Counter()
    for (doc_id, ids), n in whole.items():
        for at in range(len(ids)):
            expected[doc_id, len(ids), at] += n
    assert covered == expected
    return sequences


def test_query_on_odd_documents(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 900)
    rows = edge_rows() + [(100 + n, text) for n, text in enumerate(random_texts(3, 60))]
    rows += [(700, "the same copy " * 20)] * 40 + [(800 + n, "another copy of it " * 30) for n in range(40)]
    folder = tables(spark, tmp_path / "t", documents=documents(spark, rows, clashing=True))
    pieces = catalog.packing(spark, folder).collect()
    check_pieces(pieces, library, rows, packing.WINDOW)
    assert set(pieces[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_query_on_the_whole_table(spark, library):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(catalog.packing(spark, SF_DIR).collect(), library, rows, packing.WINDOW)


def test_empty_table(spark, tmp_path):
    assert catalog.packing(spark, tables(spark, tmp_path / "t")).collect() == []


def plain_scores(documents, query, frequencies, total, mean):
    found = []
    for ids in documents:
        counts = Counter(ids)
        score = 0.0
        for term in set(query):
            if counts[term]:
                idf = math.log(1 + (total - frequencies[term] + 0.5) / (frequencies[term] + 0.5))
                norm = packing.K1 * (1 - packing.B + packing.B * len(ids) / mean)
                score += idf * counts[term] * (packing.K1 + 1) / (counts[term] + norm)
        found.append(score)
    return found


def test_index_is_bm25():
    rng = random.Random(4)
    documents = [[rng.randint(0, 60) ** 2 // 40 for _ in range(rng.randint(1, 50))] for _ in range(40)]
    frequencies = Counter(term for ids in documents for term in set(ids))
    mean = sum(map(len, documents)) / len(documents)
    arrays = [np.array(ids, "<u2") for ids in documents]
    counts = np.array([frequencies[n] for n in range(200)])
    index = packing.ShardIndex(arrays, packing.inverse_frequencies(counts, 40), mean)
    for query in documents[:10]:
        expected = plain_scores(documents, query, frequencies, 40, mean)
        assert index.scores(np.unique(query)) == pytest.approx(expected)
        unused = np.array([rng.random() < 0.5 for _ in documents])
        near = index.neighbours(np.unique(query), unused).tolist()
        assert set(near) == {n for n, score in enumerate(expected) if score > 0 and unused[n]}
        assert [expected[n] for n in near] == pytest.approx(sorted((expected[n] for n in near), reverse=True))


def test_neighbours_fill_the_seeds_window():
    """Three topics in turn: each window holds one topic, and a document that is cut goes on in the next."""
    documents = [np.array([1000 * (n % 3) + 7 * k for k in range(30)], "<u2") for n in range(30)]
    idf = packing.inverse_frequencies(np.full(4000, 10), 30)
    windows = packing.Windows(128, 5)
    index = packing.ShardIndex(documents, idf, 30.0)
    pieces = list(packing.packed_shard(list(range(30)), documents, index, windows, np.zeros(0, np.int64)))
    pieces += list(windows.finish())
    topics = {}
    for doc_id, _, length, _, total, sequence, _ in pieces:
        topics.setdefault(sequence, Counter())[doc_id % 3] += length
        assert total == 30
    assert min(topics) == 5 and sum(sum(found.values()) for found in topics.values()) == 900
    assert all(len(found) == 1 for sequence, found in topics.items() if sequence in (5, 6))
    assert sum(len(found) > 1 for found in topics.values()) <= 2
    last = {}
    for doc_id, start, length, _, _, sequence, _ in pieces:
        if start:
            assert last[doc_id] in (sequence, sequence - 1)
        last[doc_id] = sequence


@pytest.mark.parametrize("filled", [1, 2, 3, 100, 127])
def test_last_window_is_cut_into_powers_of_two(filled):
    windows = packing.Windows(128, 0)
    for n in range(filled):
        assert list(windows.place(n, np.array([n], "<u2"))) == []
    pieces = list(windows.finish())
    sizes = Counter(piece[5] for piece in pieces)
    assert list(sizes.values()) == [1 << b for b in reversed(range(8)) if filled >> b & 1]
    assert [piece[0] for piece in pieces] == list(range(filled))


def test_related_documents_share_a_shard_key():
    rng = random.Random(9)
    base = rng.sample(range(5000), 200)
    near = [np.array(base[:190] + rng.sample(range(5000, 9000), 10), "<u2") for _ in range(30)]
    far = [np.array(rng.sample(range(9000, 40000), 200), "<u2") for _ in range(30)]
    keys = packing.shard_keys(near + far, np.full(40000, 5.0))[0]
    assert Counter(keys[:30].tolist()).most_common(1)[0][1] >= 20
    assert len(set(keys[30:].tolist())) >= 25
