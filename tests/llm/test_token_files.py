"""Encoding, the code and the files against the tokenizers library and plain Python."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import AddedToken, Tokenizer

from clicktrail.llm import catalog, token_files
from tests.llm.helpers import EDGE_TEXTS, SF_DIR, by_id, documents, edge_rows, tables

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    def order(row):
        return (row[0] is not None, row[0] or 0, np.array(row[1], "<u2").tobytes())

    encoded = [(doc_id, library.encode(text or "", add_special_tokens=False).ids + [0]) for doc_id, text in rows]
    found, start = [], 0
    for doc_id, ids in sorted(encoded, key=order):
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return by_id(found)


@pytest.mark.parametrize("known", [0, 300_000])
def test_parts_give_the_ids_of_whole_texts(library, monkeypatch, known):
    monkeypatch.setattr(token_files, "KNOWN_PARTS", known)
    parts = [
        "a", "the", " ", "\n", "\n\n", "é", "日本", "😀", "12", " in", "'s", "'", "don't", "I'll ", "\x00", "\x01", "\x01 ", "\t", "%%%",
        " " * 5, "<|endoftext|>", "ÿ", "ſ", "×", "ª", " \n", ".", "!", "_", "\xa0", "​", "\x1c", "\x85",
    ]
    rng = random.Random(2)
    encoder = token_files.PartEncoder(PATH)
    for _ in range(3):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(500)]
        texts += ["".join(chr(rng.randint(0, 0x250)) for _ in range(50)) for _ in range(300)] + [t or "" for t in EDGE_TEXTS]
        ids, ends = encoder.encode([text.encode() for text in texts])
        found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_query_on_odd_documents(spark, tmp_path, library, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", block)
    monkeypatch.setattr(token_files, "STEP", 64)
    folder = tables(spark, tmp_path / "t", documents=documents(spark, edge_rows(), clashing=True))
    assert by_id(catalog.token_files(spark, folder).collect()) == expected(library, edge_rows())


def test_added_tokens_in_texts(spark, tmp_path):
    plain = Tokenizer.from_file(PATH)
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    end = "<|endoftext|>"
    texts = [
        f"a {end} b", end, end * 3, f"{end}\n\n{end} x", f"x  {end}  y", f"don{end}'t", f"<|end{end}oftext|>", "<|endoftext|",
        f"two\n {end}.{end}", f"{end} " + "word and " * 500 + end, "plain text behind it", None,
    ]
    rng = random.Random(5)
    texts += ["".join(rng.choices([end, " ", "\n", "ab", "'s", "é", "12", "<|", "\x01", "  "], k=30)) for _ in range(200)]
    rows = list(enumerate(texts))
    folder = tables(spark, tmp_path / "t", documents=documents(spark, rows))
    assert by_id(catalog.token_files(spark, folder).collect()) == expected(plain, rows)


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}, {"normalized": True}])
def test_added_tokens_of_other_kinds(tmp_path, flags):
    path = str(tmp_path / "t.json")
    changed = Tokenizer.from_file(PATH)
    changed.add_tokens([AddedToken("hello", **{"normalized": False, **flags}), AddedToken("hello w", normalized=False)])
    changed.save(path)
    plain = Tokenizer.from_file(path)
    rng = random.Random(6)
    parts = ["hello", " hello ", "hello w", "ot", "  ", "\n", "orld", ".", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=12)) for _ in range(300)]
    ids, ends = token_files.PartEncoder(path).encode([text.encode() for text in texts])
    found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert found == [plain.encode(text, add_special_tokens=False).ids for text in texts]


def test_query_on_the_whole_table(spark, library):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert by_id(catalog.token_files(spark, SF_DIR).collect()) == expected(library, rows)


def test_empty_table(spark, tmp_path):
    assert catalog.token_files(spark, tables(spark, tmp_path / "t")).collect() == []


def huffman_cost(counts):
    heap = sorted(counts)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("size", [1, 2, 3, 50, 700])
def test_code_is_optimal_and_complete(size):
    rng = np.random.default_rng(size)
    counts = rng.integers(1, 1000, size) ** 2
    lengths = token_files.code_lengths(counts, 40)
    if size > 1:
        assert (counts * lengths).sum() == huffman_cost(counts.tolist())
        assert (0.5**lengths).sum() == 1


def test_lengths_are_limited():
    counts = 2 ** np.arange(40)
    lengths = token_files.code_lengths(counts, 6)
    assert lengths.max() == 6 and (0.5**lengths).sum() <= 1
    with pytest.raises(ValueError, match="more than 5 bits"):
        token_files.code_lengths(counts, 5)


@pytest.mark.parametrize("size", [1, 2, 300])
def test_bits_and_checkpoints_round_trip(size):
    rng = np.random.default_rng(size)
    ids = np.sort(rng.choice(70_000, size, replace=False))
    lengths = token_files.code_lengths(rng.integers(1, 10**6, size), token_files.MAX_BITS)
    codes = token_files.canonical_codes(ids, lengths)
    blocks, wanted = [], []
    for n in (1, 63, 1024, 1025, 5000):
        at = rng.integers(0, size, n)
        bits, offsets = token_files.pack_bits(codes[at], lengths[at])
        plain = "".join(format(int(codes[i]), f"0{lengths[i]}b") for i in at.tolist())
        assert "".join(format(byte, "08b") for byte in bits)[: len(plain)] == plain
        blocks.append((bits, offsets[:: token_files.STEP].tolist(), n))
        wanted.append(ids[at].tolist())
    decoder = token_files.Decoder(ids, lengths)
    assert [found.tolist() for found in decoder.decode(blocks)] == wanted
    assert decoder.decode(blocks[3:4])[0].tolist() == wanted[3]
