"""Packing of documents into windows of tokens with lexically related neighbours.

How: texts are encoded once and the ids kept in a table. Counts over all
documents give each id's document frequency and the mean length. A document's
place among the shards follows two weighted minimal hashes of its distinct ids
(the chance that two documents share one is that of their common share of rare
ids), so related documents lie in the same shard; a range shuffle cuts the order
into tasks, and a task its rows into shards of about `SHARD_TOKENS` ids. A shard
has a BM25 inverted index of its own. A seed document is placed at the start of
a window, the index returns the unused documents of the shard by falling score
for all its ids, and they fill the window in this order. The document that
reaches beyond the window is cut there; its rest begins the next window and is
the next seed. Where no neighbour is left, the first unused document follows as
the next seed.

Windows run on from shard to shard, so a task leaves one unfinished window, which
is cut into sequences whose lengths are powers of two: nothing is padded. What a
task holds is a shard's ids and its postings, beside the longest document.

Rules: a NULL or empty text is the end id alone. Each row is a document, also if
its id or all of it is repeated. The sequences' numbers are unique and grow with
the order of the shards; they aren't gapless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, stored, text_slices
from clicktrail.llm.parts import SENTINEL, LibraryEncoder, kept_encoder
from clicktrail.llm.token_files import SYMBOLS, id_type

WINDOW = 4096
SHARD_TOKENS = 1 << 19
KNOWN_PARTS = 1_500_000
SLICE_ROWS = 4096
K1, B = 1.2, 0.75  # BM25: how fast repeats count less, how much the length counts
MIX = 0x9E3779B97F4A7C15  # an odd number that spreads ids over 64 bits

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder(LibraryEncoder):
    """Ids by a BPE of whole lower-case words, whose pre-tokens never hold white space."""

    # İ becomes two characters in lower case.
    not_plain = (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0")
    is_gap = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c" + SENTINEL))

    def cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = self.is_gap[data]
        turns = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        turns = turns if gap[0] else np.r_[0, turns]
        return turns[0::2], turns[1::2]

    def symbols(self, units: bytes) -> str:
        lower = units.decode().lower().encode()
        return SYMBOLS[np.frombuffer(lower, np.uint8)].tobytes().decode("utf-32-le")

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's end."""
        return self.encoded(texts, KNOWN_PARTS)


def encode_words(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids): the ids of each text and the end id, in bytes as `id_type` says."""
    kind = id_type(tokenizer, end_id)
    width = int(kind[-1])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(WordEncoder, tokenizer)
        for batch in batches:
            for start, end in text_slices(batch.column(1), SLICE_ROWS):
                found, ends = encoder.encode(byte_texts(batch.column(1), start, end))
                ids = np.insert(found, ends, end_id).astype(kind).tobytes()
                ends = width * (ends + np.arange(1, len(ends) + 1))
                bounds = zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)
                values = pa.array([ids[i:j] for i, j in bounds], pa.binary())
                yield batch_of([batch.column(0).slice(start, end - start), values], ["doc_id", "ids"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(encode, "doc_id long, ids binary")


def distinct_ids(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id, how often), in order, of all the id arrays."""
    sizes = np.array([len(ids) for ids in documents], np.int64)
    flat = np.concatenate(documents).astype(np.int64) if len(documents) else np.zeros(0, np.int64)
    keys = np.sort(np.repeat(np.arange(len(documents)), sizes) << 32 | flat)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    keys, counts = keys[first], np.diff(np.r_[first, len(keys)])
    return keys >> 32, keys & 0xFFFFFFFF, counts


def _documents(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(value, kind) for value in column.to_pylist()]


def id_statistics(encoded: DataFrame, kind: str) -> tuple[np.ndarray, int, int]:
    """The document frequency of each id, the number of documents and of all ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents, tokens = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for start, end in text_slices(batch.column(0), SLICE_ROWS):
                own = _documents(batch.column(0).slice(start, end - start), kind)
                found = np.bincount(distinct_ids(own)[1], minlength=len(total))
                found[: len(total)] += total
                total, documents, tokens = found, documents + len(own), tokens + sum(map(len, own))
        ids = np.flatnonzero(total)
        yield batch_of([pa.array(np.r_[ids, -1, -2]), pa.array(np.r_[total[ids], documents, tokens])], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n"))
    found = dict(map(tuple, counted.collect()))
    documents, tokens = found.pop(-1, 0), found.pop(-2, 0)
    frequencies = np.zeros(max(found, default=-1) + 1, np.int64)
    for number, n in found.items():
        frequencies[number] = n
    return frequencies, documents, tokens


def inverse_frequencies(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p((documents - frequencies + 0.5) / (frequencies + 0.5))


def shard_keys(documents: list[np.ndarray], idf: np.ndarray) -> list[np.ndarray]:
    """Two ids of each document, drawn by weighted minimal hashes."""
    document, number, _ = distinct_ids(documents)
    begin = np.flatnonzero(np.r_[True, document[1:] != document[:-1]])
    keys = []
    for turn in (1, 2):
        mixed = (np.arange(len(idf), dtype=np.uint64) + np.uint64(1)) * np.uint64(MIX) ^ np.uint64(turn * 0x1234567)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(MIX) >> np.uint64(11)
        wait = -np.log((mixed.astype(float) + 0.5) / 2.0**53) / np.maximum(idf, 1e-9) ** 2
        order = np.argsort(wait, kind="stable")
        rank = np.empty(len(idf), np.int64)
        rank[order] = np.arange(len(idf))
        keys.append(np.minimum.reduceat(rank[number], begin))
    return keys


class ShardIndex:
    """BM25 weights of a shard's ids, by id."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean_length: float):
        document, number, count = distinct_ids(documents)
        length = np.array([len(ids) for ids in documents])
        norm = K1 * (1 - B + B * length / mean_length)
        weight = idf[number] * count * (K1 + 1) / (count + norm[document])
        order = np.argsort(number, kind="stable")
        self.size = len(documents)
        self.documents, self.weights = document[order], weight[order]
        self.ids, self.starts = np.unique(number[order], return_index=True)
        self.stops = np.r_[self.starts[1:], len(number)]
        self.own_starts = np.searchsorted(document, np.arange(len(documents) + 1))
        self.own = number

    def distinct(self, document: int) -> np.ndarray:
        return self.own[self.own_starts[document] : self.own_starts[document + 1]]

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Of all documents for the distinct `ids`."""
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        at = at[self.ids[at] == ids]
        sizes = self.stops[at] - self.starts[at]
        places = np.arange(sizes.sum()) + np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        return np.bincount(self.documents[places], self.weights[places], self.size)

    def neighbours(self, ids: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share an id, by falling score, then their order."""
        found = np.where(unused, self.scores(ids), 0.0)
        order = np.argsort(-found, kind="stable")
        return order[: int((found > 0).sum())]


class Windows:
    """The windows of a task, as pieces of documents."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the unfinished window
        self.filled = 0

    def place(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Add a document behind what there is; the pieces of windows that it fills."""
        start = 0
        while start < len(ids):
            piece = ids[start : start + self.size - self.filled]
            self.open.append((doc_id, start, piece, len(ids)))
            start, self.filled = start + len(piece), self.filled + len(piece)
            if self.filled == self.size:
                yield from self._closed(self.open)
                self.open, self.filled = [], 0

    def _closed(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), ids.astype("<u4").tobytes(), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        """The unfinished window in sequences whose lengths are powers of two, the longest first."""
        while self.open:
            room = 1 << self.filled.bit_length() - 1
            self.filled -= room
            taken = []
            while room:
                doc_id, start, ids, total = self.open.pop(0)
                taken.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    self.open.insert(0, (doc_id, start + room, ids[room:], total))
                room -= len(taken[-1][2])
            yield from self._closed(taken)


def packed_shard(
    doc_ids: list[int | None], documents: list[np.ndarray], index: ShardIndex, windows: Windows, seed: np.ndarray
) -> Iterator[tuple]:
    """Place all documents of a shard; `seed` are the distinct ids of what the unfinished window ends with."""
    unused = np.ones(len(documents), bool)
    first = 0
    while True:
        near = index.neighbours(seed, unused) if windows.filled and len(seed) else np.zeros(0, np.int64)
        if not len(near):
            while first < len(documents) and not unused[first]:
                first += 1
            if first == len(documents):
                return
            near = np.array([first])
        for document in near.tolist():
            unused[document] = False
            sequence = windows.sequence
            yield from windows.place(doc_ids[document], documents[document])
            if windows.sequence != sequence:
                break
        seed = index.distinct(document)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    `ids` are little-endian unsigned 32-bit integers, `start` the piece's place
    in its document and `offset` that in its sequence. `tokenizer` is the path
    of a lower-case word BPE of the tokenizers library.
    """
    encoded = stored(encode_words(docs, tokenizer, end_id, id_col, text_col), "packing", "zstd")
    kind = id_type(tokenizer, end_id)
    frequencies, total, tokens = id_statistics(encoded, kind)
    idf, mean_length = inverse_frequencies(frequencies, total), tokens / max(total, 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column("ids"), SLICE_ROWS):
                part = batch.slice(start, end - start)
                keys = shard_keys(_documents(part.column("ids"), kind), idf)
                yield batch_of([*part.columns, *map(pa.array, keys)], ["doc_id", "ids", "row", "key", "next_key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window, TaskContext.get().partitionId() << 40)
        seed = np.zeros(0, np.int64)
        for doc_ids, documents in _shards(batches, kind):
            index = ShardIndex(documents, idf, mean_length)
            yield from _batches(packed_shard(doc_ids, documents, index, windows, seed))
            seed = np.unique(windows.open[-1][2]) if windows.open else seed[:0]
        yield from _batches(windows.finish())

    # The row's number tells apart equal rows, so that the ranges can split them.
    rows = encoded.withColumn("row", F.monotonically_increasing_id())
    routed = rows.mapInArrow(route, "doc_id long, ids binary, row long, key long, next_key long")
    order = ["key", "next_key", "doc_id", "row"]
    return routed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids").mapInArrow(pack, PIECES)


def _shards(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[list[int | None], list[np.ndarray]]]:
    doc_ids, documents, held = [], [], 0
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            doc_ids.append(doc_id)
            documents.append(np.frombuffer(ids.as_py(), kind))
            held += len(documents[-1])
            if held >= SHARD_TOKENS:
                yield doc_ids, documents
                doc_ids, documents, held = [], [], 0
    if documents:
        yield doc_ids, documents


def _batches(pieces: Iterator[tuple], most: int = 4096) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    rows: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return batch_of([pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)], names)

    for piece in pieces:
        rows.append(piece)
        if len(rows) == most:
            yield made()
            rows = []
    if rows:
        yield made()
