"""Token ids in Huffman-coded files of independent blocks.

How: texts are encoded once and the ids kept in a table. From the global counts
of ids a canonical Huffman code is made whose codes are at most `MAX_BITS` long
(package-merge; the counts are one row per id of the vocabulary, so the driver
can hold them). Documents are put in ascending order of their ids by a range
shuffle and packed into blocks of whole documents; a block has its documents'
ids and sizes, its bits, and the bit offset of every `STEP`th token. Nothing
but the code is shared between blocks. A reader decodes any block alone: all
its checkpoints step forward together, each looking up `MAX_BITS` bits in one
table of symbols and lengths.

Files: a folder with `header` (id, bits: the code's lengths, which give the
whole code) and `blocks` (file, block, first, ...), both written as Parquet, so
that Spark commits them and any store can hold them.

Rules: a NULL or empty text is the end id alone. Documents with NULL id come
first; rows with the same id are ordered by their ids' bytes. A string of an added
token, special or not, is that token's id wherever the library finds it in a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, stored, text_slices
from clicktrail.llm.parts import SENTINEL, LibraryEncoder, kept_encoder

MAX_BITS = 18
BLOCK_TOKENS = 1 << 16  # a block closes with the document that reaches this
STEP = 1024  # tokens from one checkpoint to the next
DECODED_BLOCKS = 64  # blocks that are decoded together
SLICE_ROWS = 4096

KNOWN_PARTS = 1_500_000  # distinct parts that a task keeps the ids of

# A byte-level BPE writes printable bytes as themselves, the others as characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SYMBOLS = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
SYMBOLS = np.array([BYTE_SYMBOLS.get(b, b) for b in range(256)], "<u4")

BLOCK_SCHEMA = (
    "file int, block int, first long, n_tokens long, doc_ids array<long>, doc_sizes array<long>, "
    "checkpoints array<long>, bits binary"
)


# --- encoding of texts ------------------------------------------------------------------


def id_type(tokenizer: str, end_id: int = 0) -> str:
    """Numpy's name of the narrowest little-endian type that holds all ids."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab().values(), default=0) < 1 << 16 > end_id else "<u4"


class PartEncoder(LibraryEncoder):
    """Ids by a byte-level BPE of the tokenizers library.

    Before a space or line feed that follows a visible ASCII character or a
    letter from À to ɏ no byte-level pre-token goes on, so texts may be cut
    there without changing their ids. Strings of added tokens are cut out first,
    as the library does it. If added tokens take spaces, stand for whole words
    only or match normalised text, a text with such a string is one part.
    """

    lead_space = True

    def __init__(self, tokenizer: str):
        super().__init__(tokenizer)
        tokens = list(self.library.get_added_tokens_decoder().values())
        strings = sorted(self.added, key=len, reverse=True)
        self.added_at = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        self.cut_added = not any(
            token.lstrip or token.rstrip or token.single_word or (token.normalized and self.library.normalizer is not None)
            for token in tokens
        ) and len({token.normalized for token in tokens}) < 2

    def cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero((data == 32) | (data == 10))
        at = at[at > 0]
        before, lead = data[at - 1], data[np.maximum(at - 2, 0)]
        # The characters from À to ɏ are two bytes, of which the first is 0xC3 to 0xC9.
        usual = ((before >= 33) & (before <= 126)) | ((before >= 128) & (before < 192) & (lead >= 0xC3) & (lead <= 0xC9))
        cuts = np.sort(np.concatenate([at[usual], starts[ends > starts]]), kind="stable")
        if self.added_at is not None:
            spans = np.array([found.span() for found in self.added_at.finditer(data)], np.int64).reshape(-1, 2)
            if len(spans):
                if not self.cut_added:
                    text = np.unique(np.searchsorted(starts, spans[:, 0], side="right") - 1)
                    spans = np.stack([starts[text], ends[text]], axis=1)
                # No cuts within the spans, and one at either end, if the text goes on there.
                span = np.searchsorted(spans[:, 0], cuts, side="right") - 1
                cuts = np.unique(np.concatenate([cuts[(span < 0) | (cuts >= spans[span, 1])], spans.ravel()]))
                cuts = cuts[data[cuts] != SENTINEL[0]]
        text = np.searchsorted(starts, cuts, side="right") - 1
        return cuts, np.minimum(np.r_[cuts[1:], len(data)], ends[text])

    def whole(self, part: bytes) -> bool:
        return part in self.added

    def symbols(self, units: bytes) -> str:
        return SYMBOLS[np.frombuffer(units, np.uint8)].tobytes().decode("utf-32-le")

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's end."""
        return self.encoded(texts, KNOWN_PARTS)


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, ids): the ids of each text and the end id, in bytes as `id_type` says.

    `tokenizer` is the path of a byte-level BPE of the tokenizers library.
    """
    kind = id_type(tokenizer, end_id)
    width = int(kind[-1])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(PartEncoder, tokenizer)
        for batch in batches:
            for start, end in text_slices(batch.column(1), SLICE_ROWS):
                found, ends = encoder.encode(byte_texts(batch.column(1), start, end))
                ids = np.insert(found, ends, end_id).astype(kind).tobytes()
                ends = width * (ends + np.arange(1, len(ends) + 1))
                bounds = zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)
                values = pa.array([ids[i:j] for i, j in bounds], pa.binary())
                yield batch_of([batch.column(0).slice(start, end - start), values], ["doc_id", "ids"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(encode, "doc_id long, ids binary")


def id_counts(encoded: DataFrame, kind: str) -> DataFrame:
    """(id, n): how often each id occurs, added up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield batch_of([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(count, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


# --- the code ---------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Lengths of an optimal prefix code with codes of at most `max_bits` (package-merge)."""
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        by_weight = np.argsort(weights, kind="stable")
        levels.append(by_weight < n)
        weights = weights[by_weight]
        weights = weights[: len(weights) // 2 * 2]
        packages = weights[0::2] + weights[1::2]
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        alone = int(is_leaf[:taken].sum())
        lengths[:alone] += 1
        taken = 2 * (taken - alone)
    found = np.empty(n, np.int64)
    found[order] = lengths
    return found


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Code of each id: codes count up in the order of (length, id)."""
    order = np.lexsort((ids, lengths))
    codes, code, before = np.zeros(len(ids), np.uint64), 0, 0
    for i in order.tolist():
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack_bits(codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after the other, first bit first, and the offset of each."""
    stops = np.cumsum(lengths)
    offsets = stops - lengths
    word, shift = offsets >> 6, (offsets & 63).astype(np.uint64)
    aligned = codes << (64 - lengths).astype(np.uint64)
    begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words = np.zeros(int(stops[-1] >> 6) + 2, np.uint64)
    words[word[begin]] = np.bitwise_or.reduceat(aligned >> shift, begin)
    over = np.flatnonzero((offsets & 63) + lengths > 64)
    words[word[over] + 1] |= aligned[over] << (np.uint64(64) - shift[over])
    return words.astype(">u8").tobytes()[: int(stops[-1] + 7) // 8], offsets


class Decoder:
    """Decodes blocks with one table lookup per token."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        self.symbols = np.zeros(1 << max_bits, np.uint32)
        self.lengths = np.zeros(1 << max_bits, np.int64)
        at = 0
        for i in np.lexsort((ids, lengths)).tolist():
            width = 1 << (max_bits - int(lengths[i]))
            self.symbols[at : at + width] = ids[i]
            self.lengths[at : at + width] = lengths[i]
            at += width

    def decode(self, blocks: list[tuple[bytes, list[int], int]]) -> list[np.ndarray]:
        """Ids of each (bits, checkpoints, n_tokens) block."""
        data = b"".join(bits for bits, _, _ in blocks) + b"\0" * 8
        raw = np.frombuffer(data, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        base = 8 * np.cumsum([0, *(len(bits) for bits, _, _ in blocks[:-1])])
        at = np.concatenate([b + np.array(points, np.int64) for b, (_, points, _) in zip(base, blocks, strict=True)])
        lanes = [np.minimum(STEP, n - STEP * np.arange(len(points))) for _, points, n in blocks]
        size = np.concatenate(lanes)
        found = np.zeros((STEP, len(at)), np.uint32)
        last, mask = len(window) - 1, np.uint32((1 << self.max_bits) - 1)
        for step in range(int(size.max(initial=0))):
            bits = window[np.minimum(at >> 3, last)] >> (32 - self.max_bits - (at & 7)).astype(np.uint32) & mask
            found[step] = self.symbols[bits]
            at += self.lengths[bits]
        flat = found.T[np.arange(STEP) < size[:, None]]
        return np.split(flat, np.cumsum([n for _, _, n in blocks])[:-1])


# --- files ------------------------------------------------------------------------------


def write_ids(encoded: DataFrame, path: str, kind: str, max_bits: int = MAX_BITS) -> None:
    """Write the (doc_id, ids) rows to the folder `path` in ascending order of doc_id.

    `kind` is Numpy's name of the ids' type, such as `id_type` gives.
    """
    spark = encoded.sparkSession
    counts = np.array([tuple(row) for row in id_counts(encoded, kind).orderBy("id").collect()], np.int64).reshape(-1, 2)
    ids, lengths = counts[:, 0], code_lengths(counts[:, 1], max_bits)
    header = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), "id long, bits long")
    header.coalesce(1).write.parquet(f"{path}/header")
    codes = canonical_codes(ids, lengths)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.list_(pa.int64()), pa.binary()]
        names = [field.split()[0] for field in BLOCK_SCHEMA.split(", ")]
        code_of, length_of = np.zeros(int(ids.max(initial=-1)) + 1, np.uint64), np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
        code_of[ids], length_of[ids] = codes, lengths
        number, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, held = [], [], 0

        def packed() -> pa.RecordBatch:
            tokens = np.concatenate(parts)
            bits, offsets = pack_bits(code_of[tokens], length_of[tokens])
            sizes = [len(part) for part in parts]
            row = [number, block, first, held, doc_ids, sizes, offsets[::STEP].tolist(), bits]
            return batch_of([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids.append(doc_id)
                parts.append(np.frombuffer(value.as_py(), kind))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield packed()
                    block, first = block + 1, first + held
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield packed()

    order = [F.col("doc_id").asc_nulls_first(), F.col("ids")]
    ranged = encoded.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
    ranged.sortWithinPartitions(*order).mapInArrow(pack, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's place among all ids, and its ids.

    `ids` are little-endian unsigned 32-bit integers.
    """
    header = np.array([tuple(row) for row in spark.read.parquet(f"{path}/header").collect()], np.int64).reshape(-1, 2)
    ids, lengths = header[:, 0], header[:, 1]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ids, lengths, max_bits)
        for batch in batches:
            for at in range(0, len(batch), DECODED_BLOCKS):
                rows = batch.slice(at, DECODED_BLOCKS).to_pylist()
                decoded = decoder.decode([(r["bits"], r["checkpoints"], r["n_tokens"]) for r in rows])
                for row, tokens in zip(rows, decoded, strict=True):
                    sizes = np.array(row["doc_sizes"], np.int64)
                    ends = np.cumsum(sizes)
                    data = tokens.astype("<u4").tobytes()
                    bounds = zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist(), strict=True)
                    columns = [
                        pa.array(np.full(len(sizes), row["file"], np.int32)),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + ends - sizes),
                        pa.array(sizes),
                        pa.array([data[i:j] for i, j in bounds], pa.binary()),
                    ]
                    yield batch_of(columns, ["file", "doc_id", "first", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # One row per file: its number of ids, added up over the files before it.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    starts = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    docs = blocks.mapInArrow(decode, "file int, doc_id long, first long, n_tokens long, ids binary")
    # There are as many files as the writer's shuffle had partitions, so `starts` is small.
    return docs.join(F.broadcast(starts), "file").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def write_documents(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode texts and write their ids; the ids are kept, since counting and writing both read them."""
    encoded = stored(encode_ids(docs, tokenizer, end_id, id_col, text_col), "ids", "zstd")
    write_ids(encoded, path, id_type(tokenizer, end_id))
