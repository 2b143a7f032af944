"""Near-duplicates by SimHash fingerprints, found over an index of byte positions.

The fingerprint of a text is the bitwise majority of the XXH64 hashes of its
word shingles. Two fingerprints link when at most `max_bits` (4) bits differ;
a component is what links connect.

How: documents with the same fingerprint are one node, so that a group of
copies costs one row. A difference of 4 bits touches at most 4 of 8 bytes, so a
linked pair shares at least 4 bytes at their positions. A posting list of one
(position, byte) would hold a 256th of all rows, so lists are those of three
positions at once: 20 triples of positions are enough that any 4 shared
positions hold a whole triple. Within a posting list the shared positional
bytes of each pair are tallied, pairs with fewer than 4 are dropped, and the
rest is verified by the number of differing bits. A list gives back a spanning
star per linked group, not its pairs. A list longer than `BLOCK` is cut into
blocks by a hash, and each two blocks meet in a task of their own. Components
are joined across lists by star rounds on executors.

Rules: words are separated by ASCII white space, A-Z are lower-cased, repeated
shingles count each time; a text with fewer words than a shingle is one
shingle; a text without words (NULL, empty) has fingerprint zero, which links
like any other. Rows with NULL id get a fingerprint but no component. Rows with
the same id and different texts each link by their own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, stored, text_slices
from clicktrail.llm.components import smallest_reachable

BLOCK = 2048  # rows of a posting list that one task compares with each other
MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS
STEP = 1 << 16  # shingles that are hashed before their bits are added up


def fingerprint(text: bytes, width: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    hashed, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), STEP):
        spans = zip(starts[k : k + STEP], ends[k : k + STEP], strict=True)
        hashes = np.array([hashed(joined[i:j], 42) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed 64-bit number."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [fingerprint(t, width) for at in text_slices(texts) for t in byte_texts(texts, *at)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield batch_of([batch.column(0), signed], ["doc_id", "print"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(prints, "doc_id long, print long")


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of the 8 byte positions, one of them inside any 4 positions.

    The positions form three rings of parts; a triple lies within a part, or
    has two positions in one part and one in the next.
    """
    part = [k * 3 // 8 for k in range(8)]

    def wanted(triple: tuple[int, int, int]) -> bool:
        parts = [part[k] for k in triple]
        return any(parts.count(p) == 3 or (parts.count(p) == 2 and parts.count((p + 1) % 3) == 1) for p in range(3))

    return [triple for triple in combinations(range(8), 3) if wanted(triple)]


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether fingerprints share enough positional bytes and differ in few enough bits."""
    differing = np.ascontiguousarray(a ^ b)
    shared = (differing.view(np.uint8).reshape(*differing.shape, 8) == 0).sum(axis=-1)
    close = shared >= MIN_BYTES
    close[close] = np.bitwise_count(differing[close]) <= MAX_BITS
    return close


def _group_stars(prints: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) that span the linked groups of one posting list."""
    left, a, b = np.arange(len(prints)), [], []
    while len(left):
        group, edge, left = [left[:1]], left[:1], left[1:]
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            for k in range(0, len(edge), 64):
                near |= _linked(prints[edge[k : k + 64], None], prints[None, left]).any(axis=0)
            edge, left = left[near], left[~near]
            group.append(edge)
        members = docs[np.concatenate(group)]
        if len(members) > 1:
            a.append(members)
            b.append(np.full(len(members), members.min()))
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _list_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of posting lists that arrive in order: (key, i, j, print, doc) rows."""
    held = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in range(5)], axis=1)
        rows = rows if held is None else np.concatenate([held, rows])
        new = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        whole = new[-1] if len(new) else 0
        held = rows[whole:].copy()
        yield from _links_of(rows[:whole])
    if held is not None:
        yield from _links_of(held)


def _links_of(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links of whole posting lists: short ones all at a time, long ones one by one."""
    if not len(rows):
        return
    starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(rows)])
    prints, docs = rows[:, 3].copy().view(np.uint64), rows[:, 4]
    a, b = [], []
    short = sizes <= 32
    room = np.repeat(np.where(short, sizes, 0), sizes) - (np.arange(len(rows)) - np.repeat(starts, sizes)) - 1
    for step in range(1, 32):
        first = np.flatnonzero(room >= step)
        if not len(first):
            break
        first = first[_linked(prints[first], prints[first + step])]
        a.append(docs[first])
        b.append(docs[first + step])
    for start, size in zip(starts[~short], sizes[~short], strict=True):
        more = _group_stars(prints[start : start + size], docs[start : start + size])
        a.append(more[0])
        b.append(more[1])
    if a:
        yield batch_of([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between documents that connect all nodes (print, doc) within MAX_BITS bits.

    Every pair within reach is connected by links, though not always by its own.
    """

    def byte(k: int):
        return F.shiftrightunsigned("print", 8 * k).bitwiseAND(F.lit(255))

    def posting(number: int, triple: tuple[int, int, int]):
        i, j, k = triple
        value = F.shiftleft(byte(i), 16).bitwiseOR(F.shiftleft(byte(j), 8)).bitwiseOR(byte(k))
        return value.bitwiseOR(F.lit(number << 24))

    keys = F.array(*[posting(*at).cast("long") for at in enumerate(position_triples())])
    postings = nodes.select("print", "doc", F.explode(keys).alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    block = F.pmod(F.xxhash64("print"), F.col("blocks"))
    met = (
        postings.join(sizes.select("key", blocks.alias("blocks")), "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "print", "doc")
    )
    ordered = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(_list_links, "a long, b long")


def simhash_components(
    docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id of the row's component, its own included.
    """
    prints = stored(fingerprints(docs, width, id_col, text_col), "fingerprints")
    nodes = prints.where(F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("doc"))
    nodes = stored(nodes, "nodes")
    roots = smallest_reachable(fingerprint_links(nodes))
    named = nodes.join(roots, nodes["doc"] == roots["node"], "left").select(
        F.col("print").alias("of"), F.coalesce("root", "doc").alias("root")
    )
    joined = prints.join(named, prints["print"] == named["of"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("root"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), component.alias("component_id"))


def one_of_each_group(
    docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, one row an id.

    Of rows with the same id the one with the smallest text stays; rows with
    NULL id all stay.
    """
    found = simhash_components(docs, width, id_col, text_col)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.struct("*").alias("row"))
    # Rows of one id become one before they move; rows without id don't move at all.
    first = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.min_by("row", F.struct("text")).alias("row"))
    one = first.join(kept, first["id"] == kept["kept_id"], "left_semi").select("row.*")
    return one.unionByName(rows.where(F.col("id").isNull()).select("row.*"))
