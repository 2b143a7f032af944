"""Dropping lines that many documents repeat.

A line's key is the line without ASCII white space at both ends, A-Z in lower
case. Keys of at least `min_chars` code points that occur in at least
`min_docs` documents lose all their lines except in the document with the
largest id that holds them.

How: the distinct (line hash, document) pairs are stored once and counted per
128-bit line hash. All distinct hashes are cut into shards of bounded size; of
each shard a minimal perfect hash is built, which leads to arrays of 32-bit
fingerprints, document counts and the largest document. The pairs then go to
the shard of their hash, where they probe those arrays, and the count decides;
no line text and no line table is joined. Since every hash that probes is in the
index, it meets its own entry; the fingerprint only shows foreign hashes. The few shards that very common lines make hot are
copied and their probes spread over the copies. Only hits come back: one list
of hashes per document, which meets the documents once, by id.

Rules: a NULL or empty text is one empty line. Rows with NULL id take no part:
they count for no line and keep all lines. Rows with the same id count once per
line, and each of them loses its lines by the same rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, byte_texts, others, stored, text_slices

SHARD_KEYS = 1 << 12  # keys of a shard, at most on average; its arrays take about 17 bytes a key
HOT_SHARDS = 64  # a shard with more than this fraction of the probes is copied
SPREAD = 512  # a copy answers about this fraction of the probes

ASCII_SPACE = b" \t\n\x0b\x0c\r"
LEVELS = 24
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INDEX = "sizes array<int>, bits binary, prints binary, counts binary, keepers binary, unplaced binary"
MOST_COUNTED = 2**32 - 1  # larger document counts stay at this


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key's 128-bit hash; None for a key that is too short."""
    key = line.strip(ASCII_SPACE)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _long_keys(text: bytes, min_chars: int) -> set[bytes]:
    return {key for line in text.split(b"\n") if (key := line_key(line, min_chars))}


def _halves(digests: list[bytes]) -> list[pa.Array]:
    pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)]


def line_hashes(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h1, h2), distinct: which document holds which long line."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column(1)):
                found = [_long_keys(t, min_chars) for t in byte_texts(batch.column(1), start, end)]
                ids = batch.column(0).slice(start, end - start).to_numpy(zero_copy_only=False)
                digests = [key for keys in found for key in keys]
                doc_ids = np.repeat(ids, [len(keys) for keys in found])
                yield batch_of([pa.array(doc_ids), *_halves(digests)], ["doc_id", "h1", "h2"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = named.where(F.col("doc_id").isNotNull()).mapInArrow(hashes, "doc_id long, h1 long, h2 long")
    return found.distinct()


# --- minimal perfect hash ---------------------------------------------------------------


def _mixed(hashes: np.ndarray, level: int) -> np.ndarray:
    x = (hashes ^ np.uint64(level * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)) * MULTIPLIER
    return x ^ (x >> np.uint64(29))


def _print(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """A 32-bit fingerprint, of other bits than the places."""
    return (_mixed(h1.view(np.uint64) + h2.view(np.uint64), LEVELS + 1) >> np.uint64(32)).astype("<u4")


def build_index(h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> dict:
    """Minimal perfect hash of distinct (h1, h2) with its arrays.

    Level by level, keys whose place no other key shares set that place's bit;
    the rest goes on to the next level. A key's index is the rank of its bit.
    Keys left after the last level (equal h1, so hardly ever) follow in a list.
    """
    h1, h2 = h1.astype(np.int64), h2.astype(np.int64)
    key = h1.view(np.uint64) ^ _mixed(h2.view(np.uint64), LEVELS)
    left, order, bits, sizes = np.arange(len(key)), [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = 2 * len(left)
        place = (_mixed(key[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        single = alone[place]
        order.append(left[single][np.argsort(place[single])])
        bits.append(alone)
        sizes.append(size)
        left = left[~single]
    order = np.concatenate([*order, left]).astype(np.int64) if len(key) else left
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return {
        "sizes": sizes,
        "bits": np.packbits(flat).tobytes(),
        "prints": _print(h1[order], h2[order]).tobytes(),
        "counts": np.minimum(counts[order], MOST_COUNTED).astype("<u4").tobytes(),
        "keepers": keepers[order].astype("<i8").tobytes(),
        "unplaced": np.stack([h1[left], h2[left]], axis=1).astype("<i8").tobytes(),
    }


class LineIndex:
    """The arrays of one shard, to be probed with many hashes at a time."""

    def __init__(self, sizes, bits, prints, counts, keepers, unplaced):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self.ranks = np.cumsum(self.bits) - 1
        self.prints = np.frombuffer(prints, "<u4")
        self.counts = np.frombuffer(counts, "<u4")
        self.keepers = np.frombuffer(keepers, "<i8")
        self.unplaced = np.frombuffer(unplaced, "<i8").reshape(-1, 2).tolist()

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 for one that the shard doesn't hold."""
        key = h1.view(np.uint64) ^ _mixed(h2.view(np.uint64), LEVELS)
        found = np.full(len(key), -1, np.int64)
        left, base = np.arange(len(key)), 0
        for level, size in enumerate(self.sizes):
            place = base + (_mixed(key[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[place]
            found[left[hit]] = self.ranks[place[hit]]
            left, base = left[~hit], base + size
        first = len(self.prints) - len(self.unplaced)
        for i, (one, two) in enumerate(self.unplaced, start=first):
            found[left[(h1[left] == one) & (h2[left] == two)]] = i
        held = np.flatnonzero(found >= 0)
        found[held[self.prints[found[held]] != _print(h1[held], h2[held])]] = -1
        return found


# --- build, probe, apply ----------------------------------------------------------------


def _shard(shards: int):
    return F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).cast("int")


def line_index(counted: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard of `counted` (h1, h2, n, keeper)."""

    def build(key, pdf):
        import pandas as pd

        arrays = build_index(*(pdf[c].to_numpy() for c in ("h1", "h2", "n", "keeper")))
        return pd.DataFrame([{"shard": key[0]} | arrays])

    sharded = counted.withColumn("shard", _shard(shards))
    return sharded.groupBy("shard").applyInPandas(build, f"shard int, {INDEX}")


def repeated_in(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, h1, h2): the line hashes that each document loses."""
    counted = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    total = lines.count()
    shards = max(1, -(-total // SHARD_KEYS))
    index = stored(line_index(counted, shards), "line-index")
    probes = lines.withColumn("shard", _shard(shards))

    # At most HOT_SHARDS shards can hold more than that fraction of the probes each.
    loads = probes.groupBy("shard").count().where(F.col("count") > total / HOT_SHARDS).collect()
    copies = F.lit(1)
    for load in loads:
        copies = F.when(F.col("shard") == load["shard"], -(-SPREAD * load["count"] // total)).otherwise(copies)

    no_arrays = [F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in INDEX.split(", "))]
    no_probe = [F.lit(None).cast("long").alias(name) for name in ("doc_id", "h1", "h2")]
    rows = index.select(
        "shard", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))).alias("copy"), F.lit(0).alias("kind"),
        *no_probe, *[f.split()[0] for f in INDEX.split(", ")],
    ).unionByName(
        probes.select(
            "shard", F.pmod(F.xxhash64("doc_id"), copies).cast("int").alias("copy"), F.lit(1).alias("kind"),
            "doc_id", "h1", "h2", *no_arrays,
        )
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, at = None, None
        for batch in batches:
            place = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            kinds = batch.column(2).to_numpy()
            starts = np.flatnonzero(np.r_[True, (np.diff(place, axis=0) != 0).any(axis=1) | (np.diff(kinds) != 0)])
            for start, end in zip(starts, [*starts[1:], len(kinds)], strict=True):
                if kinds[start] == 0:
                    index = LineIndex(*(batch.column(i)[int(start)].as_py() for i in range(6, 12)))
                    at = tuple(place[start])
                elif at == tuple(place[start]):
                    ids, h1, h2 = (batch.column(i).slice(start, end - start).to_numpy() for i in (3, 4, 5))
                    found = index.probe(h1, h2)
                    lost = (found >= 0) & (index.counts[found] >= min_docs) & (index.keepers[found] != ids)
                    yield batch_of([pa.array(x[lost]) for x in (ids, h1, h2)], ["doc_id", "h1", "h2"])

    ordered = rows.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return ordered.mapInArrow(probe, "doc_id long, h1 long, h2 long")


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, text (lines kept, joined by \\n), n_lines, n_dropped, rest.

    `rest` is a struct of the other columns.
    """
    lines = stored(line_hashes(docs, min_chars, id_col, text_col), "lines")
    lost = (
        repeated_in(lines, min_docs)
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("h1", "h2")).alias("lost"))
        .withColumnRenamed("doc_id", "lost_id")
    )
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), others(docs, id_col, text_col)
    )
    rest_type = rows.schema["rest"].dataType.simpleString()
    # Rows without id lose nothing and stay where they are.
    named = rows.where(F.col("doc_id").isNotNull())
    joined = named.join(lost, named["doc_id"] == lost["lost_id"], "left").select("doc_id", "text", "lost", "rest")
    nameless = rows.where(F.col("doc_id").isNull()).withColumn("lost", F.lit(None).cast(lost.schema["lost"].dataType))
    joined = joined.unionByName(nameless)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column(1)):
                texts, n_lines, n_dropped = byte_texts(batch.column(1), start, end), [], []
                for i, lost in enumerate(batch.column(2).slice(start, end - start)):
                    n_lines.append(texts[i].count(b"\n") + 1)
                    n_dropped.append(0)
                    if lost.is_valid:
                        halves = lost.values.flatten()
                        pairs = np.stack([half.to_numpy() for half in halves], axis=1).astype("<i8").tobytes()
                        gone = {pairs[k : k + 16] for k in range(0, len(pairs), 16)}
                        lines = texts[i].split(b"\n")
                        kept = [line for line in lines if line_key(line, min_chars) not in gone]
                        n_dropped[-1] = len(lines) - len(kept)
                        texts[i] = b"\n".join(kept)
                yield batch_of(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_dropped, pa.int64()),
                        batch.column(3).slice(start, end - start),
                    ],
                    ["doc_id", "text", "n_lines", "n_dropped", "rest"],
                )

    return joined.mapInArrow(apply, f"doc_id long, text string, n_lines long, n_dropped long, rest {rest_type}")
