"""Exact top-k search by integer inner product.

How: vectors are dealt evenly into tiles, a row of ids and a matrix each:
shards of all vectors and tiles of the queries. Each pair of a query tile and a
shard is one matrix product; per query the pair's k best stay (scores first,
then ids), and the lists of a query are merged in a tree, `FAN_IN` shards at a
time, so no task ever holds all lists of a query. Work is queries times
vectors, as an exact search needs; rows between steps are tiles and lists of k.

Components become floor(256 * x) of the double x. Products are taken in doubles
where every sum stays below 2^53, which is exact, and in Python's integers
where it doesn't; scores beyond 64 bits become the nearest 64-bit number and tie.

Rules: vectors that are NULL, or hold a NULL or non-finite component, take no
part, nor do rows with NULL id. Vectors of unequal length never meet. Ties go
to the smaller id; an id that several rows hold takes part as often. A query
never meets rows with its own id. Without queries or other vectors the result
is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of, settled

SHARD_ROWS = 2048
QUERY_ROWS = 512
FAN_IN = 16
EXACT = 2.0**53
LARGEST = 2**63 - 1

TILE = "tile long, first long, width int, ids binary, matrix binary, largest double"
LISTS = "query_id long, occurrence long, part long, found array<struct<loss:long,vec_id:long>>"
HITS = pa.list_(pa.struct([("loss", pa.int64()), ("vec_id", pa.int64())]))


def _usable(values: Column) -> Column:
    def plain(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return values.isNotNull() & F.forall(values, plain)


def _pack(rows: int) -> Callable:
    """Packs the (vec_id, values) rows of a partition into tiles, each of one width.

    Partitions hold about `rows` vectors and so make one tile a width. `first`
    is the number of rows that the partition's tiles before this one hold.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        number, first = TaskContext.get().partitionId(), 0

        def tile(width: int) -> pa.RecordBatch:
            nonlocal first
            ids, matrix = (np.concatenate(x) for x in zip(*held.pop(width), strict=True))
            largest = float(np.abs(matrix).max()) if matrix.size else 0.0
            packed = matrix.astype("<i4" if largest < 2**31 else "<f8").tobytes()
            row = [number, first, width, ids.astype("<i8").tobytes(), packed, largest]
            first += len(ids)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.float64()]
            names = ["tile", "first", "width", "ids", "matrix", "largest"]
            return batch_of([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            flat = lists.flatten().to_numpy()
            widths = lists.value_lengths().to_numpy().astype(np.int64)
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                mine = np.flatnonzero(widths == width)
                at = (starts[mine][:, None] + np.arange(width)).reshape(len(mine), width)
                held.setdefault(width, []).append((ids[mine], np.floor(256 * flat[at])))
                if sum(len(x) for x, _ in held[width]) >= 2 * rows:
                    yield tile(width)
        for width in list(held):
            yield tile(width)

    return pack


def _tiles(vectors: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The tiles of (vec_id, values), settled, and the number of their numbers."""
    parts = max(1, -(-vectors.count() // rows))
    return settled(vectors.repartition(parts).mapInArrow(_pack(rows), TILE)), parts


def _matrix(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = "<f8" if len(data) == 8 * rows * width and rows * width else "<i4"
    return np.frombuffer(data, kind).astype(np.float64).reshape(rows, width)


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[dict]:
    """The k candidates that come first, without the query's own id."""
    rest = np.flatnonzero(ids != own)
    if len(rest) > k and scores.dtype != object:
        part = scores[rest]
        bound = np.partition(part, len(part) - k)[len(part) - k]
        above, ties = rest[part > bound], rest[part == bound]
        need = k - len(above)
        rest = np.concatenate([above, ties[np.argpartition(ids[ties], need - 1)[:need]]])
    hits = sorted((-int(scores[i]), int(ids[i])) for i in rest.tolist())[:k]
    return [{"loss": min(max(loss, -LARGEST), LARGEST), "vec_id": i} for loss, i in hits]


def _meet(k: int) -> Callable:
    """The k best of each query in each (query tile, shard) pair."""

    def whole(matrix: np.ndarray) -> np.ndarray:
        return np.array([int(x) for x in matrix.ravel()], object).reshape(matrix.shape)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for i in range(len(batch)) for row in batch.slice(i, 1).to_pylist()):
            width = row["width"]
            q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
            queries, matrix = _matrix(row["q_matrix"], len(q_ids), width), _matrix(row["matrix"], len(ids), width)
            if row["largest"] * row["q_largest"] * max(width, 1) < EXACT:
                scores = queries @ matrix.T
            else:
                scores = whole(queries) @ whole(matrix).T
            found = [_best(scores[j], ids, own, k) for j, own in enumerate(q_ids.tolist())]
            occurrence = (row["q_tile"] << 32) + row["q_first"] + np.arange(len(q_ids))
            part = np.full(len(q_ids), row["tile"])
            columns = [pa.array(q_ids), pa.array(occurrence), pa.array(part), pa.array(found, HITS)]
            yield batch_of(columns, ["query_id", "occurrence", "part", "found"])

    return meet


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row that `is_query` names."""
    values = F.col(vector_col).cast("array<double>")
    usable = vectors.where(F.col(id_col).isNotNull() & _usable(values))
    columns = [F.col(id_col).cast("long").alias("vec_id"), values.alias("values")]
    shards, n_shards = _tiles(usable.select(*columns), SHARD_ROWS)
    queries, n_queries = _tiles(usable.where(is_query).select(*columns), QUERY_ROWS)

    # Tiles are numbered 0..n-1, so the grid of all pairs is an equi-join on both numbers.
    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    named = queries.select([F.col(c).alias("q_tile" if c == "tile" else f"q_{c}") for c in queries.columns])
    grid = shards.withColumn("q_tile", every(n_queries)).join(
        named.withColumn("tile", every(n_shards)), ["tile", "q_tile"]
    )
    lists = grid.where(F.col("width") == F.col("q_width")).mapInArrow(_meet(k), LISTS)

    while True:
        n_shards = -(-n_shards // FAN_IN)
        lists = (
            lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
            .groupBy("query_id", "occurrence", "part")
            .agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
        )
        if n_shards <= 1:
            break
    placed = lists.select("query_id", F.posexplode("found").alias("place", "hit"))
    return placed.select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.loss")).alias("score"),
    )
