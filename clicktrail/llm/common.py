"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.session import ensure_checkpoint_dir

# A slice of an Arrow batch that is turned into Python objects at one time.
SLICE_ROWS = 256
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """`df` written as Parquet in the shared folder and read back: lineage ends here."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """`df` after a reliable checkpoint, for tables that are small beside the input."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def others(df: DataFrame, *taken: str) -> Column:
    """All columns but `taken` in one struct named `rest`, so that no name can clash."""
    names = [name for name in df.columns if name not in taken]
    return F.struct(*[F.col(f"`{name}`") for name in names] or [F.lit(None).alias("none")]).alias("rest")


def text_slices(texts: pa.Array, rows: int = SLICE_ROWS, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges with at most `rows` rows and, beyond one row, `most` bytes."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
    start = size = 0
    for row, more in enumerate(sizes):
        if row > start and (row - start >= rows or size + more > most):
            yield start, row
            start, size = row, 0
        size += more
    if start < len(sizes):
        yield start, len(sizes)


def byte_texts(texts: pa.Array, start: int, end: int) -> list[bytes]:
    """Rows start..end of a string column as UTF-8 bytes, NULL as empty."""
    part = texts.slice(start, end - start).cast(pa.binary())
    return [value or b"" for value in part.to_pylist()]


class Numbering(dict):
    """Numbers keys from 0 as they are first looked up."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def batch_of(columns: Iterable[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names)
