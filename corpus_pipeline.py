"""A training corpus from raw documents: score, deduplicate, decontaminate, encode.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept and returns a DataFrame; all but the last return the columns of the
documents. `run` writes each stage's result as Parquet in the shared folder and
reads it back for the next one.

1. quality: documents that score under 0.5 go.
2. line_dedup: lines that many documents repeat stay in one of them; the text is
   what is left (it may be empty) and n_chars, if there, its length.
3. simhash: of each group of near duplicates the document with the smallest id stays.
4. decontamination: documents that contain a benchmark item go.
5. sentencepiece: doc_id, ids, n_tokens, the decoded text, and the other columns
   of the document in a struct.

NULL, empty and repeated rows, and columns of any other name, follow the rules
that the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm.common import stored, table
from clicktrail.llm.decontaminate import without_items
from clicktrail.llm.line_dedup import drop_repeated_lines
from clicktrail.llm.pieces import encode_pieces
from clicktrail.llm.quality import fit_quality, quality_score
from clicktrail.llm.simhash import one_of_each_group

LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(model) >= LEAST_QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(docs)
    made = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[made.get(name, F.col("rest")[name]).alias(name) for name in docs.columns])


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded", F.col("rest").alias("document")
    )


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# The classifier, the alignment and the merges have no SQL; tests compare the
# whole run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
