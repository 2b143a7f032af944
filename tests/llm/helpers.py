"""Small tables for the tests of this folder."""

from __future__ import annotations

import os
import random
import re
import string

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as columns of the input.
CLASHING = ["h1", "rest", "score", "file", "ids", "print", "lost", "row", "id", "kept_id", "n_lines"]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_DIR = "/root/testdata/sf0.001"


def documents(spark, rows, clashing=False):
    """(doc_id, text) rows as a documents table, with columns of clashing names if wanted."""
    full = [(i, text, "en", "s", None if text is None else len(text)) for i, text in rows]
    schema = DOCS
    if clashing:
        full = [(*row, *(f"x{k}" for k in range(len(CLASHING)))) for row in full]
        schema += "".join(f", {name} string" for name in CLASHING)
    return spark.createDataFrame(full, schema)


def tables(spark, folder, **made):
    """Write DataFrames as tables of a folder, the other tables empty."""
    empty = {
        "documents": DOCS,
        "labels": "doc_id long, quality int, toxic int",
        "benchmark": "item_id long, text string",
        "embeddings": "vec_id long, embedding array<float>, label int",
        "pages": "page_id long, url string, html string",
    }
    for name, schema in empty.items():
        made.get(name, spark.createDataFrame([], schema)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


EDGE_TEXTS = [
    None,
    "",
    " \t\n\x0b ",
    "\n\n\n",
    "one",
    "One two THREE four five",
    "Mit License\nsecond line of some length here\n\nend.",
    "éèê ünï日本語 😀 \x00 control \x1c sep",
    "word " * 3000,
    "x" * 20000,
    " " * 500 + "y",
    "▁▁ under ▁ score <s> </s> <0x0A> <|endoftext|>",
]


def edge_rows(repeat=True):
    """Documents with every odd text; a NULL id, and repeated rows and ids if wanted."""
    rows = list(enumerate(EDGE_TEXTS))
    if repeat:
        rows += [(None, "a row without id"), (None, None), (5, EDGE_TEXTS[5]), (5, "another text of id five")]
    return rows


def random_texts(seed, count, words=60, vocabulary=300):
    rng = random.Random(seed)
    pool = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8))) for _ in range(vocabulary)]
    return [" ".join(rng.choices(pool, k=rng.randint(5, words))) for _ in range(count)]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def by_id(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple((x is not None, str(x)) for x in row))
