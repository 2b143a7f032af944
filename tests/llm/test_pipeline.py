"""The pipeline, stage by stage, against plain versions of its operators."""

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from clicktrail.llm import quality
from clicktrail.llm.common import stored, table
from clicktrail.llm.samples import fold, labelled_sample
from tests.llm import test_decontaminate, test_line_dedup, test_simhash
from tests.llm.helpers import CLASHING, SMALL_DIR, by_id, documents, edge_rows, tables


def kept_lines(rows):
    """(doc_id, text) after the line stage, by the holders of each key."""
    holders, found = {}, []
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = test_line_dedup.ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= 20 and doc_id is not None:
                holders.setdefault(key, set()).add(doc_id)
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [test_line_dedup.ascii_lower(line.strip(" \t\n\x0b\x0c\r")) for line in lines]
        kept = [
            line for line, key in zip(lines, keys, strict=True)
            if len(holders.get(key, ())) < 3 or doc_id is None or doc_id == max(holders[key])
        ]
        found.append((doc_id, "\n".join(kept)))
    return found


def brute(spark, folder):
    """Rows of the whole pipeline, for tables with distinct ids."""
    docs = [tuple(row) for row in table(spark, folder, "documents").select("doc_id", "text").collect()]
    items = [tuple(row) for row in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    sample = labelled_sample(
        table(spark, folder, "documents"), table(spark, folder, "labels"), "quality", fold(F.col("doc_id"), 3) != 1
    )
    scores = quality.fit(*sample).scores([(text or "").encode() for _, text in docs])
    docs = [row for row, score in zip(docs, scores, strict=True) if score >= 0.5]
    docs = kept_lines(docs)
    groups = {row[0]: row[2] for row in test_simhash.brute(docs)}
    docs = [row for row in docs if groups[row[0]] == row[0]]
    words = {doc_id: test_decontaminate.decontaminate.words_of(text) for doc_id, text in docs}
    # Items without a common 3-gram can't reach half of their score here.
    def shares(doc_id, item):
        three = {tuple(item[k : k + 3]) for k in range(len(item) - 2)}
        return any(tuple(words[doc_id][k : k + 3]) in three for k in range(len(words[doc_id]) - 2))

    dirty = set()
    for row in docs:
        near = [item for item in items if shares(row[0], test_decontaminate.decontaminate.words_of(item[1]))]
        if near and test_decontaminate.brute([row], near):
            dirty.add(row[0])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    clean = [(doc_id, library.encode(text)) for doc_id, text in docs if doc_id not in dirty]
    return by_id((doc_id, ids, len(ids), library.decode(ids) if ids else "") for doc_id, ids in clean)


def test_whole_run(spark):
    found = corpus_pipeline.run(spark, SMALL_DIR)
    rows = by_id((r["doc_id"], list(r["ids"]), r["n_tokens"], r["decoded"]) for r in found.collect())
    assert rows == brute(spark, SMALL_DIR)
    assert 0 < len(rows) < table(spark, SMALL_DIR, "documents").count()


def test_stages_keep_the_columns(spark):
    docs = table(spark, SMALL_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SMALL_DIR), name)
        assert docs.schema.simpleString() == before.schema.simpleString()
        assert docs.where(F.col("n_chars") != F.length("text")).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents(spark, tmp_path, empty):
    made = {} if empty else {"documents": documents(spark, edge_rows(), clashing=True)}
    folder = tables(spark, tmp_path / "t", **made)
    rows = corpus_pipeline.run(spark, folder).collect()
    # Without labels nothing is rejected; all texts without words are near duplicates.
    ids = sorted(str(row["doc_id"]) for row in rows)
    assert ids == ([] if empty else sorted(["0", *map(str, range(4, 12)), "None", "None"]))
    if not empty:
        assert set(rows[0]["document"].asDict()) == {"lang", "source", "n_chars", *CLASHING}
