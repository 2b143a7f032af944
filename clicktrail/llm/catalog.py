"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm.common import shared_path, table
from clicktrail.llm.decontaminate import contaminated
from clicktrail.llm.licenses import licence_scan
from clicktrail.llm.line_dedup import drop_repeated_lines
from clicktrail.llm.packing import pack_documents
from clicktrail.llm.pieces import encode_pieces
from clicktrail.llm.quality import fit_quality, quality_score
from clicktrail.llm.ranked_search import ranked_search
from clicktrail.llm.resampling import importance_ranks
from clicktrail.llm.samples import fold
from clicktrail.llm.simhash import simhash_components
from clicktrail.llm.token_files import read_ids, write_documents
from clicktrail.llm.topk import top_k
from clicktrail.llm.toxicity import fit_toxicity, toxicity
from clicktrail.llm.warc import read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, folder, "documents"), model)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_documents(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, folder, "pages"), path)
    chunks = read_warc(spark, path, with_data=False)
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _scored(docs: DataFrame, score: Column, held_out: Column) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_quality(docs, table(spark, folder, "labels"))
    return _scored(docs, quality_score(model), fold(F.col("doc_id"), 3) == 1)


def toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    return _scored(docs, toxicity(model)["score"], fold(F.col("doc_id"), 5) == 0)


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scanned = docs.select("doc_id", licence_scan(docs).alias("scan")).select("doc_id", "scan.*")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, words = F.col("places")["label"], F.col("places")["word"]
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("found")["label"])).alias("labels"),
        "score",
    )


def resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_ranks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, {SPACES}), {LOWER}) AS line_key FROM lines
), repeated AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

TOPK = """
WITH kept AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), kept AS (
  SELECT payload, max(page_id) AS keeper FROM payloads WHERE n >= 1000 GROUP BY payload
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN k.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
FROM payloads p LEFT JOIN kept k ON p.payload = k.payload AND p.n >= 1000
"""

# Distinct words with their CRC-32, whose table of 256 remainders is made by eight halvings each.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), {lower}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORDS = _WORDS.format(lower=LOWER)
RESAMPLING = f"""
WITH remainders AS (
  SELECT list(list_reduce(range(0, 8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
    ORDER BY n) AS rest FROM (SELECT unnest(range(0, 256)) AS n)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents
), features AS (
  SELECT r, unnest(words) AS word FROM docs
), wanted AS (
  SELECT unnest({WORDS}) AS word FROM benchmark
), hashed AS (
  SELECT word, xor(list_reduce(list_transform(range(1, length(hex(encode(word))) // 2 + 1),
      lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i - 1, 2) AS BIGINT)),
    lambda c, byte: xor(c >> 8, rest[xor(c & 255, byte) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM features UNION SELECT word FROM wanted), remainders
), corpus AS (
  SELECT bucket, count(*) AS s FROM features JOIN hashed USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM features) AS big_s, (SELECT count(*) FROM wanted) AS big_t
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST(big_s AS DOUBLE) + 10000)
    / ((CAST(s AS DOUBLE) + 1) * (CAST(big_t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM corpus LEFT JOIN target USING (bucket), totals
), sums AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n FROM features JOIN hashed USING (word) JOIN gains USING (bucket)
  GROUP BY r
), weighed AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN sums USING (r)
), scored AS (
  SELECT doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score FROM weighed
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features, weight) AS place,
    count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS most FROM scored
)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND place <= most THEN place END AS rank FROM ranked
"""

SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents
), terms AS (
  SELECT r, unnest(words) AS term FROM docs
), lengths AS (
  SELECT r, doc_id, len(words) AS n FROM docs WHERE len(words) > 0
), totals AS (
  SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths
), counted AS (
  SELECT r, term, count(*) AS tf FROM terms GROUP BY r, term
), wanted AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({WORDS}) AS term FROM benchmark)
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term, big_n
), scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (r), totals
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": line_dedup,
        "op2_sentencepiece": sentencepiece,
        "op3_simhash": simhash,
        "op4_token_files": token_files,
        "op5_topk": topk,
        "op6_warc": warc,
        "op7_quality": quality,
        "op8_licenses": licenses,
        "op9_decontamination": decontamination,
        "op10_toxicity": toxic,
        "op11_resampling": resampling,
        "op12_packing": packing,
        "op13_ranked_search": search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINE_DEDUP,
        "op5_topk": TOPK,
        "op6_warc": WARC,
        "op11_resampling": RESAMPLING,
        "op13_ranked_search": SEARCH,
    }
