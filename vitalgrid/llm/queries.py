"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm import (
    bagmin, decontaminate, exact, html, kneser, language, negatives, pieces, quality, revisits, secrets, sharding, whitening,
)
from vitalgrid.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The SentencePiece model file, read by the driver.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op1_revisits",
    r"""
WITH page AS (
    SELECT page_id, url, md5(coalesce(html, '')) AS digest, 'day ' || (page_id % 97) AS day FROM pages
),
record AS (
    SELECT 'response-' || page_id AS record_id, url, page_id * 60 AS moment, true AS is_full, digest, day,
        '"' || digest || '"' AS etag, NULL AS expires
    FROM page
    UNION ALL
    SELECT 'revisit-' || page_id, regexp_replace(url, '^https?://', 'HTTPS://') || '#again',
        page_id * 60 + CASE WHEN page_id % 7 = 0 THEN -5 ELSE 30 + page_id % 11 * 6000 END, false, NULL,
        CASE WHEN page_id % 5 = 4 THEN day END,
        CASE WHEN page_id % 5 < 3 THEN 'W/"' || digest || '"' WHEN page_id % 5 = 3 THEN '"other"' END, 'in ' || (page_id % 13)
    FROM page
),
split AS (
    SELECT *, regexp_extract(trim(url), '"""
    + revisits.URL
    + r"""', ['scheme', 'host', 'port', 'path', 'query']) AS u FROM record
),
named AS (
    SELECT *, list_aggregate(list_sort(list_filter(string_split(u.query, '&'),
            lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(?:"""
    + revisits.TRACKING
    + r""")(?:=|$)'))), 'string_agg', '&') AS q
    FROM split
),
addressed AS (
    SELECT *, regexp_replace(lower(u.host), '^www\.', '')
        || CASE WHEN u.port = '' OR (lower(u.scheme) = 'http' AND u.port = '80') OR (lower(u.scheme) = 'https' AND u.port = '443')
            THEN '' ELSE ':' || u.port END
        || regexp_replace(u.path, '/+$', '') || CASE WHEN coalesce(q, '') = '' THEN '' ELSE '?' || q END AS canonical
    FROM named
),
latest AS (
    SELECT canonical, moment, max(record_id) AS record_id FROM addressed WHERE is_full GROUP BY canonical, moment
),
joined AS (
    SELECT v.*, r.record_id AS response_id, b.etag AS stored, b.day AS stored_day, b.digest AS stored_digest
    FROM addressed v
    ASOF LEFT JOIN latest r ON v.canonical = r.canonical AND v.moment > r.moment
    LEFT JOIN (SELECT * FROM addressed WHERE is_full) b ON b.record_id = r.record_id
    WHERE NOT v.is_full
),
judged AS (
    SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
        WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = stored THEN 'resolved' ELSE 'mismatch' END
        WHEN day = stored_day THEN 'resolved' ELSE 'mismatch' END AS verdict
    FROM joined
)
SELECT record_id, canonical, moment AS "time", verdict, response_id,
    CASE WHEN verdict = 'resolved' THEN stored_digest END AS digest,
    CASE WHEN verdict = 'resolved' THEN 200 END AS status,
    CASE WHEN verdict = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10)
        || 'etag: ' || coalesce(etag, stored) || chr(10) || 'expires: ' || expires || chr(10)
        || 'last-modified: ' || coalesce(day, stored_day) END AS headers
FROM judged
""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(revisits.archive(table(spark, folder, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(lines), "\n"))


@query("op2_llr_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("score", 9).alias("score"),
    )


@query("op3_host_suffix_text")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


# CRC-32 (polynomial 0xEDB88320) byte by byte from a 256-entry table built by the rule.
CRC32_SQL = """
WITH RECURSIVE steps AS (
    SELECT range AS byte, range::BIGINT AS value, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
    FROM steps WHERE step < 8
),
rule AS (SELECT list(value ORDER BY byte) AS crc FROM steps WHERE step = 8),
sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT,
                list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM documents, rule
),
"""


@query(
    "op4_prefix_shards",
    CRC32_SQL
    + """
summed AS (
    SELECT *, sum(size) OVER () AS everything, row_number() OVER rows_so_far AS n,
        sum(size) OVER (rows_so_far ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized
    WINDOW rows_so_far AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)
),
cut AS (
    SELECT *, (((2 * upto - size) * 40) // (2 * everything))::INTEGER AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM cut
""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.balanced(sharding.measured(table(spark, folder, "documents")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_bagminhash_classes")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return bagmin.classes(table(spark, folder, "documents"))


@query("op6_novelty_secrets")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, folder, "documents").select("doc_id", "text")))


@query("op7_suffix_pieces")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.Vocabulary.load(PIECE_MODEL)).drop("text")


@query("op8_seeded_alignment")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("score", F.round("score", 9))


@query("op9_language_mixture")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), *language.learn(language.labelled(docs)))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", F.round("score", 9).alias("score"))


@query("op10_kneser_ney")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = kneser.score(docs, kneser.train(kneser.training_texts(docs)))
    return found.select(
        "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"),
    )


@query("op11_refined_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.usable(table(spark, folder, "embeddings"))
    model = whitening.learn(rows)
    each = whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


@query(
    "op12_exact_groups",
    """
WITH plain AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
    sha256(t) AS text_sha256
FROM plain
WINDOW same AS (PARTITION BY t)
""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return exact.marked(table(spark, folder, "documents"), keep="largest")


@query(
    "op13_threshold_negatives",
    """
WITH vector AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pair AS (
    SELECT a.row AS anchor_row, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM vector a JOIN vector b ON a.row <> b.row AND len(a.x) = len(b.x)
    WHERE a.vec_id % 100 = 0
),
positive AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id, row) AS place FROM pair WHERE same
),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_row, p.row ORDER BY n.score DESC, n.vec_id, n.row) AS rank
    FROM positive p JOIN pair n ON n.anchor_row = p.anchor_row AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)
