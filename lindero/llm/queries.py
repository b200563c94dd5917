"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import host_reputation, merkle, vector_codes
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Place of an installed public vocabulary; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_codes import op1

    return op1(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op2_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tiff import store_texts, stored_digests

    return stored_digests(store_texts(table(spark, sf_dir, "documents")))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .surrogates import with_surrogates

    return with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_groups import similarity_components

    return similarity_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import op6

    return op6(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, capacity=4096)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import op8

    return op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc_zst(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_zst import op9

    return op9(table(spark, sf_dir, "pages"))


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_va_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


def op13_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no outcomes of pages: the labels with the page's number stand in for them."""
    out = host_reputation.judged(table(spark, sf_dir, "pages"), host_reputation.outcomes_of(table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Query] = {
    "op1_token_codes": op1_token_codes,
    "op2_tiff": op2_tiff,
    "op3_surrogates": op3_surrogates,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_jaccard_groups": op5_jaccard_groups,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_warc_zst": op9_warc_zst,
    "op10_chunk_dedup": op10_chunk_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_va_codes": op12_va_codes,
    "op13_host_reputation": op13_host_reputation,
}

ORACLES: dict[str, str] = {
    "op5_jaccard_groups": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 90 * (p.n + q.n - k)),
        r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reached)
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY 1""",
    "op9_warc_zst": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
        SELECT page_id, strlen(html) AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT)]), '') AS payload_digest,
            CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
    "op10_chunk_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op11_merkle_manifest": merkle.sql(),
    "op12_va_codes": vector_codes.sql(),
    "op13_host_reputation": host_reputation.sql(),
}
