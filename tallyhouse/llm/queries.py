"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    decontamination,
    exact_dedup,
    html_extraction,
    language_model,
    lexical_search,
    line_dedup,
    near_dedup,
    packing,
    quality,
    secret_scan,
    token_alignment,
    toxicity,
    warc,
)
from tallyhouse.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read(spark, sf_dir, "documents"), n=2, percent=80)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_archives(read(spark, sf_dir, "pages"), least_bytes=0)


def tokenizer_path() -> str:
    """The word tokenizer of the installed vocabulary files, at the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(read(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
    )


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read(spark, sf_dir, "pages"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(read(spark, sf_dir, "documents"), *aligned_tokenizers())


def aligned_tokenizers() -> tuple[str, str, str]:
    """Ranks of byte_bpe_50k.json, its pattern, and the model of the other side."""
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
    return paths[0], public_tokenizers.PATTERN, paths[1]


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_lm_score": op9_lm_score,
    "op10_secret_scan": op10_secret_scan,
    "op11_html_extraction": op11_html_extraction,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # Base32: five hexadecimal digits are four letters.
    "op4_warc": """
        SELECT page_id,
               CAST(strlen(payload) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((CAST('0x' || substr(sha1(payload), 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31),
                   1)), '') AS payload_digest,
               CASE WHEN first_id <> page_id OR (page_id IS NULL AND first_id IS NOT NULL)
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id OR page_id IS NULL THEN first_id END AS refers_to
        FROM (
            SELECT page_id, payload, min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages)
        )
    """,
    "op7_line_dedup": line_dedup.sql(),
    "op8_decontamination": decontamination.sql(),
    "op13_lexical_search": lexical_search.sql(),
}
