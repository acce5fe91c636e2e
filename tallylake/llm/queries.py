"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm import (
    align,
    bpe,
    hard_negatives,
    html_content,
    language,
    licenses,
    pii,
    quality,
    secrets,
    simhash,
    url_rules,
    warc,
    winnow,
)
from tallylake.llm.common import table
from tallylake.session import scratch_dir
from tallylake.sources.paths import delete_at_exit

RANK_FILE = "byte_bpe_50k.tiktoken"
BYTE_LEVEL_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
#: The session's setting that holds the key of the surrogates; the query needs none for test data.
PII_KEY_SETTING = "spark.tallylake.surrogateKey"
_SPAN_TEXT = "concat(x.kind, ':', cast(x.start as string), ':', cast(x.end as string))"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PII_KEY_SETTING, "test data")
    return pii.surrogates(table(spark, sf_dir, "documents"), key)


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.shared_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge_urls(pages, url_rules.rules_table(spark))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    found = warc.page_facts(warc.transactions(pages, folder))
    # Archives that nobody asked to keep go with the application.
    delete_at_exit(spark, folder)
    return found


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def count(kind: str):
        return F.expr(f"cast(size(filter(base_spans, x -> x.kind = '{kind}')) as bigint)")

    def joined(spans: str):
        return F.expr(f"array_join(transform({spans}, x -> {_SPAN_TEXT}), ',')")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
        joined("secret_spans").alias("spans"),
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_content.extract_pages(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *quality.METRICS, "base_failed", "kept", "n_boilerplate_words"
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenize(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    best = F.expr(
        "array_max(transform(matches, x -> cast(2 * x.common as double) /"
        " (x.unit_size + x.template_size)))"
    )
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.size("matches").cast("bigint").alias("n_matches"),
        best.alias("best_dice"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_LEVEL_FILE),
        public_tokenizers.path(PIECE_FILE),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
        outputs=(
            "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        ),
    )
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(
        vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    # A document without id has no remainder: it is not held out, and nothing is learned from it.
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return language.identify(
        documents,
        documents.where(part != 1),
        keep=[F.col("doc_id"), F.coalesce(part == 1, F.lit(False)).alias("held_out")],
    ).withColumn("languages", F.array_join("languages.lang", ","))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_pii_surrogates,
        op2_winnowing,
        op3_url_filter,
        op4_warc_transactions,
        op5_secret_scan,
        op6_html_extraction,
        op7_simhash,
        op8_line_quality,
        op9_bpe,
        op10_license_scan,
        op11_token_alignment,
        op12_hard_negatives,
        op13_language_id,
    )
    return {query.__name__: query for query in own}
