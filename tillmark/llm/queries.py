"""The registered queries of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import (
    decontaminate,
    fingerprints,
    html_extract,
    jaccard,
    licenses,
    packing,
    prefix_trie,
    quality,
    resample,
    secrets,
    token_counts,
    toxicity,
    url_filter,
)
from tillmark.llm.learning import fold
from tillmark.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, table(spark, folder, "benchmark"))
    own = F.col("contamination")
    return found.select(
        "doc_id",
        own["n_words"].alias("n_words"),
        own["n_hit"].alias("n_hit"),
        F.size(own["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(own["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (own["n_hit"] > 0).alias("contaminated"),
    )


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.linked(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_minhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_compared(table(spark, folder, "documents").select("doc_id", "text"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    own = F.col("licenses")
    return licenses.scanned(documents).select(
        "doc_id",
        *[own[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(own["base_labels"], ",").alias("base_labels"),
        F.array_join(own["labels"], ",").alias("labels"),
        own["score"].alias("score"),
    )


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return packing.packed(documents, packing.word_tokens(F.col("text")))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_extract.extracted(pages, html_extract.fit(pages), column="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    model = quality.fit(documents, table(spark, folder, "labels"), fold("doc_id") != 0)
    return quality.scored(documents, model).select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "text_score",
        "page_score",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    found = secrets.scanned(documents, keep=["doc_id"])
    base = [k.name for k in secrets.BASE]

    def listed(column):
        parts = [column["kind"], column["start"].cast("string"), column["end"].cast("string")]
        return F.concat_ws(":", *parts)

    def count(name):
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    own = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"].isin(base)), listed), ",")
    live = F.size(F.filter("judged", lambda s: s["live"])).cast("long")
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(own.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", listed), ",").alias("spans"),
        live.alias("n_live"),
        (F.size("judged") - live).alias("n_copied"),
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_labelled(documents, table(spark, folder, "labels"), fold("doc_id"))
    return toxicity.scored(documents, model).select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "url_filter.*")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    rows = prefix_trie.turns(table(spark, folder, "conversations"))
    conversation = F.col("conv_id")
    opening = F.crc32(conversation.cast("string").cast("binary")) % 9
    return prefix_trie.trie(prefix_trie.spliced_sequences(rows, conversation - conversation % 5, opening))


MAX_TOKENS = 4096


def op12_token_counts(
    spark: SparkSession, folder: str, model: str = public_tokenizers.path("piece_bpe_32k.model")
) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = documents.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_counts.tokens(F.col("text"), token_counts.Pieces.load(model)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    drawn = resample.resampled(documents, table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_minhash_fingerprints": op3_minhash_fingerprints,
        "op4_license_scan": op4_license_scan,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_html_extraction": op6_html_extraction,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_secret_scan": op8_secret_scan,
        "op9_toxicity": op9_toxicity,
        "op10_url_filters": op10_url_filters,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_token_counts": op12_token_counts,
        "op13_importance_resampling": op13_importance_resampling,
    }
