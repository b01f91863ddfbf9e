"""The queries of the operators in this subpackage, each over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm import binpacking, bpe, covertree, fillmiddle, htmltext, kmeanstree, langid, licenses, meansearch, mixing, ngramjoin, tokenfiles, toxicity

RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by separator scan of flat token files."""
    return tokenfiles.document_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups and link counts of all vectors."""
    return covertree.link_vectors(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit_severity(docs, table(spark, sf_dir, "labels"), group="lang")
    return toxicity.severity(docs, model).select("doc_id", "severity", "grade", "toxic")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by 3-word shingles."""
    return ngramjoin.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of sources takes of every document."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from a model that never saw the held-out ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.cross_checked(docs).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages, htmltext.fit_labeller(pages)).select("page_id", "url", "text", "n_chars")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded to ids and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode_texts(docs, public_tokenizers.path(RANKS), decoded="decoded").select("doc_id", "ids", "decoded")
    return tokens.select(
        "doc_id",
        F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth vector."""
    return kmeanstree.every_hundredth(table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal size, equal texts together."""
    return binpacking.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op12_mean_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds in whole numbers."""
    return meansearch.cluster_vectors(table(spark, sf_dir, "embeddings"), k=16, rounds=3)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text cut at lines and rearranged, and restored from that, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    filled = fillmiddle.fill_in_middle(docs)
    return filled.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fillmiddle.restored(), 256).alias("restored_sha256")
    )


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_cover_tree": op2_cover_tree,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_join": op4_ngram_join,
    "op5_entropy_mix": op5_entropy_mix,
    "op6_language_id": op6_language_id,
    "op7_main_text": op7_main_text,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_license_scan": op9_license_scan,
    "op10_kmeans_tree": op10_kmeans_tree,
    "op11_best_fit": op11_best_fit,
    "op12_mean_search": op12_mean_search,
    "op13_fill_in_middle": op13_fill_in_middle,
}
