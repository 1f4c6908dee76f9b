"""The registered queries of this folder, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairforge.llm.shipping import ship_package
from pairforge.llm import best_fit_packing, co_training, filter_audit, hamming_search, hilbert_shards, html_text, jaccard_join, lexical_search, lm_scoring, poisson_mixing, quality_rules, sentence_pieces, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a query; executors get the package before it runs."""

    @wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every hundredth vector."""
    return hamming_search.top_k(table(spark, sf_dir, "embeddings"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of several permitted lengths."""
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their 5-word shingles."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by two co-trained views."""
    return co_training.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the word model and by the attention model."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and boosted trees over every document."""
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op8_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to flattened source weights, in a random order."""
    return poisson_mixing.mix_sources(table(spark, sf_dir, "documents"))


ORACLES["op8_poisson_mixing"] = poisson_mixing.MIX_SQL


@query
def op9_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives in the order of their merged index.

    Pages have no time of capture; it is derived from ``page_id``.
    """
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") % 10_000_000)
    histories = warc.capture_histories(table(spark, sf_dir, "pages").withColumn("captured", captured))
    return histories.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured",
        "record_offset", "record_length", "history_order",
    )


@query
def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards along a curve over language, source and length."""
    axes = [hilbert_shards.category_axis("lang"), hilbert_shards.category_axis("source"), hilbert_shards.magnitude_axis("n_chars")]
    return hilbert_shards.shard_by_curve(table(spark, sf_dir, "documents"), axes)


@query
def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers

    model = sentence_pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = sentence_pieces.encode_documents(table(spark, sf_dir, "documents"), model)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = lexical_search.SEARCH_SQL


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each order, per source."""
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = filter_audit.AUDIT_SQL
