"""The registered queries of this subpackage and their DuckDB SQL.

Each ``opN_<name>`` is thin: it reads its table, runs the operator with
production parameters and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import queries_sql as sql

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        _QUERIES[name] = fn
        if oracle:
            _SQL[name] = oracle
        return fn
    return deco


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query("op10_quality_rules", sql.QUALITY_RULES)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the line-first verdict of every document."""
    from tidewater.llm.quality_rules import clean_lines

    return clean_lines(_read(spark, sf_dir, "documents"), results=(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_removed_lines", "lost_chars"))


@_query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class of every document by 5-word shingles, Jaccard >= 0.75."""
    from tidewater.llm.ngram_join import similarity_classes

    return similarity_classes(_read(spark, sf_dir, "documents"))


@_query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    from tidewater.llm.packing import pack

    return pack(_read(spark, sf_dir, "documents"))


@_query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    from tidewater.llm.sharding import shard

    return shard(_read(spark, sf_dir, "documents"))


@_query("op6_embedding_near_dedup")
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label with cosine >= 0.93."""
    from tidewater.llm.embedding_dedup import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "embeddings"))


@_query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of all documents with the forest's verdict."""
    from tidewater.llm.secret_scan import findings

    found = findings(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("word").cast("long").alias("word"), F.length("value").cast("long").alias("length"),
                        F.crc32(F.encode("value", "UTF-8")).alias("value_crc32"), "probability", "is_secret")


@_query("op3_mixing", sql.MIXING)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, sampling probability and draw of every document."""
    from tidewater.llm.mixing import mix

    return mix(_read(spark, sf_dir, "documents"))


@_query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from tidewater.llm.html_text import extract

    return extract(_read(spark, sf_dir, "pages"))


@_query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities of every document from a chain fitted on ``labels``."""
    from tidewater.llm.toxicity import predict

    return predict(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and attention-model log10 scores of every document."""
    from tidewater.llm.lm_scoring import score

    return score(_read(spark, sf_dir, "documents"))


@_query("op11_token_counts")
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    from tidewater.llm.token_counts import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"))


@_query("op13_merkle_manifest", sql.MANIFEST)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and the root with the tampered rows folded in, of every document."""
    from tidewater.llm.manifest import tamper_check

    return tamper_check(_read(spark, sf_dir, "documents"))


@_query("op12_collocations", sql.COLLOCATIONS)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of every language."""
    from tidewater.llm.collocations import collocations

    return collocations(_read(spark, sf_dir, "documents"))
