"""Corpus pipeline: documents to packed training sequences.

Five stages, each one of the operators in ``tidewater.llm``.  A stage gets the
documents that its predecessor kept (written as Parquet and read again) and returns
the documents that go on, with the same columns; the last one returns the packed
pieces.  Extra columns of the documents travel along unchanged.

* quality   failing lines are removed, documents that lose too much are dropped
* ngrams    of each class of near-duplicates the document with the smallest id stays
* secrets   values that the forest calls secrets are replaced by a mark
* mixing    documents are drawn by probabilities raked to the target weights
* packing   the remaining documents are tokenised and packed

Null and empty texts and ids, ties, repeated rows and empty tables are handled as
each operator's docstring defines; rows with a null id are never duplicates.

The stages that work in Python workers set the session's rows of an Arrow batch to at
most ``BATCH_ROWS``; ``run`` puts the session's own value back, a stage called alone,
whose result is not computed yet, leaves it set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from tidewater.llm.common import materialize

BROADCAST_BYTES = 32 << 20    # ids are broadcast up to this size, beyond it joined by a shuffle
BATCH_ROWS = 1024             # rows of whole texts, or of a hash per word, that a task hands to Python at a time
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, unless it has such already: both the executor's
    JVM (up to three times a batch while its buffers grow) and the Python worker hold them."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    _bound_batches(spark)
    judged = quality_rules.clean_lines(docs, carry=tuple(docs.columns), results=("kept", "clean_text"), prefix="_quality_")
    kept = judged.where("_quality_kept").withColumn("text", F.col("_quality_clean_text"))
    return _measured(kept).select(*docs.columns)


def ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    _bound_batches(spark)
    classes = ngram_join.similarity_classes(docs)
    dropped = materialize(classes.where("component_id <> doc_id").select("doc_id").distinct(), "pipeline-dropped")
    if dropped.count() * 16 <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the target weights of sources, languages and topics."""
    return mixing.draw(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents left."""
    _bound_batches(spark)
    return packing.pack(docs)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [("quality", quality), ("ngrams", ngrams), ("secrets", secrets), ("mixing", mix), ("packing", pack)]

#: Learned forests, similarity classes and tokenisers are beyond SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs, rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), spark.conf.get(_BATCH)
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        spark.conf.set(_BATCH, rows)
    return docs
