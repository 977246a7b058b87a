"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
Stages judge the documents they are given, not the original table. Rows that repeat an id share
that id's verdict; a null id is an id of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import decontamination, jaccard, lines, packing, toxicity
from tipoff.llm.queries import table
from tipoff.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_ROWS = 1024
READER_ROWS = 512


def _with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``docs`` whose id is (``left_semi``) or is not (``left_anti``) among ``ids``; null equals null.

    The ids are hashed and the texts streamed past them: texts are shuffled once, never sorted.
    """
    known = ids.select(F.col("doc_id").alias("_id")).distinct().hint("shuffle_hash")
    return docs.join(known, F.col("doc_id").eqNullSafe(F.col("_id")), how).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return _with_ids(docs, scored.where("predicted = 1"), "left_anti")


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line chunks that an earlier one holds; those of which nothing is left go."""
    cut = lines.remove_repeats(docs, ("doc_id", "lang", "source"))
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept") != ""))
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    found = jaccard.near_duplicates(docs)
    return _with_ids(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_semi")


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _with_ids(docs, found.where("contaminated"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, packed into sequences."""
    vocabulary = public_tokenizers.path(packing.VOCABULARY)
    return packing.pack(materialize(packing.pieces(docs, vocabulary)))


def _in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``stage`` with texts handed to Python ``BATCH_ROWS`` rows at a time, not 10,000.

    Texts are read ``READER_ROWS`` rows at a time, not 4,096: a reader holds a batch of whole texts as
    one array and doubles it as it fills, and the heap grows for such arrays before it is collected.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _in_small_batches(remove_toxic)),
    ("line_dedup", _in_small_batches(remove_repeated_lines)),
    ("ngram_jaccard", _in_small_batches(keep_one_of_each)),
    ("decontamination", _in_small_batches(remove_contaminated)),
    ("packing", _in_small_batches(pack)),
]

# Trained models and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
