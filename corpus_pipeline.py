"""A training corpus from raw documents, stage by stage.

Every stage takes the documents that its predecessor kept. All but the last return documents
with their columns; the last returns where each piece of a document lies in the packed
sequences.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clickmill.llm import mixing, packing, quality, simhash, toxicity
from clickmill.llm.common import discard, made, stored, table
from clickmill.llm.queries import word_tokenizer


_left: set[str] = set()


def _stage(function):
    """A stage that first deletes what the stage before it had stored on its way: that one's result is written by now."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        before = made()
        found = function(spark, docs, sf_dir)
        _left.clear()
        _left.update(made() - before)
        return found

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(spark, docs, table(spark, sf_dir, "labels"))


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs, shingle_words=4, max_bits=4)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order: repeats are rows of their own."""
    return mixing.take(spark, docs, weights=(1, 2, 3), most_passes=3)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, word_tokenizer(), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned models, fingerprints and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage returns is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
