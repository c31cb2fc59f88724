"""Corpus pipeline: documents through the training-data operators.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``docs``. A stage's rows are written as Parquet to the shared folder and read
again for the next, so each works on all rows that its predecessor kept.

Odd input, for every stage: an empty table gives an empty table of the same
columns; rows that repeat are decided alike, each for itself, but for the stage
that keeps one of a group; very long texts are read whole; other columns, also
of names that operators use inside, come through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mdq.llm import language_id, mixing, packing, quality_rules, simhash
from mdq.llm.common import quoted, read_table, write_shared


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognizable language (learned from ``docs``).
    Null and empty texts and texts without a letter have none; where no row has
    a language to learn from, every row goes."""
    return language_id.keep_known(docs, language_id.fit(docs))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or their divergence reject. Null and
    empty texts fail the base rules; rows of a null language have a reference
    of their own."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one of the smallest id (null ids
    last), of equal ids that of the smallest text hash, of equal rows one."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that every source has the same expected share. A null
    source is a source; a row may come out several times or not at all."""
    return mixing.mix(docs).select(*[quoted(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document's token pieces into sequences of 4096. A null or
    empty text is its end id alone; each of equal rows is placed."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Learned models and tokenizers cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
