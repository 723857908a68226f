"""Training-data pipeline: rules, classifier, near-duplicate join, source mix, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept and returns a table that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. The
last returns the mix as ``position``, since rows of several files are read in
another order than they were written.

SQL cannot express the classifier (a trained network), so ORACLE_SQL is None;
the tests hold the pipeline against a plain version of its stages. Edge cases
are those of the operators; an empty table stays empty through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_cnn, jaccard_join, pfair_mix, quality_rules, sentence_pieces
from tidemark.llm.common import prepare
from tidemark.llm.queries import MIX_DEFAULT, MIX_WEIGHTS, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the base or the risk-controlled rules reject go."""
    return quality_rules.keep_rows(docs, table(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, fitted on the labelled rows of ``documents``: documents that score below the threshold go."""
    return byte_cnn.keep_rows(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the document with the least id of each class stays."""
    return jaccard_join.keep_rows(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: all rows, in the order of the mix."""
    return pfair_mix.mixed(docs, MIX_WEIGHTS, MIX_DEFAULT)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: doc_id, n_tokens, ids, whether the ids decode to the text, and the row's position (from 0) in the mix."""
    return sentence_pieces.encode(pfair_mix.with_position(docs), carry=("position",))


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("ngram_jaccard_join", near_duplicates),
          ("source_mix", mix), ("sentence_pieces", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    root = f"{prepare(spark).rstrip('/')}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
