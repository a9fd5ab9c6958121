"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a table: the columns of
documents from all but the last, the packed pieces from the last. Stages judge rows, not
ids: a repeated row or one without an id counts for itself. A null text counts as
empty. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.catalog.base import table
from starloom.llm import classifier, mixing, neardup, packing, rules
from starloom.session import work_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones: a score of 0.7 or more.

    Repeated rows are kept or dropped alike; an empty text is scored like any other. Without two
    labelled rows of both kinds every score is 0.5, and no document is kept.
    """
    scored = classifier.score_documents(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    return scored.filter("predicted = 1").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule; empty ones fail. Repeated rows are kept or dropped alike."""
    return rules.judge(docs, keep=tuple(docs.columns)).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five-word shingles, similarity 0.8.

    Of equal rows one stays, also of those without an id; texts without words are linked with nothing,
    and of each id of theirs one row stays.
    """
    return neardup.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times.

    Repeated rows are taken alike up to the row at their source's limit; a null source is a source.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids; a text without tokens is its end id alone.

    Repeated rows are documents of their own.
    """
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packing_stage),
]

#: A fitted classifier, MinHash and a tokenizer have no SQL form: stages and run() are tested against
#: plain ones in tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
