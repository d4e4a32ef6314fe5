"""The training corpus, stage by stage: each stage works on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.

In every stage a null doc_id is an id like any other, a null text counts as empty, an empty
table gives an empty one, columns of any further name are passed on (the last stage returns its
own), and texts are judged whole. Rows that repeat an id with other texts are judged each by
its own text; what becomes of exact repeats and ties is said stage by stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairlead.llm.common import ship, table
from fairlead.llm.decontaminate import decontaminate, keep_clean
from fairlead.llm.mixture import mix_documents
from fairlead.llm.neardup import judged_duplicates, keep_one
from fairlead.llm.quality import keep_good, score_quality
from fairlead.llm.queries import tokenizer_path
from fairlead.llm.tokens import token_files
from fairlead.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; exact repeats stay or go together.

    A text without features has the score of one, whatever it is; a score equal to the threshold stays.
    """
    ship(spark)
    scored = stored(score_quality(docs, table(spark, sf_dir, "labels")), "quality-scores")
    return keep_good(docs, scored)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of rows that repeat it, one.

    Documents without words, and those without an id, are near no other.
    """
    ship(spark)
    return keep_one(docs, stored(judged_duplicates(docs), "near-copies"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; exact repeats stay or go together."""
    return keep_clean(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them.

    Sources rank by code point, null last; a source without words is taken no times. Rows that
    repeat id and source are taken alike, an id in two sources by the rate of each.
    """
    return mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per copy.

    Copies of an id follow each other; an empty text is its end id alone.
    """
    ship(spark)
    return token_files(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

# Learned scores, near-duplicate search and tokenizing are no SQL; tests/llm/test_pipeline.py
# holds the pipeline and each stage against plain Python, but for the learned scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
