"""The corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, tokenising.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and
reread as the next one's documents.  All but the last return the columns of documents.

Every stage takes empty tables, nulls in any column, repeated rows and ids, very long texts
and further columns of any name; what each does with them is told at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from towerline.llm import bpe, jaccard_join, line_dedup, mixing, perplexity
from towerline.llm.common import durable, read
from towerline.llm.queries import label_domain, vocabulary

#: The part of a domain's expected tokens that stays; other domains stay whole.
KEEP = {"toxic": 0.1, "junk": 0.1}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the structure rules or their language's perplexity band go.

    Null and empty texts fail the structure rules and go; a null language is one of its own;
    equal texts of a language get one verdict, whatever their ids."""
    return perplexity.filter_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to many documents go.

    A null text becomes an empty one; rows of one id are one document; rows without an id
    keep their lines."""
    return line_dedup.drop_common_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id (ties: hash of
    the text, rows equal in both: any one).  Rows without an id or a word stay."""
    return jaccard_join.keep_one_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic and junk documents are thinned to their share of tokens.

    Null and empty texts stay; equal rows get one verdict; without labels all stay."""
    return mixing.resample(docs, read(spark, sf_dir, "labels"), label_domain(), keep=KEEP)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text, one row for each
    document; a null text is an empty one."""
    return bpe.digests(bpe.tokenize(docs, vocabulary()))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to target weights", source_mixing),
    ("BPE encoding and decoding", encode),
]

#: No SQL: model scores, mixing rates and token ids are beyond it; tests compare the stages
#: with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
