"""A training corpus from raw documents: filter, dedup, mix, encode. Every stage is one of the operators of dailypanel.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailypanel.llm import lines, mixing, ngram_join, pieces, rules
from dailypanel.llm.common import free_name, read, scratch_table
from dailypanel.llm.queries import model_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return rules.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; chunks of lines that another place has already are cut from their texts."""
    out, name = lines.dedup_lines(docs)
    return with_length(out.drop(name))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram likeness connects."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return with_length(mixing.mixed(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    out, name = pieces.encode_documents(docs, model_path())
    ids = free_name(out, "ids")
    return out.withColumn(ids, out[name]["ids"]).drop(name)


def with_length(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: Learned rules, MinHash and Viterbi have no SQL; the tests hold the operators against plain versions, and the stages by columns and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
