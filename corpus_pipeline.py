"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept:

* ``quality`` drops the documents that the line model rejects;
* ``near_duplicates`` keeps of each group of linked documents the one with the smallest
  doc_id (of rows of the group with this id, one), and every document without words or id;
* ``repeats`` cuts strings of ``PASSAGE_BYTES`` bytes that occur twice out of the texts;
* ``decontaminate`` drops the documents that hold a passage of the benchmark;
* ``tokens`` turns the texts into ids: ``(doc_id, ids, n_tokens, round_trip)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, line_crf, ngram_jaccard, piece_viterbi, suffix_dedup
from tarmac.llm.common import stored, table


PASSAGE_BYTES = 240           # exceeded by 51 words in a row (98.8 % of such runs of the given texts)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_crf.good_documents(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_viterbi.encoded_and_checked(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("decontaminate", decontaminated), ("tokens", tokens)]
ORACLE_SQL = None          # no stage but the second can be stated in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read back as the next docs."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
