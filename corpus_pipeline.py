"""The corpus pipeline: documents pass five operators; each stage is written as Parquet and read again.

1. toxicity: documents predicted toxic go; 2. n-gram Jaccard join: of each
component of near duplicates the smallest doc_id stays; 3. substring dedup:
units that an earlier document has are cut from the text; 4. benchmark
decontamination: documents with a hit word go; 5. byte-level BPE: the ids of
every text, with their digests and that of the decoded bytes.

Stages 1 to 4 return the columns of documents. Rows with a null doc_id pass
stages 2 and 3 unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import bpe, decontamination, ngram_join, substring_dedup
from cartwise.llm import toxicity as toxic
from cartwise.llm.common import Scratch, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.clean_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.clean_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", repeated_passages),
          ("benchmark_decontamination", decontaminate), ("byte_bpe", tokenize)]

#: A trained classifier decides in the first stage: no SQL has these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    previous = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if previous is not None:
            scratch.drop(previous)
        previous = name
    return docs
