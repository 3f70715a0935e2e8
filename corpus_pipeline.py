"""A corpus pipeline over ``documents``: clean, judge, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the
columns they were given; what a stage rejects is gone for the stages after it.

1. toxicity        rows that score 0.5 or more go
2. quality_rules   rows that fail the base rules or lie far out of their language and source go
3. near_duplicates one row of each class of equal or near-equal texts stays (five-word shingles, similarity 0.8)
4. mixing          rows are sampled by calibrated probabilities towards the target marginals
5. bpe             ids of the public byte-level vocabulary, and digests of ids and decoded text

Null, empty and repeated rows, ties and clashing extra columns have the results the operators define; an empty
table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricepanel.llm import bpe_trie, chosen_path, ftrl_toxicity, ipf_mixing, mcd_rules
from pricepanel.llm.common import arrow_batches, documents, kept_table, scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return ftrl_toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return mcd_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return chosen_path.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ipf_mixing.sample_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    arrow_batches(spark)
    return bpe_trie.encode_documents(docs)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("bpe", bpe)]

# Trained models, iterated estimates and merges have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = kept_table(stage(spark, docs, sf_dir), folder, f"{k}_{name}")
    return docs
