"""The training-data pipeline over ``documents``: quality rules, quality
classifier, MinHash near-duplicates, mixing to target weights, BPE encoding.

Each stage works on all rows that its predecessor kept, written as Parquet and
read again. All but the last return the columns of ``documents``.

Defined results: as the operators define them; rows that share a doc_id are one
document to the near-duplicate stage, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapfeed.llm import bpe, minhash, mixing, pairwise, rules
from snapfeed.llm.common import aside, shared_folder
from snapfeed.llm.queries import tokenizer_path
from snapfeed.llm.registry import ship
from snapfeed.session import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship(spark)
    return rules.accepted(docs, read_table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go."""
    ship(spark)
    ranker = pairwise.train(docs, read_table(spark, sf_dir, "labels"))
    renamed, restore = aside(docs, ["doc_id", "text"])
    return restore(pairwise.classify(renamed, ranker, renamed.columns).where("predicted = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    ship(spark)
    kept = minhash.near_duplicates(docs).where("kept").select("doc_id").distinct()
    with_id = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return with_id.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' words in the target shares: a row per document and epoch."""
    ship(spark)
    return mixing.mixed_documents(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    ship(spark)
    return bpe.digests(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("minhash_dedup", near_duplicates),
          ("mixing", mix_sources), ("bpe", bpe_encode)]
ORACLE_SQL = None  # the classifier, MinHash and BPE stages are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
