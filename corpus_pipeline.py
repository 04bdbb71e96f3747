"""A training corpus from raw documents: five stages, each one operator of ``tickforge.llm``.

Quality rules drop what is no prose and clean the rest line by line; repeated lines go, but from documents that consist of
them for the greater part, which are copies and left whole for the next stage; one document stays of each group of near
copies (the one with the smallest id, and one row of each id); documents that hold a benchmark item go; sources are mixed to
target weights. Every stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one epochs too.

Null and empty texts go in the first stage. Rows without an id cannot be told from others by it: they pass the near copies.
Repeated rows of one id become one row, the least by its columns. Extra columns of any name pass; epochs is replaced. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontamination, line_dedup, mixing, ngram_jaccard, quality_rules
from tickforge.llm._store import delete, noted, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.filter_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.jaccard_components(docs.select("doc_id", "text"), count_links=False)
    gone = found.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("__gone"))
    left = docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1 and doc_id is not null").select(F.col("doc_id").alias("__again"))
    again = written(again, "again")
    if not again.take(1):
        return left
    cols = [F.col(f"`{c}`") for c in docs.columns]
    more = left.join(again, left["doc_id"] == F.col("__again"), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*cols)).alias("__row"))
    return left.join(again, left["doc_id"] == F.col("__again"), "left_anti").unionByName(more.select("__row.*"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.filter_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram jaccard", near_copies), ("decontamination", benchmark), ("mixing", mixture)]

#: The edit join and the components have no SQL form; tests/llm/test_brute.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after all stages. What a stage has written goes as soon as the next one's table is whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with noted() as made:
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k + 1 < len(STAGES):
                docs = written(docs, "stage")
                delete(spark, made[:-1])
                del made[:-1]
    return docs
