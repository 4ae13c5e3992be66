"""From raw documents to token files: the training-data operators one after the other.

Every stage works on all rows that its predecessor kept, and each stage's rows are written and
read again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmetric.llm.common import read, saved, small_batches
from haulmetric.llm.decontaminate import decontaminated
from haulmetric.llm.mixing import mixed_documents
from haulmetric.llm.ngram_join import Join, one_per_class
from haulmetric.llm.quality import quality_rules
from haulmetric.llm.token_files import token_files

#: Near-duplicates here: five-word shingles, similarity 0.8.
NEAR = Join(size=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality_rules(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return one_per_class(docs, NEAR)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return token_files(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("ngram_join", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("mix_sources", mix),
    ("token_files", write_tokens),
]

#: Byte-pair encoding has no SQL; tests compare run() with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
