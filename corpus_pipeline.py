"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept:

1. language: documents without a letter, or in no learned language, go;
2. near duplicates: one document of each group of linked ones stays, the one of
   the smallest id;
3. repeats: byte strings that an earlier document has are cut out; the rows stay;
4. personal data: every span is replaced by its kind;
5. packing: where each document, or piece of one, goes in the training sequences.

The first four return the columns of ``documents`` (n_chars follows the text).
A null text is in no language, so the first stage drops its row.  What lies between
the stages is removed when the application ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import jaccard_forest, langid, pii, suffix_dedup, varpack
from kestrel.llm.common import prepare, table
from kestrel.llm.vocab import BYTE_RANKS, PATTERN
from kestrel.session import scratch_dir

#: A recurrent network and a trained language profile have no SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_forest.first_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _counted(suffix_dedup.strip(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _counted(pii.redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return varpack.pack_documents(docs, BYTE_RANKS, PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("repeats", repeats),
    ("personal data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
