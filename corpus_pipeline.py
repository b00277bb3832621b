"""The corpus pipeline: five stages over ``documents``, each a Parquet table.

quality rules -> SimHash near-duplicates -> suffix-array repeats -> benchmark
decontamination -> mixing. Stages but the last return the columns of
``documents``; every one works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.llm.common import delete, shared_checkpoints, table
from folioworks.llm.decontaminate import clean_documents
from folioworks.llm.quality_rules import good_documents
from folioworks.llm.queries import texts
from folioworks.llm.simhash import one_of_each_class
from folioworks.llm.source_mix import mix_sources
from folioworks.llm.suffix_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash class, the one of the smallest doc_id, null last; rows of one id may be of many classes."""
    return one_of_each_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat; ``n_chars`` follows the text."""
    rest = remove_repeats(docs)
    return rest.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

#: Fingerprints, alignments and permutations have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again.

    A stage's table is deleted when the next one's is there; the last one's stays
    until the folder is cleared, as the rows returned are read from it.
    """
    shared_checkpoints(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = texts(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            delete(spark, f"{folder}/{number - 1}")
    return docs
