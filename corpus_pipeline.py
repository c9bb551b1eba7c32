"""The corpus pipeline: documents through language ID, near-dedup, decontamination, mixing, sharding.

Each stage is written and read again before the next. All but the last return the columns of
``documents``, whatever else their input holds. Stages learn and decide from their own input alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm import decontaminate, language, minhash, mixing, sharding
from repotide.llm.common import held_out, picked, read, stored
from repotide.session import folders_made, remove_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    docs = docs.select(COLUMNS)
    model = language.learn(docs.where(~held_out(F.col("doc_id"))))
    told = language.identify(docs, model)
    return told.where(F.col("lang_pred") != language.UNKNOWN).select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the lowest number."""
    docs = docs.select(COLUMNS)
    found = minhash.near_duplicates(docs)
    chosen = found.select("doc_id", "text_id", F.col("kept").cast("int").alias("copies"))
    return picked(docs, chosen, F.max)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs.select(COLUMNS), read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources by their weights, documents repeated up to three times."""
    return mixing.mixed_documents(docs.select(COLUMNS))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document of the mix goes."""
    return sharding.documents_to_shards(docs)


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Learning and signatures can't be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of the documents that all stages keep.

    What a stage writes on its way, and the stage before it has left, is removed when it is done.
    """
    docs, read_from = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with folders_made() as made:
            docs = stored(stage(spark, docs, sf_dir), name)
        # The last one is the stage's own result.
        for path in [*read_from, *made[:-1]]:
            remove_folder(spark, path)
        read_from = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
