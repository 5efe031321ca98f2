"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import langid, mixing, neardup, packing, suffixes
from tallyline.llm.common import stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; a missing ``lang`` is filled in.

    The models learn from the rows that have a ``lang``; where none has, nothing can be recognised and
    nothing is rejected.
    """
    model = langid.train(docs)
    if not model.languages:
        return docs
    found = langid.identify(docs, model).where(~F.col("lang_rejected"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that earlier documents hold; emptied documents go."""
    return suffixes.deduplicated(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, documents repeated as often as they are taken."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048, ids included."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("minhash_near_dedup", without_near_duplicates),
    ("suffix_array_dedup", without_repeats),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: The language models, the sampled sketches and the packing search have no SQL form; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result stored and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
