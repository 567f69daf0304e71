"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one
before it kept; its result is written as Parquet in the shared folder and read again
as the next one's ``docs``. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.llm import langid, packing, quality, simhash
from tillview.llm.linear import remainder
from tillview.llm.queries import PACKING_VOCABULARY, learnt_labels
from tillview.llm.shared import batches, stage, table, unused, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; those without a letter go."""
    batches(spark)
    model = langid.fit_languages(docs.where(remainder("doc_id", 4) != 2))
    own = tuple(unused(docs, name) for name in ("lang_of", "score_of", "rejected"))
    return langid.identify(docs, model, into=own).where(~F.col(own[2])).select(*docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    batches(spark)
    weights = quality.fit_quality(docs.select("doc_id", "text"), learnt_labels(spark, sf_dir, "quality"))
    own = unused(docs, "score_of")
    return quality.score_quality(docs, weights, into=own).where(F.col(own) >= quality.ACCEPT).select(*docs.columns)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id."""
    batches(spark)
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    batches(spark)
    return packing.pack(docs, vocabulary(PACKING_VOCABULARY))


STAGES = [
    ("language_id", language),
    ("quality", good),
    ("simhash_near_dedup", unique),
    ("best_fit_packing", packed),
]

#: The stages learn models and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
