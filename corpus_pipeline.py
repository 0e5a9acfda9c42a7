"""A corpus pipeline of five stages over the table of documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All but the last return
the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrollspark.llm import exact_dedup, jaccard_join, mixing, sentencepiece_nbest, toxicity
from scrollspark.llm.queries import N_BEST, PIECE_MODEL, TOXIC_FROM
from scrollspark.llm.tables import fresh_path, removed, scratch, table
from scrollspark.session import ship


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model, TOXIC_FROM)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return exact_dedup.deduplicated(docs, keep="max")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return jaccard_join.representatives(docs, shingle=5, percent=80)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources up to twice, towards equal sources."""
    return mixing.mixed(docs, target_entropy=0.99, max_repeats=2.0, whole=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, scores and digests of every document's N best segmentations."""
    return sentencepiece_nbest.summarised(docs, sentencepiece_nbest.Vocabulary.load(PIECE_MODEL), N_BEST)


def _with_code(stage):
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES = [
    (name, _with_code(stage))
    for name, stage in (("toxicity", clean), ("exact dedup", unique), ("n-gram Jaccard join", distinct), ("mixing sources", weighted), ("SentencePiece", tokens))
]

#: SQL cannot express a trained classifier, the block permutations or the segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over documents.  What a stage has read and written for itself is deleted after it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch() as made:
            out = stage(spark, docs, sf_dir)
            path = fresh_path(spark, f"stage-{name.split()[0].lower()}")
            out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
        removed(spark, *(x for x in [*made, before] if x not in (path, None)))
        before = path
    return docs
