"""From raw documents to packed sequences: toxicity, language, near duplicates, packing.

Every stage takes (spark, docs, sf_dir), works on all documents that the stage before it kept, and returns documents;
the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import duplicates, language, toxicity
from marlstone.llm.packing import pack
from marlstone.llm.queries import table, tokenizer_path
from marlstone.workspace import written

#: A text whose grams are farther out of place than this in the nearest profile is in no known language.
LEAST_LANGUAGE_SCORE = 0.2

_SCORE, _PREDICTED = "score of the stage", "language of the stage"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels that are not held out, scores below its threshold."""
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model, docs.columns, name=_SCORE)
    return scored.filter(F.col(_SCORE) < toxicity.THRESHOLD).select(docs.columns)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from documents that are not held out: no `und`, nothing far from all profiles."""
    found = language.predict(docs, docs.columns, language.learned(docs), names=(_PREDICTED, _SCORE))
    return found.filter((F.col(_PREDICTED) != "und") & (F.col(_SCORE) >= LEAST_LANGUAGE_SCORE)).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates. Documents without an id are in no group."""
    dropped = duplicates.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(written(dropped, "dropped"), "doc_id", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1,024 tokens."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), ["doc_id"], end=0)


STAGES = [
    ("toxicity", without_toxic),
    ("language", with_language),
    ("near_duplicates", without_near_duplicates),
    ("packing", packing),
]

#: The stages are not SQL; a test holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written, and the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
