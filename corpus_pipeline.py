"""A corpus from documents: language, toxicity, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
is written and reread before the next one.

Cases: null, empty and letterless texts are of no language and go in the first stage; rows
with an equal doc_id stay or go together in the third, which keeps rows without a doc_id;
very long texts are read whole; extra columns of documents pass unchanged to the last stage;
without labelled rows toxicity rejects nothing; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm import languages, minhash, packing, suffixes, toxicity
from weftgraph.llm.common import stored, table
from weftgraph.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the classifier recognises."""
    return languages.accepted(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has."""
    return suffixes.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("packing", pack),
]

#: Classifiers and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
