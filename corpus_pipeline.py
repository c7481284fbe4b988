"""From raw documents to packed training sequences.

Quality classifier, near-duplicates, repeated passages, personal data, packing.  Every stage
takes the documents its predecessor kept; all but the last return the columns of documents.

Defined cases, for every stage: a null text counts as empty and stays null, empty texts stay;
rows without an id stay unless they are near copies of one that has an id; a long text is
processed whole; repeated rows are treated alike; an empty table gives an empty table; further
columns, whatever their names, pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwise.llm import (importance, minhash, names, packing, passages, pseudonyms,
                            queries)
from parcelwise.sources.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on these documents and the
    labels, and without usable labels rejects nothing."""
    return importance.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8."""
    return minhash.one_of_each(docs, Scratch(spark, "minhash").save)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more stay in the first document only."""
    return passages.without_repeats(docs, Scratch(spark, "passages").save)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms of the same format."""
    (counts,) = names.free(docs, "pii_counts")
    found = pseudonyms.pseudonymise(docs, queries.PII_KEY, counts=counts)
    kind = dict(docs.dtypes).get("n_chars")
    if kind:
        found = found.withColumn("n_chars", F.coalesce(
            F.char_length("text").cast(kind), F.col("n_chars")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; one row per piece."""
    return packing.pack(docs, queries.gpt_tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("personal_data", personal_data),
          ("packing", pack)]
#: Hash-based similarity, tokenizers and packing have no SQL form; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
