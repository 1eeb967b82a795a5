"""A training corpus in five stages: language, near-duplicates, secrets, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.llm import bpe, langid, mixing, secrets, simhash
from cartloom.llm.queries import vocabulary
from cartloom.llm.shared import free_names, stored, table

#: A document is rejected if its best language is not so many times as probable as an even guess.
LEAST_GAIN = 1.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; ``und`` and doubtful ones go."""
    label, score = free_names(docs, "lang_pred", "score")
    network = langid.train(docs)
    found = langid.identify(docs, network, label, score)
    least = LEAST_GAIN / len(network.languages) if network and len(network.languages) > 1 else 0.0
    kept = found.where((F.col(label) != langid.UNKNOWN) & (F.col(score) >= least))
    return kept.drop(label, score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word resemblances of 0.8 or more; SimHash finds the families."""
    return simhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs, secrets.train(secrets.labelled_strings(docs)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, one row per epoch; the one at a source's cut is shortened."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row in place of its text."""
    encoded = bpe.encode(docs, vocabulary())
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix", mix),
    ("tokens", tokens),
]

#: Networks, tries and merges have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
