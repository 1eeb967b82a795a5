"""The registered query of every operator, over its whole table with production settings."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.llm import (
    bpe,
    cap_filters,
    langid,
    line_crf,
    merkle,
    mixing,
    prefix_trie,
    reputation,
    secrets,
    simhash,
    sketch,
    warc,
    wavelet,
)
from cartloom.llm.shared import new_folder, table
from cartloom.llm.sql import ORACLE as ORACLE

#: Appended to every document of the token files.
END_ID = 1


def vocabulary() -> str:
    """The tokenizer file: CARTLOOM_TOKENIZER, else the installed public one."""
    if path := os.environ.get("CARTLOOM_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_crf.judge(docs, line_crf.train(docs, table(spark, folder, "labels")))


def op2_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"), new_folder(spark, "warc"))


def op3_bottom_k_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.compare_edited(table(spark, folder, "documents"))


def op4_forced_boundary_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), vocabulary())


def page_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """A page is bad if the label of its number calls it so."""
    labels = table(spark, folder, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op5_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    judged = reputation.judge(table(spark, folder, "pages"), page_outcomes(spark, folder))
    return judged.withColumns({name: F.round(name, 6) for name in ("share", "bound")})


def op6_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "wavelet")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wavelet.write_shards(table(spark, folder, "documents"), vocabulary(), target, END_ID, partitions)
    return wavelet.read_documents(spark, target)


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op9_bigru_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.report(table(spark, folder, "documents"))


def op10_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(table(spark, folder, "documents"))


def op11_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.report(table(spark, folder, "embeddings"))


def op12_merkle_descent(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.report(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_line_crf,
        op2_warc_revisits,
        op3_bottom_k_sketch,
        op4_forced_boundary_bpe,
        op5_host_reputation,
        op6_wavelet_shards,
        op7_source_mix,
        op8_markov_secrets,
        op9_bigru_language,
        op10_simhash_trie,
        op11_cap_filters,
        op12_merkle_descent,
        op13_prefix_trie,
    )
}
