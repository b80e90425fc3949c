"""A corpus through five operators: language ID, exact dedup, near dedup, mixing, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, langid, mixing, simhash
from tidemark.llm.common import read, written
from tidemark.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: no letters, or a calibrated score near a blind guess."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts stays, that of the smallest id."""
    return exact_dedup.keep_first_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    return simhash.keep_representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in whole documents; up to three times, or not at all."""
    return mixing.repeat_taken(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids of each remaining row and of the text that they decode to."""
    return bpe.bpe_digests(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("mixture", mixture),
    ("encode", encode),
]

#: Language ID, fingerprints and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
