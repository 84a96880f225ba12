"""A training-data pipeline over `documents`: five stages, each written as Parquet and reread as the next
one's documents. All but the last keep the columns of documents, extra ones included.

In every stage a null or empty text is a document like any other (not toxic, of fingerprint zero, without
words, without secrets, packed as its end alone), a null doc_id stays null, repeated rows are rows of their own
until near_dedup puts them together, and an empty table gives an empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import decontaminate, packing, secrets, simhash, toxicity
from kindred.llm.common import stored, table
from kindred.llm.queries import tokenizer_file


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go. Without usable labels none does."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints, one document stays: the smallest doc_id (null last), of a tie
    the smallest text hash; of equal rows one."""
    return simhash.keep_representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Without items none does."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what the secret scan finds in its text is replaced by a mark."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: where each piece of each document lies."""
    pieces = packing.tokenized(docs, tokenizer_file("byte_bpe_50k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", remove_toxic), ("near_dedup", near_dedup), ("decontamination", decontaminated), ("secret_scan", without_secrets), ("packing", packed)]

#: No SQL expresses a trained classifier or a tokenizer; tests/llm checks the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole table; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
