"""From raw documents to token digests: five stages, each reading what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keelson.llm.bag_minhash import keep_one
from keelson.llm.bpe import round_trip
from keelson.llm.common import ready
from keelson.llm.kneser_ney import accepted
from keelson.llm.mixture import mixed_documents
from keelson.llm.suffix_dedup import without_repeats
from keelson.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject."""
    return accepted(docs, ready(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that also start earlier; ``n_chars`` follows."""
    return without_repeats(docs).selectExpr(
        *[f"cast(char_length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns]
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes: a row for each full copy of a document and one for a rest."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing", mixing),
    ("bpe", encoding),
]

#: The language model, Poisson signatures and BPE merges have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each stored for the next one."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_dir(spark, f"stage{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
