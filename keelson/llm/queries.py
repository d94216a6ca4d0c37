"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.bag_minhash import near_groups
from keelson.llm.bpe import round_trip
from keelson.llm.common import ready
from keelson.llm.crf import predict_languages
from keelson.llm.gnat import HARD_NEGATIVES, hard_negatives, relabelled
from keelson.llm.kneser_ney import classify
from keelson.llm.mixture import mix_sources
from keelson.llm.paragraphs import repeated_paragraphs, repeated_segments
from keelson.llm.rp_forest import near_duplicates
from keelson.llm.shards import assign_shards
from keelson.llm.shingles import WIDTH
from keelson.llm.suffix_dedup import dedup_bytes
from keelson.llm.tiles import COLLOCATIONS, collocations
from keelson.llm.token_count import count_tokens
from keelson.llm.topk import top_k
from keelson.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    """Whole lines, and segments of runs in or across lines; ``first_word`` and ``words`` are NULL for lines."""
    docs = _table(spark, sf_dir, "documents")
    return repeated_paragraphs(docs, least_words=WIDTH).unionByName(repeated_segments(docs), allowMissingColumns=True)


def op2_token_counts(spark, sf_dir):
    return count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "token-cache")
    )


def op3_quality_classifier(spark, sf_dir):
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark, sf_dir):
    found = near_groups(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "class_id", "group_id", "first as kept")


def op5_suffix_array_dedup(spark, sf_dir):
    return dedup_bytes(_table(spark, sf_dir, "documents"))


def op6_sharding(spark, sf_dir):
    return assign_shards(_table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_top_k(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op10_embedding_near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark, sf_dir):
    vectors = relabelled(_table(spark, sf_dir, "embeddings"))
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


def op12_collocations(spark, sf_dir):
    return collocations(_table(spark, sf_dir, "documents"))


def op13_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    learned = docs.where("doc_id is not null").where(~held_out)
    found = predict_languages(docs, learned)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup, op2_token_counts, op3_quality_classifier, op4_minhash_near_dedup, op5_suffix_array_dedup,
            op6_sharding, op7_mixing, op8_bpe, op9_top_k, op10_embedding_near_dedup, op11_hard_negatives,
            op12_collocations, op13_language_id,
        )
    }


def llm_oracles() -> dict[str, str]:
    return {"op9_top_k": TOP_K, "op11_hard_negatives": HARD_NEGATIVES, "op12_collocations": COLLOCATIONS}


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor(64 * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""
