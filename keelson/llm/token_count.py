"""Token counts through a digest cache.

Counts are stored by (content digest, tokenizer digest). A run joins the digests of its texts to
the stored counts, encodes one text for each digest that is missing, and appends those counts, so a
text is encoded once however many documents, runs or engines hold it, and a changed tokenizer file
never meets counts of another one.

Content is normalised before the digest only where the tokenizer is known to drop the difference:
``collapse`` turns runs of ASCII white space into one space, for tokenizers that split at and drop
white space. ``exact`` leaves the text as it is.

Within a task, white space tokenizers are asked once per distinct word (a bounded memory of
counts), which gives the same sum because no piece of theirs crosses ASCII white space.

Defined cases: NULL text is the empty text; rows with the same id are separate rows; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import os

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import ready, slices, stored, text_or_empty

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
LIMIT = 2048
_REMEMBERED = 500_000


@functools.cache
def _tokenizer(path: str):
    """The tokenizer of a file, without truncation or padding, loaded once per process."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def _word_counts(path: str) -> dict[bytes, int]:
    return {}


def lengths(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text as the library counts them, without begin or end tokens."""
    tokenizer = _tokenizer(path)
    if path.endswith(".model"):
        return [len(x) for x in tokenizer.encode(texts, num_threads=1)]
    return [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def word_lengths(path: str, texts: list[str]) -> list[int]:
    """The same counts as sums over the words between ASCII white space."""
    known = _word_counts(path)
    words = [x.encode().split() for x in texts]
    new = list({w for ws in words for w in ws if w not in known})
    if len(known) + len(new) > _REMEMBERED:
        known.clear()
        new = list({w for ws in words for w in ws})
    known.update(zip(new, lengths(path, [w.decode() for w in new])))
    return [sum(map(known.__getitem__, ws)) for ws in words]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _cached(spark, cache: str, version: str) -> DataFrame:
    """One row per digest: two runs at once may both append one they miss."""
    try:
        counts = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        counts = spark.createDataFrame([], CACHE_SCHEMA)
    return counts.where(F.col("tokenizer") == version).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(
    documents: DataFrame, path: str, cache: str, normalise: str = "collapse", limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; misses are appended to ``cache``.

    ``path`` is the tokenizer's file, ``cache`` a folder all executors reach.
    """
    spark = ready(documents.sparkSession)
    version = tokenizer_digest(path)
    text = text_or_empty()
    shown = F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ") if normalise == "collapse" else text
    count = word_lengths if normalise == "collapse" else lengths
    row_key = F.xxhash64("doc_id", "text")
    keyed = stored(
        documents.select(
            "doc_id",
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.unhex(F.substring(F.sha2(shown.cast("binary"), 256), 1, 40)).alias("content"),
            row_key.alias("row_key"),
        ),
        "token-keys",
    )
    misses = (
        keyed.groupBy("content")
        .agg(F.min(F.struct("row_key", "doc_id")).alias("one"))
        .join(_cached(spark, cache, version), "content", "left_anti")
        .select("content", "one.row_key", F.col("one.doc_id").alias("id"))
    )

    def encode(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = count(path, [x or "" for x in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("content"), pa.array(found, pa.int64())], names=["content", "n_tokens"]
                )

    texts = documents.select("doc_id", "text", row_key.alias("row_key"))
    (
        texts.join(misses, (texts["row_key"] == misses["row_key"]) & texts["doc_id"].eqNullSafe(misses["id"]))
        .select("content", "text")
        .mapInArrow(encode, "content binary, n_tokens long")
        .groupBy("content").agg(F.first("n_tokens").alias("n_tokens"))
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
        .write.mode("append").parquet(cache)
    )
    return keyed.join(_cached(spark, cache, version), "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
