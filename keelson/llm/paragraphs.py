"""Substring dedup on paragraphs: MinHash banding, exact Jaccard, components.

Paragraphs are the lines of a text. Those of at least ``least_words`` words get a MinHash signature
of their shingle set, in bands of few rows so that recall at the threshold is high (0.41 per band
at 0.8, 0.997 over ten bands). Paragraphs that share a band are joined and verified by exact
Jaccard similarity; components of the links are the passages. The first paragraph of a passage, by
document and place, stays, the others are removals.

Paragraphs with equal shingle sets form a class that is banded and compared once, so a line that
stands in a third of all documents is one class.

``repeated_segments`` finds what whole lines cannot: runs of words inside longer lines or across line
ends. Of every 26 windows of 25 words in a row the one with the least hash is a segment, so two
texts that share 50 words in a row share a segment in them, wherever the run stands. Segments with
equal words are a passage; they may overlap, and the ends of a run may stand outside of them.

Defined cases: NULL text has no paragraphs; shorter lines are never removed; rows that share an id,
NULL ids too, are separate documents, of which exactly one keeps the passage; a document with an id
comes before one without; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import linked, lists, may_reach, mix, prefix_members, random_words, ready, slices, stored, text_or_empty
from keelson.llm.shingles import bags, hashed_words, shingles

LEAST_WORDS = 25
SIMILARITY = 0.8
BANDS = 10
ROWS = 4
SEGMENT = 25
RUN = 50


def _with_class(rows: DataFrame, classes: DataFrame, share: int = 1000) -> DataFrame:
    """``rows`` joined to their class by ``para``; ``classes`` is stored and has ``n``, the rows of each.

    The rows of a class that has over a thousandth of all stay where they are: such classes are fewer than a
    thousand, which bounds what is broadcast. Only the rows of the others move, so no task gets a hot class.
    """
    limit = (classes.agg(F.sum("n")).first()[0] or 0) // share
    hot = F.broadcast(classes.where(F.col("n") > limit))
    others = rows.join(F.broadcast(classes.where(F.col("n") > limit).select("para")), "para", "left_anti")
    return rows.join(hot, "para").unionByName(others.join(classes.where(F.col("n") <= limit), "para"))


def min_hashes(owner: np.ndarray, hashes: np.ndarray, n: int, count: int) -> np.ndarray:
    """``n`` x ``count`` minima of independent hashes of each set; every set has an element."""
    heads = np.searchsorted(owner, np.arange(n))
    factors, terms = random_words(23, count) | np.uint64(1), random_words(29, count)
    out = np.empty((n, count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat((hashes ^ terms[k]) * factors[k], heads)
    return out


def _lines(part: pa.RecordBatch, least_words: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(lines, row, place in the text)`` of the lines with enough words."""
    split = pc.split_pattern(part.column("text").cast(pa.large_string()), "\n")
    flat = split.flatten()
    counts = np.diff(np.asarray(split.offsets))
    row = np.repeat(np.arange(part.num_rows), counts)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    words = np.bincount(hashed_words(flat)[1], minlength=len(flat))
    keep = np.flatnonzero(words >= least_words)
    return flat.take(pa.array(keep)), row[keep], place[keep]


def _signed(batches, least_words: int, bands: int, rows: int):
    for batch in batches:
        for part in slices(batch, "text"):
            lines, row, place = _lines(part, least_words)
            n = len(lines)
            if not n:
                continue
            owner, hashes, _ = bags(*shingles(lines))
            found = min_hashes(owner, hashes, n, bands * rows).reshape(n, bands, rows)
            keys = np.tile(random_words(31, bands), (n, 1))
            for k in range(rows):
                keys = mix(keys ^ found[:, :, k]) + np.uint64(1)
            bounds = np.searchsorted(owner, np.arange(n + 1))
            digest = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)), part.column("row_key").take(pa.array(row)), pa.array(place.astype(np.int32)), pa.array(digest, pa.binary()),
                    lists(keys.view(np.int64).reshape(-1), np.arange(n + 1) * bands),
                ],
                names=["doc_id", "row_key", "place", "para", "bands"],
            )


def _elements(batches, least_words: int):
    """Shingle sets of the wanted paragraphs of each text."""
    for batch in batches:
        for part in slices(batch, "text"):
            lines, row, place = _lines(part, least_words)
            wanted = {
                (r, p): name
                for r, (places, names) in enumerate(zip(part.column("places").to_pylist(), part.column("paras").to_pylist()))
                for p, name in zip(places, names)
            }
            pick, ids = [], []
            for i, at in enumerate(zip(row.tolist(), place.tolist())):
                if at in wanted:
                    pick.append(i)
                    ids.append(wanted[at])
            if not pick:
                continue
            owner, hashes, _ = bags(*shingles(lines.take(pa.array(pick))))
            offsets = np.searchsorted(owner, np.arange(len(pick) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), lists(hashes.view(np.int64), offsets)], names=["para", "elements"]
            )


def repeated_paragraphs(
    documents: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, paragraph, passage, first_doc_id, removed`` of every paragraph of a repeated passage.

    ``paragraph`` counts the lines of the text from 0; ``passage`` is the id of the component;
    ``removed`` is false for the first paragraph of it only.
    """
    ready(documents.sparkSession)
    texts = documents.select("doc_id", text_or_empty().alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = stored(
        texts.mapInArrow(
            lambda batches: _signed(batches, least_words, bands, rows), "doc_id long, row_key long, place int, para binary, bands array<long>"
        ).withColumn("copy", F.monotonically_increasing_id()),
        "paragraph-signatures",
    )
    classes = stored(
        signed.groupBy("para").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "place", "row_key", "copy")).alias("one"), F.count("*").alias("n"), F.first("bands").alias("bands")),
        "paragraph-classes",
    )
    members = classes.select(F.explode("bands").alias("bucket"), F.col("para").alias("id"))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    members = stored(members.join(shared, "bucket"), "paragraph-members")
    asked = (
        classes.join(members.select(F.col("id").alias("para")).distinct(), "para", "left_semi")
        .groupBy(F.col("one.doc_id").alias("i"), F.col("one.row_key").alias("k"))
        .agg(F.collect_list("one.place").alias("places"), F.collect_list("para").alias("paras"))
    )
    elements = stored(
        texts.join(asked, (texts["row_key"] == asked["k"]) & texts["doc_id"].eqNullSafe(asked["i"]))
        .select("text", "places", "paras")
        .mapInArrow(lambda batches: _elements(batches, least_words), "para binary, elements array<long>")
        .dropDuplicates(["para"]),
        "paragraph-sets",
    )

    def verify(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(elements.selectExpr("para as a", "elements as x"), "a")
            .join(elements.selectExpr("para as b", "elements as y"), "b")
            .where(f"least(size(x), size(y)) >= {similarity} * greatest(size(x), size(y))")
            .selectExpr("a", "b", "size(x) + size(y) as total", "size(array_intersect(x, y)) as shared")
        )
        return both.where(f"shared >= {similarity} * (total - shared)").select("a", "b")

    def refine(ids: DataFrame) -> DataFrame:
        return prefix_members(elements.withColumnRenamed("para", "id"), ids, similarity)

    roots = linked(members, verify, refine, may_reach(similarity))
    placed = classes.select("para", "one", "n").join(roots.withColumnRenamed("id", "para"), "para", "left").where("n > 1 or root is not null")
    placed = placed.withColumn("root", F.coalesce("root", "para"))
    first = placed.groupBy("root").agg(F.min("one").alias("first"))
    placed = stored(placed.join(first, "root").select("para", "n", F.hex("root").alias("passage"), "first"), "paragraph-passages")
    return _with_class(signed.select("doc_id", "place", "para", "copy"), placed).select(
        "doc_id", F.col("place").alias("paragraph"), "passage", F.col("first.doc_id").alias("first_doc_id"),
        (F.col("copy") != F.col("first.copy")).alias("removed"),
    )


def _segments(batches, width: int, run: int):
    """The windows of ``width`` words whose hash is least among those of some ``run`` words."""
    reach = run - width + 1
    for batch in batches:
        for part in slices(batch, "text"):
            split = pc.split_pattern(part.column("text").cast(pa.large_string()), "\n")
            lines = np.asarray(split.offsets)
            words, line = hashed_words(split.flatten())
            if len(words) < run:
                continue
            row = np.searchsorted(lines - lines[0], line, side="right") - 1
            n = len(words) - width + 1
            both = []
            for seed in (37, 41):
                terms, mixed = random_words(seed, width) | np.uint64(1), mix(words ^ np.uint64(seed))
                total = np.zeros(n, np.uint64)
                for k in range(width):
                    total += mixed[k : n + k] * terms[k]
                both.append(mix(total))
            starts = np.flatnonzero(row[: len(words) - run + 1] == row[run - 1 :])
            least = np.lib.stride_tricks.sliding_window_view(both[0], reach)
            at = np.unique(np.concatenate([starts[i : i + 65536] + least[starts[i : i + 65536]].argmin(axis=1) for i in range(0, len(starts), 65536)] or [starts]))
            if not len(at):
                continue
            own = row[at]
            head = np.searchsorted(row, own)
            digest = np.stack([both[0][at], both[1][at]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(own)), pa.array((line[at] - (lines - lines[0])[own]).astype(np.int32)),
                    pa.array(at - head), pa.array([d.tobytes() for d in digest], pa.binary()),
                ],
                names=["doc_id", "place", "first_word", "para"],
            )


def repeated_segments(documents: DataFrame, width: int = SEGMENT, run: int = RUN) -> DataFrame:
    """``doc_id, paragraph, passage, first_doc_id, removed, first_word, words`` of every repeated segment.

    ``paragraph`` is the line of its first word and ``first_word`` counts the words of the text from 0.
    """
    ready(documents.sparkSession)
    texts = documents.select("doc_id", text_or_empty().alias("text"))
    found = stored(
        texts.mapInArrow(lambda batches: _segments(batches, width, run), "doc_id long, place int, first_word long, para binary")
        .withColumn("copy", F.monotonically_increasing_id()),
        "segments",
    )
    classes = stored(
        found.groupBy("para")
        .agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "first_word", "copy")).alias("first"), F.count("*").alias("n"))
        .where("n > 1"),
        "segment-classes",
    )
    return _with_class(found, classes).select(
        "doc_id", F.col("place").alias("paragraph"), F.hex("para").alias("passage"), F.col("first.doc_id").alias("first_doc_id"),
        (F.col("copy") != F.col("first.copy")).alias("removed"), "first_word", F.lit(width).alias("words"),
    )
