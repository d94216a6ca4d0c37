"""Phrase collocations counted by direct-address tiling.

Words are ranked by frequency. Of the ``HEAD`` first ones each gets its rank as id, and the square of
their pairs is cut into tiles of ``TILE`` x ``TILE`` addresses. A pair is counted at its address: in a
dense tile (many occurrences) by one numpy ``bincount`` over the tile, in a sparse one by sorting its
coordinates (COO). Pairs with a word beyond the head, whose ids are digests, are sparse as well. Then
the same is done again one level up: frequent pairs are ranked, and triples are pairs of a pair and a
word, counted in tiles of pair rank x word rank or by sorted coordinates.

Counting is a map-side step. A task sums what it counted for some MB of text, Spark sums over tasks.
Only words (pairs) that occur often enough can be part of a candidate. Which ones do is told to the
tasks by a bitmap of ``BITS`` bits, whatever the vocabulary; the few others that share a bit are counted
too, and leave when the sums are known. So every count is exact and nothing that is broadcast grows.

A word's digest covers its language. Words that share a digest are noticed when words are counted, and
all digests are then made again with another seed.

Defined cases: NULL text is the empty text; NULL language is ``und``; only A-Z are lower-cased; a piece
ends at ``.,;:!?`` and line ends, words are split at blanks and tabs only; ties in score go to the higher
count, then to the phrase in byte order; repeated rows and ids count each; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import digests, mix, ready, slices, stored, text_or_empty, utf8, word_codes

LEAST = 10
TOP = 2000
HEAD = 4096
TILE = 1024
BITS = 24
SLICE = 4 << 20
#: A tile is dense when it holds this share of its addresses in occurrences.
DENSE = 1 / 64
_SEEDS = 8

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some texts: ``code`` of each into ``distinct`` (language, bytes), its text, and whether it follows another one in a piece."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        data = _LOWER[data]
        coded, text, first = word_codes(data, offsets, _GAP[data])
        piece = np.cumsum(_BREAK[data])[first]
        self.follows = np.zeros(len(first), bool)
        self.follows[1:] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        both = np.asarray(coded.indices).astype(np.int64) * max(1, len(self.langs)) + np.asarray(langs.indices)[text]
        kinds, self.code = np.unique(both, return_inverse=True)
        self.lang = kinds % max(1, len(self.langs))
        self.bytes = coded.dictionary.take(pa.array(kinds // max(1, len(self.langs))))

    def digests(self, seed: int) -> np.ndarray:
        """64 bits per distinct word, which cover its language."""
        base = digests(pa.array([x.encode() for x in self.langs], pa.binary()), ~seed & 0xFFFFFFFF)
        return mix(digests(self.bytes, seed) + base[self.lang])


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))


def _cut(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield Words(part)


def word_counts(documents: DataFrame) -> tuple[DataFrame, int]:
    """``(lang, word, id, f)`` of every word, and the seed with which no two of them share an id."""
    spark = ready(documents.sparkSession)
    texts = _texts(documents)
    for seed in range(_SEEDS):

        def run(batches, seed=seed):
            for words in _cut(batches):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words.langs, pa.string()).take(pa.array(words.lang)), words.bytes.cast(pa.large_string()).cast(pa.string()),
                        pa.array(words.digests(seed).view(np.int64)), pa.array(np.bincount(words.code, minlength=len(words.lang))),
                    ],
                    names=["lang", "word", "id", "f"],
                )

        counted = stored(texts.mapInArrow(run, "lang string, word string, id long, f long").groupBy("lang", "word", "id").agg(F.sum("f").alias("f")), "words")
        if counted.groupBy("id").count().where("count > 1").isEmpty():
            return counted, seed
    raise RuntimeError(f"words share a digest under each of {_SEEDS} seeds")


def bitmap(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bitmap of 2^bits places in which the low bits of every id are set; its size does not depend on the ids."""
    place = F.col("id").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        ids.select(place.alias("p"))
        .groupBy(F.expr("p div 32768").alias("part")).agg(F.expr("bitmap_construct_agg(p % 32768)").alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        out[r["part"] * 4096 : r["part"] * 4096 + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def marked(held: np.ndarray, ids: np.ndarray, bits: int = BITS) -> np.ndarray:
    place = (ids & np.int64((1 << bits) - 1)).astype(np.int64)
    return (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def head(counts: DataFrame, size: int) -> np.ndarray:
    """Ids of the most frequent rows, by rank; bounded by ``size``."""
    return np.array([r["id"] for r in counts.orderBy(F.desc("f"), "id").limit(size).select("id").collect()], np.int64)


class Ranks:
    """Rank of an id among the head, or -1."""

    def __init__(self, ids: np.ndarray):
        self.order = np.argsort(ids)
        self.ids = ids[self.order]

    def of(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.full(len(ids), -1, np.int64)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return np.where(self.ids[at] == ids, self.order[at], -1)


def count_pairs(left: np.ndarray, right: np.ndarray, first: np.ndarray, second: np.ndarray, tile: int = TILE) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(left id, right id, count)`` of pairs of ids; ``first`` and ``second`` are their ranks, or -1."""
    out = []
    ranked = (first >= 0) & (second >= 0)
    a, b, la, rb = first[ranked], second[ranked], left[ranked], right[ranked]
    number = (a // tile) << 32 | (b // tile)
    order = np.argsort(number, kind="stable")
    a, b, la, rb, number = a[order], b[order], la[order], rb[order], number[order]
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.zeros(0, np.int64)
    sparse = ~ranked
    loose = [(left[sparse], right[sparse])]
    for begin, end in zip(starts, np.r_[starts[1:], len(number)]):
        if end - begin < tile * tile * DENSE:
            loose.append((la[begin:end], rb[begin:end]))
            continue
        address = (a[begin:end] % tile) * tile + b[begin:end] % tile
        counts = np.bincount(address, minlength=tile * tile)
        where = np.flatnonzero(counts)
        some = np.zeros(tile * tile, np.int64)
        some[address] = np.arange(begin, end)  # one occurrence of each address names its ids
        out.append((la[some[where]], rb[some[where]], counts[where]))
    x, y = np.concatenate([p[0] for p in loose]), np.concatenate([p[1] for p in loose])
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, np.int64)
    out.append((x[starts], y[starts], np.diff(np.r_[starts, len(x)])))
    return out


def pair_id(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name of a pair, used to look it up in bitmaps and ranks; counts go by both ids."""
    with np.errstate(over="ignore"):
        return mix(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(b.view(np.uint64))).view(np.int64)


def phrase_counts(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lang, word, id, f)``, ``(a, b, f)`` and ``(a, b, c, f)``: all words, and pairs and triples that occur ``least`` times."""
    spark = ready(documents.sparkSession)
    texts = _texts(documents)
    words, seed = word_counts(documents)
    often = words.where(F.col("f") >= least)
    share = spark.sparkContext.broadcast
    known, top = share(bitmap(often)), share(head(often, HEAD))  # 2^BITS / 8 bytes and HEAD numbers

    def located(words: Words):
        """Ids by place in the text, which of them may be frequent, and the place of each such pair's second word."""
        ids = words.digests(seed).view(np.int64)
        may = marked(known.value, ids)
        pairs = words.follows.copy()
        pairs[1:] &= may[words.code[1:]] & may[words.code[:-1]]
        return ids, np.flatnonzero(pairs)

    def in_pairs(batches):
        ranks = Ranks(top.value)
        for words in _cut(batches):
            ids, second = located(words)
            rank = ranks.of(ids)
            a, b = words.code[second - 1], words.code[second]
            for x, y, n in count_pairs(ids[a], ids[b], rank[a], rank[b]):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(n)], names=["a", "b", "f"])

    pairs = stored(texts.mapInArrow(in_pairs, "a long, b long, f long").groupBy("a", "b").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "pairs")

    def named(batches):
        for batch in batches:
            a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
            yield pa.RecordBatch.from_arrays([pa.array(pair_id(a, b)), batch.column("f")], names=["id", "f"])

    names = stored(pairs.mapInArrow(named, "id long, f long"), "pair-ids")
    known_pairs, top_pairs = share(bitmap(names)), share(head(names, HEAD))

    def in_triples(batches):
        word_ranks, pair_ranks = Ranks(top.value), Ranks(top_pairs.value)
        for words in _cut(batches):
            ids, second = located(words)
            a, b = ids[words.code[second - 1]], ids[words.code[second]]
            name = pair_id(a, b)
            may = marked(known_pairs.value, name)
            a, b, name, second = a[may], b[may], name[may], second[may]
            then = np.flatnonzero(np.diff(second) == 1)  # the pair that starts with this pair's second word comes next
            c = b[then + 1]
            # Coordinates are a pair's number in this slice and a word.
            order = np.lexsort((b, a))
            new = np.r_[True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)] if len(a) else np.zeros(0, bool)
            number = np.zeros(len(a), np.int64)
            number[order] = np.cumsum(new) - 1
            first = order[new]
            for p, z, n in count_pairs(number[then], c, pair_ranks.of(name[then]), word_ranks.of(c)):
                x, y = a[first[p]], b[first[p]]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(z), pa.array(n)], names=["a", "b", "c", "f"])

    triples = texts.mapInArrow(in_triples, "a long, b long, c long, f long").groupBy("a", "b", "c").agg(F.sum("f").alias("f"))
    return words, pairs, stored(triples.where(F.col("f") >= least), "triples")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, covered: int = 50) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    A phrase goes if a longer one around it has at least ``covered`` % of its count.
    """
    words, pairs, triples = phrase_counts(documents, least)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= least)
    pairs = stored(
        pairs.join(often.selectExpr("id as a", "lang", "word as first", "f as l"), "a")
        .join(often.selectExpr("id as b", "word as second", "f as r"), "b"),
        "pairs-named",
    )
    around = (
        triples.selectExpr("a", "b", "f").union(triples.selectExpr("b as a", "c as b", "f")).groupBy("a", "b").agg(F.max("f").alias("longer"))
    )
    two = pairs.join(around, ["a", "b"], "left").where(f"longer is null or 100 * cast(longer as decimal(20, 0)) < {covered} * cast(f as decimal(20, 0))").selectExpr(
        "lang", "concat(first, ' ', second) as phrase", "f as a", "l", "r", f"{_score('f', 'l', 'r')} as score"
    )
    before = pairs.selectExpr("a", "b", "lang", "first", "second", "l as f1", "f as f12")
    after = pairs.selectExpr("a as b", "b as c", "second as third", "r as f3", "f as f23")
    three = (
        triples.join(before, ["a", "b"]).join(after, ["b", "c"])
        .selectExpr(
            "lang", "concat(first, ' ', second, ' ', third) as phrase", "f as a", "f1", "f23", "f12", "f3",
            f"{_score('f', 'f1', 'f23')} as s1", f"{_score('f', 'f12', 'f3')} as s2",
        )
        .selectExpr("lang", "phrase", "a", "if(s1 <= s2, f1, f12) as l", "if(s1 <= s2, f23, f3) as r", "least(s1, s2) as score")
    )
    ranked = two.unionByName(three).selectExpr(
        "lang", "cast(row_number() over (partition by lang order by score desc, a desc, phrase) as long) as rank", "phrase", "a", "l", "r", "score"
    ).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 a a / (l r)) in decimals of 38 digits: exact for counts below 10^15."""
    return (
        f"cast((cast({a} as decimal(15, 0)) * cast({a} as decimal(15, 0)) * cast(1000000 as decimal(7, 0)))"
        f" div (cast({left} as decimal(18, 0)) * cast({right} as decimal(18, 0))) as long)"
    )


COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), uni AS (
  SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM lists) GROUP BY ALL
), bi AS (
  SELECT lang, x, y, count(*) AS f FROM (
    SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM lists WHERE len(w) > 1) GROUP BY ALL HAVING count(*) >= 10
), tri AS (
  SELECT lang, x, y, z, count(*) AS f FROM (
    SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y, unnest(w[3:]) AS z FROM lists WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10
), covered AS (
  SELECT lang, x, y, max(f) AS longer FROM (SELECT lang, x, y, f FROM tri UNION ALL SELECT lang, y, z, f FROM tri) GROUP BY ALL
), two AS (
  SELECT bi.lang, concat(bi.x, ' ', bi.y) AS phrase, bi.f AS a, u.f AS l, v.f AS r,
         CAST(1000000 AS HUGEINT) * bi.f * bi.f // (CAST(u.f AS HUGEINT) * v.f) AS score
  FROM bi JOIN uni u ON u.lang = bi.lang AND u.x = bi.x JOIN uni v ON v.lang = bi.lang AND v.x = bi.y
  LEFT JOIN covered c ON c.lang = bi.lang AND c.x = bi.x AND c.y = bi.y
  WHERE c.longer IS NULL OR 100 * c.longer < 50 * bi.f
), cuts AS (
  SELECT t.lang, concat(t.x, ' ', t.y, ' ', t.z) AS phrase, t.f AS a, 1 AS k, u.f AS l, b.f AS r
  FROM tri t JOIN uni u ON u.lang = t.lang AND u.x = t.x JOIN bi b ON b.lang = t.lang AND b.x = t.y AND b.y = t.z
  UNION ALL
  SELECT t.lang, concat(t.x, ' ', t.y, ' ', t.z), t.f, 2, b.f, u.f
  FROM tri t JOIN uni u ON u.lang = t.lang AND u.x = t.z JOIN bi b ON b.lang = t.lang AND b.x = t.x AND b.y = t.y
), scored AS (
  SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts
), three AS (
  SELECT lang, phrase, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM (SELECT * FROM two UNION ALL SELECT * FROM three)
), total AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM uni GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
