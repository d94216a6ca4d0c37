"""Language identification by a linear-chain conditional random field over words.

Each word of a text gets a language, with probabilities by forward-backward, so code-switched texts
are labelled word by word; a text's language is the one with the largest share of its words, and the
score is that share. A word's features are its affixes, its byte n-grams, and a lexicon: the language
shares of the word in all learned texts. The transitions between languages are learned too, from
sequences that switch: segments of several texts, one after the other.

The lexicon counts every word of every learned text, in ``LEXICON`` digest places per language, so its
size does not depend on the corpus. The weights are fitted on a bounded sample, the ``SEGMENTS`` segments
of ``WORDS`` words with the smallest digests of each language; the lexicon leaves a sampled word's own
occurrence out, as it will not know the words of other texts either.

Forward-backward runs over whole texts in blocks: products of step matrices within each block, then
vectors from block to block of a text, then steps inside all blocks at once. It is exact, and a long text
costs no more steps than its number of blocks.

Words are runs of ASCII letters and of bytes beyond ASCII, in lower case.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0, as are all texts if no
language was learned; learned rows with NULL text or language teach nothing; equal shares go to the first
language by code point; repeated rows and ids are rows of their own; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import digests, mix, ready, slices, text_or_empty, utf8, word_codes

SEGMENTS = 1500
WORDS = 32
LEAST_WORDS = 4
LEXICON = 1 << 18
WEIGHT_BITS = 17
STEPS = 40
JOINED = 3
RATE = 0.1
DECAY = 1e-6
BLOCK = 64
SLICE = 2 << 20

_GAP = np.ones(256, bool)
_GAP[97:123] = False
_GAP[128:] = False
_ALPHA = 0.5
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    langs: list[str]
    lexicon: np.ndarray  # places x languages, counts
    totals: np.ndarray
    weights: np.ndarray  # languages x feature places
    trust: float  # weight of the lexicon
    move: np.ndarray  # log weights of transitions
    start: np.ndarray


def features(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Places of features, and the word each is of: n-grams of 2 to 4 bytes with marks at both ends, affixes of 2 to 5."""
    data, offsets = utf8_bytes(words)
    sizes = np.diff(offsets)
    n = len(sizes)
    padded = np.zeros(int(sizes.sum()) + 2 * n, np.uint64)
    begin = offsets[:-1] + 2 * np.arange(n)
    end = begin + sizes + 2
    owner = np.repeat(np.arange(n), sizes)
    padded[np.arange(len(data)) + 2 * owner + 1] = data
    padded[begin] = 2
    padded[end - 1] = 3
    whose = np.repeat(np.arange(n), sizes + 2)
    codes, owners = [], []
    grams = padded.copy()
    for k in (2, 3, 4, 5):
        grams = grams[:-1] if len(grams) else grams
        at = np.arange(len(grams))
        grams = grams | (padded[k - 1 :] << np.uint64(8 * (k - 1)))[: len(grams)]
        inside = at + k <= end[whose[: len(grams)]]
        if k < 5:
            codes.append(grams[inside] | np.uint64(k << 56))
            owners.append(whose[: len(grams)][inside])
        long = np.flatnonzero(sizes + 2 >= k + 1)  # affixes of whole words are n-grams already
        for tag, place in ((16, begin), (32, end - k)):
            codes.append(grams[place[long]] | np.uint64((tag + k) << 56))
            owners.append(long)
    code, owner = np.concatenate(codes), np.concatenate(owners)
    # The upper bits of a product with an odd number spread well, and take one step.
    return ((code * _SPREAD) >> np.uint64(64 - WEIGHT_BITS)).astype(np.int64), owner


def utf8_bytes(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    n = len(words)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lexicon_scores(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log shares of languages, of words with these counts; 0 in all for an unknown word."""
    even = counts / np.maximum(totals, 1) * totals.mean() + _ALPHA
    share = np.log(even / even.sum(1, keepdims=True))
    return share - np.log(1 / counts.shape[1])


def emissions(words: pa.LargeBinaryArray, model: Model, ids: np.ndarray) -> np.ndarray:
    """Log weights of each language for each distinct word."""
    place, owner = features(words)
    out = np.stack([np.bincount(owner, row[place], len(words)) for row in model.weights], axis=1)
    counts = model.lexicon[(ids % np.uint64(LEXICON)).astype(np.int64)]
    return out + model.trust * lexicon_scores(counts.astype(np.float64), model.totals)


def forward_backward(emit: np.ndarray, offsets: np.ndarray, move: np.ndarray, start: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the labels at each place of sequences that lie end to end, and the expected number of each transition.

    ``emit`` (places x labels), ``move`` (labels x labels) and ``start`` are log weights; ``offsets`` bound the sequences.
    """
    n, k = emit.shape
    sizes = np.diff(offsets)
    if n == 0:
        return np.zeros((0, k)), np.zeros((k, k))
    a = np.exp(move - move.max())
    e = np.exp(emit - emit.max(1, keepdims=True))
    s = np.exp(start - start.max())
    per = -(-sizes // block)
    first = np.cumsum(per) - per  # first block of each sequence
    count = int(per.sum())
    owner = np.repeat(np.arange(len(sizes)), per)
    begin = offsets[:-1][owner] + (np.arange(count) - first[owner]) * block
    length = np.minimum(block, offsets[1:][owner] - begin)
    # Long blocks first: those that still run at a step are then the first ones.
    order = np.argsort(-length, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    opens = np.flatnonzero((np.arange(count) == first[owner])[order])
    begin, length = begin[order], length[order]
    running = np.searchsorted(-length, -np.arange(int(length[0])), side="left")

    def unit(x):
        return x / x.sum(-1, keepdims=True)

    whole = np.broadcast_to(np.eye(k), (count, k, k)).copy()
    for t, m in enumerate(running):
        step = (whole[:m].reshape(-1, k) @ a).reshape(m, k, k)
        if t == 0:
            step[opens] = s
        step *= e[begin[:m] + t][:, None, :]
        whole[:m] = step / step.sum((1, 2), keepdims=True)
    into, back = np.full((count, k), 1 / k), np.full((count, k), 1 / k)
    at = np.full((len(sizes), k), 1 / k)
    for r in range(int(per.max())):
        live = np.flatnonzero(per > r)
        here = place[first[live] + r]
        into[here] = at[live]
        at[live] = unit(np.einsum("ni,nij->nj", at[live], whole[here]))
    at = np.full((len(sizes), k), 1 / k)
    for r in range(int(per.max()) - 1, -1, -1):
        live = np.flatnonzero(per > r)
        here = place[first[live] + r]
        back[here] = at[live]
        at[live] = unit(np.einsum("nij,nj->ni", whole[here], at[live]))
    alpha, beta = np.empty((n, k)), np.empty((n, k))
    for t, m in enumerate(running):
        step = into[:m] @ a
        if t == 0:
            step[opens] = s
        into[:m] = alpha[begin[:m] + t] = unit(step * e[begin[:m] + t])
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        here = begin[:m] + t
        beta[here] = back[:m]
        back[:m] = unit((e[here] * back[:m]) @ a.T)
    later = np.ones(n, bool)
    later[offsets[:-1][sizes > 0]] = False
    later = np.flatnonzero(later)
    before, after = alpha[later - 1], e[later] * beta[later]
    chance = ((before @ a) * after).sum(1, keepdims=True)
    return unit(alpha * beta), (before / chance).T @ after * a


def _words(column, seed: int = 0):
    """Of an Arrow column of texts: distinct words, their digests, the word at each place, and the text it is in."""
    data, offsets = utf8(column)
    coded, text, _ = word_codes(data, offsets, _GAP[data])
    return coded.dictionary, digests(coded.dictionary, seed), np.asarray(coded.indices).astype(np.int64), text


def _lowered(documents: DataFrame, *columns: str) -> DataFrame:
    return documents.select(*columns, F.lower(text_or_empty()).alias("text"))


def lexicon(learned: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, and counts of all words of all learned texts by digest place and language."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                langs = part.column("lang").dictionary_encode()
                _, ids, code, text = _words(part.column("text"))
                at = (ids % np.uint64(LEXICON)).astype(np.int64)[code]
                key, n = np.unique(np.asarray(langs.indices)[text].astype(np.int64) * LEXICON + at, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(key // LEXICON)), pa.array((key % LEXICON).astype(np.int32)), pa.array(n)], names=["lang", "place", "n"]
                )

    rows = _lowered(learned, "lang").mapInArrow(run, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most LEXICON rows per language
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((LEXICON, max(1, len(langs))), np.float32)
    which = {x: i for i, x in enumerate(langs)}
    lang = np.array([which[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[np.asarray(found.column("place"), dtype=np.int64), lang] = np.asarray(found.column("n"))
    return langs, counts


def sample(learned: DataFrame, segments: int = SEGMENTS, words: int = WORDS) -> list[tuple[str, str]]:
    """``(lang, segment)`` of the ``segments`` distinct segments of smallest digest of each language."""

    def run(batches):
        kept: dict[str, dict[int, bytes]] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                langs = part.column("lang").to_pylist()
                kinds, ids, code, text = _words(part.column("text"))
                place = np.arange(len(code)) - np.searchsorted(text, text)
                starts = np.flatnonzero(place % words == 0)
                if not len(starts):
                    continue
                with np.errstate(over="ignore"):
                    total = mix(np.add.reduceat(mix(ids[code] + (place % words).astype(np.uint64)), starts))
                ends = np.append(starts[1:], len(code))
                long = ends - starts >= LEAST_WORDS
                for lang in dict.fromkeys(langs):
                    some = kept.setdefault(lang, {})
                    mine = long & (np.array([x == lang for x in langs])[text[starts]])
                    if len(some) == segments:  # larger ones than the last kept can not get in
                        mine &= total < np.uint64(next(reversed(some)))
                    mine = np.flatnonzero(mine)
                    mine = mine[np.argsort(total[mine], kind="stable")[:segments]]
                    for i in mine:
                        if int(total[i]) not in some:
                            some[int(total[i])] = b" ".join(kinds.take(pa.array(code[starts[i] : ends[i]])).to_pylist())
                    kept[lang] = dict(sorted(some.items())[:segments])
        for lang, some in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(np.array(list(some), np.uint64).view(np.int64)), pa.array([x.decode("utf-8", "replace") for x in some.values()], pa.string())],
                names=["lang", "id", "segment"],
            )

    # Digests are compared as signed numbers here and as unsigned ones above: both orders are the same in every task.
    rows = _lowered(learned, "lang").mapInArrow(run, "lang string, id long, segment string").dropDuplicates(["lang", "id"])
    order = "row_number() over (partition by lang order by shiftrightunsigned(id, 1), id)"
    chosen = rows.selectExpr("lang", "id", "segment", f"{order} as nth").where(F.col("nth") <= segments)
    return [(r["lang"], r["segment"]) for r in chosen.orderBy("lang", "nth").collect()]  # segments x languages


def fit(langs: list[str], counts: np.ndarray, chosen: list[tuple[str, str]], steps: int = STEPS) -> Model:
    """Weights of largest penalised likelihood on sequences of ``JOINED`` segments each, in a fixed shuffled order."""
    k = max(1, len(langs))
    model = Model(langs, counts, counts.sum(0).astype(np.float64), np.zeros((k, 1 << WEIGHT_BITS)), 1.0, np.zeros((k, k)), np.zeros(k))
    if not chosen:
        return model
    order = np.random.default_rng(7).permutation(len(chosen))
    texts = [chosen[i][1] for i in order]
    which = {x: i for i, x in enumerate(langs)}
    label = np.array([which[chosen[i][0]] for i in order])
    kinds, ids, code, text = _words(pa.array(texts, pa.large_string()))
    y = label[text]
    edges = np.append(np.searchsorted(text, np.arange(0, len(texts), JOINED)), len(code))
    place, owner = features(kinds)
    own = counts[(ids % np.uint64(LEXICON)).astype(np.int64)].astype(np.float64)[code]
    own[np.arange(len(code)), y] = np.maximum(0, own[np.arange(len(code)), y] - 1)
    known = lexicon_scores(own, model.totals)
    later = np.ones(len(code), bool)
    later[edges[:-1]] = False
    later = np.flatnonzero(later)
    true_moves = np.zeros((k, k))
    np.add.at(true_moves, (y[later - 1], y[later]), 1)
    true = np.eye(k)[y]
    opened = edges[:-1]
    state = [model.weights, np.array([model.trust]), model.move, model.start]
    means, squares = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
    for step in range(1, steps + 1):
        weights, trust, move, start = state
        emit = np.stack([np.bincount(owner, row[place], len(kinds)) for row in weights], axis=1)[code] + trust * known
        got, moved = forward_backward(emit, edges, move, start)
        miss = got - true
        by_word = np.stack([np.bincount(code, miss[:, j], len(kinds)) for j in range(k)], axis=1)
        slope = [
            np.stack([np.bincount(place, by_word[owner, j], 1 << WEIGHT_BITS) for j in range(k)]),
            np.array([(miss * known).sum()]), moved - true_moves, miss[opened].sum(0),
        ]
        for i, (x, g) in enumerate(zip(state, slope)):  # Adam, on the mean over words
            g = g / len(code) + DECAY * x
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            state[i] = x - RATE * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8)
    model.weights, model.trust, model.move, model.start = state[0].astype(np.float32), float(state[1][0]), state[2], state[3]
    return model


def learn(learned: DataFrame, segments: int = SEGMENTS) -> Model:
    """The model of ``learned (text, lang)``."""
    ready(learned.sparkSession)
    learned = learned.where("text is not null and lang is not null").select("lang", "text")
    langs, counts = lexicon(learned)
    return fit(langs, counts, sample(learned, segments))


def _labelled(part: pa.RecordBatch, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the languages for each word, and bounds of the texts."""
    kinds, ids, code, text = _words(part.column("text"))
    bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
    return forward_backward(emissions(kinds, model, ids)[code], bounds, model.move, model.start)[0], bounds


def predict_languages(documents: DataFrame, learned: DataFrame, **options) -> DataFrame:
    """The columns of ``documents`` but text, and ``lang_pred, score``, for every row."""
    model = learn(learned, **options)
    spark = ready(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # places x languages, whatever the corpus
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                lang, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                if model.langs:
                    found, bounds = _labelled(part, model)
                    total = np.concatenate([np.zeros((1, len(model.langs))), np.cumsum(found, axis=0)])
                    share = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(1, np.diff(bounds))[:, None]
                    for i in np.flatnonzero(np.asarray(part.column("lettered").to_pylist(), bool) & (np.diff(bounds) > 0)):
                        lang[i] = model.langs[int(share[i].argmax())]
                        score[i] = min(1.0, max(0.0, share[i].max()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = documents.select("doc_id", lettered, F.lower(text_or_empty()).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_runs(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, first_word, words, lang, score``: each longest run of words of one language, words counted from 0."""
    spark = ready(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE) if model.langs else ():
                found, bounds = _labelled(part, model)
                best = found.argmax(1)
                text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                new = np.flatnonzero(np.r_[True, (best[1:] != best[:-1]) | (text[1:] != text[:-1])]) if len(best) else np.zeros(0, np.int64)
                sizes = np.diff(np.append(new, len(best)))
                mean = np.add.reduceat(found.max(1), new) / sizes if len(new) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(text[new])), pa.array(new - bounds[text[new]]), pa.array(sizes),
                        pa.array([model.langs[i] for i in best[new]], pa.string()), pa.array(np.clip(mean, 0, 1)),
                    ],
                    names=["doc_id", "first_word", "words", "lang", "score"],
                )

    rows = documents.select("doc_id", F.lower(text_or_empty()).alias("text"))
    return rows.mapInArrow(run, "doc_id long, first_word long, words long, lang string, score double")
