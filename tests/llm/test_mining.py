"""Hard negatives, collocations and language identification against brute force, and their defined cases."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from check import compare, connect
from pyspark.sql import functions as F

from keelson.llm import crf, gnat, tiles
from keelson.llm.queries import llm_oracles, llm_queries

VECTORS = "vec_id long, label int, embedding array<double>"
DOCS = "doc_id long, text string, lang string, source string"


# --- Hard negatives ---------------------------------------------------------------------------


def negatives_by_force(rows, anchors, scale=256):
    good = [(i, y, [math.floor(scale * c) for c in v]) for i, y, v in rows
            if None not in (i, y, v) and all(c is not None and math.isfinite(c) for c in v)]
    asked = {}
    for i, y, v in sorted((r for r in good if r[0] in anchors), key=lambda r: (r[0], r[1], r[2])):
        asked.setdefault(i, (y, v))
    out = []
    for a, (y, v) in asked.items():
        scored = sorted((-sum(p * q for p, q in itertools.zip_longest(v, w, fillvalue=0)), i, z) for i, z, w in good if i != a)
        positives = [(i, -s) for s, i, z in scored if z == y][:5]
        for p, ps in positives:
            window = [(i, -s) for s, i, z in scored if z != y and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, n, i, ps, s) for n, (i, s) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, anchors, **options):
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).withColumn("cell", F.lit(2))
    found = gnat.hard_negatives(df, df.where(F.col("vec_id").isin(*anchors)), **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clouds(n, width, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width))
    return [(i, int(rng.integers(4)), (centres[i % 4] * 0.7 + 0.5 * rng.standard_normal(width)).round(3).tolist()) for i in range(n)]


def test_negatives_through_a_tree_of_many_cells(spark):
    rows = clouds(900, 6)
    rows += [(2000 + i, i % 3, rows[0][2]) for i in range(200)]  # copies of a vector fill a cell
    anchors = list(range(0, 900, 60))
    found = mined(spark, rows, anchors, cell=60, chunk=64, sample=400)
    assert found == negatives_by_force(rows, anchors) and len(found) > 50


def test_negatives_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.9, 0.4]), (3, 3, [0.9, 0.4]),
        (3, 3, [0.9, 0.4]), (4, None, [1.0, 0.5]), (None, 2, [1.0, 0.5]), (5, 2, None), (6, 2, [nan, 1.0]), (7, 2, [None, 1.0]),
        (8, 2, [inf, 1.0]), (9, 2, [0.9]), (10, 1, []), (11, 2, [-1.0, -1.0]), (12, 1, [-0.9, 0.1]), (13, 1, [0.9, 0.5]),
    ]
    anchors = [0, 2, 10, 11, 12]
    assert mined(spark, rows, anchors) == negatives_by_force(rows, anchors)
    assert mined(spark, [], anchors) == []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, 1, [1e300]), (1, 1, [1e300])], [0])


def test_scores_beyond_double_precision_are_exact(spark):
    big = float(2**20 + 1)
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 1.0]), (2, 2, [big, 0.99]), (3, 2, [big - 1 / 256, 1.0])]
    assert mined(spark, rows, [0]) == negatives_by_force(rows, [0])


def test_subtrees_out_of_the_window_are_not_scored():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (rng.integers(0, 12, (3000, 1)) + 0.1 * rng.standard_normal((3000, 3))))
    ids, labels = np.arange(3000), rng.integers(0, 2, 3000)
    a = x[:20]
    top = (a * a).sum(1)[:, None].astype(np.int64)
    *_, scored = gnat.search(x, ids, labels, a, ids[:20], labels[:20], (0.9 * top).astype(np.int64), top, 5, False)
    assert scored < 0.5 * 20 * 3000


# --- Collocations -----------------------------------------------------------------------------


def collocations_by_force(docs, least, top):
    out = []
    by_lang = {}
    for _, text, lang, _ in docs:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        pieces = [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", t)]
        by_lang.setdefault(lang or "und", []).extend(pieces)
    for lang, pieces in by_lang.items():
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in (1, 2, 3) for i in range(len(w) - k + 1))
        n = sum(v for g, v in f.items() if len(g) == 1)
        candidates = {g: v for g, v in f.items() if len(g) > 1 and v >= least}
        rows = []
        for g, v in candidates.items():
            if any(len(h) > len(g) and g in (h[:2], h[1:]) and 100 * u >= 50 * v for h, u in candidates.items()):
                continue
            score, k = min((10**6 * v * v // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -v, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, r, p.decode(), -v, left, right, n, -s) for r, (s, v, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def collocated(spark, docs, **options):
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as f", "'x' as word")
    return sorted(tuple(r) for r in tiles.collocations(df, **options).collect())


def some_docs(seed=5, n=120):
    rng = np.random.default_rng(seed)
    words = ["The", "a", "de", "en", "es", "École", "über", "x'y", "日本", "e\xa0f", " ", "zz", "New", "York", "\x00"]
    marks = [" ", " ", " ", "\t", "  ", ". ", "\n", ",", "?!", "\r\n"]
    docs = []
    for i in range(n):
        some = rng.integers(0, len(words), int(rng.integers(0, 60)))
        text = "".join(words[w] + marks[rng.integers(len(marks))] for w in some)
        docs.append((i, text, [None, "en", "es", "de"][i % 4], "s"))
    return docs


def test_collocations_against_force(spark):
    docs = some_docs() + [(500, None, "en", "s"), (501, "", None, None), (501, "", None, None), (None, "New York " * 3000, "en", "s")]
    for least, top in ((10, 2000), (3, 7)):
        assert collocated(spark, docs, least=least, top=top) == collocations_by_force(docs, least, top)


def test_small_heads_tiles_and_bitmaps_change_nothing(spark, monkeypatch):
    docs = some_docs(6)
    expected = collocations_by_force(docs, 4, 50)
    monkeypatch.setattr(tiles, "HEAD", 6)
    assert collocated(spark, docs, least=4, top=50) == expected


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(2)
    ids = rng.permutation(10**6)[:300].astype(np.int64)
    rank = np.r_[np.arange(200), np.full(100, -1)]
    a, b = np.minimum(rng.geometric(0.03, 20000), 299), np.minimum(rng.geometric(0.03, 20000), 299)
    truth = Counter(zip(ids[a].tolist(), ids[b].tolist()))
    for tile in (4, 16, 1024):
        found = Counter()
        for x, y, n in tiles.count_pairs(ids[a], ids[b], rank[a], rank[b], tile):
            for p, q, m in zip(x.tolist(), y.tolist(), n.tolist()):
                assert (p, q) not in found
                found[p, q] += m
        assert found == truth


def test_words_with_one_digest_are_told_apart(spark, monkeypatch):
    """Under the first seed all words collide; the next one is taken."""
    real = tiles.digests
    monkeypatch.setattr(tiles, "digests", lambda words, seed=0: real(words, seed) if seed else np.zeros(len(words), np.uint64))
    docs = some_docs(7, 40)
    assert collocated(spark, docs, least=3) == collocations_by_force(docs, 3, 2000)


def test_collocations_of_nothing(spark):
    assert collocated(spark, []) == []


def test_scores_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("900000000000000 as a", "900000000000001 as l", "900000000000007 as r")
    a, left, right = 900000000000000, 900000000000001, 900000000000007
    assert row.selectExpr(tiles._score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


# --- Language identification ------------------------------------------------------------------


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(4)
    k, sizes = 3, [0, 1, 5, 7, 0, 2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    emit, move, start = rng.normal(size=(sum(sizes), k)), rng.normal(size=(k, k)), rng.normal(size=k)
    single, pairs = np.zeros_like(emit), np.zeros((k, k))
    for a, b in zip(offsets[:-1], offsets[1:]):
        paths = list(itertools.product(range(k), repeat=int(b - a)))
        weight = np.array([math.exp(sum(emit[a + i, y] for i, y in enumerate(p)) + sum(move[u, v] for u, v in zip(p, p[1:])) + (start[p[0]] if p else 0)) for p in paths])
        for p, w in zip(paths, weight / weight.sum()):
            for i, y in enumerate(p):
                single[a + i, y] += w
            for u, v in zip(p, p[1:]):
                pairs[u, v] += w
    for block in (1, 2, 3, 64):
        found, moved = crf.forward_backward(emit, offsets, move, start, block)
        assert np.allclose(found, single) and np.allclose(moved, pairs)


SAID = {
    "en": "the house and the garden with this they were have been which would there that what some of other from",
    "de": "das haus und der garten mit diesem sie waren haben gewesen welche würden dort dass was einige von anderen",
    "fr": "la maison et le jardin avec ce ils étaient ont été que voudraient là cela quoi quelques des autres",
}


def said(n=60, seed=8):
    rng = np.random.default_rng(seed)
    docs = []
    for i in range(n):
        lang = list(SAID)[i % 3]
        docs.append((i, " ".join(rng.choice(SAID[lang].split(), 30)), lang, "s"))
    return docs


def test_languages_of_unseen_texts_and_defined_cases(spark):
    learned = spark.createDataFrame([*said(), (900, None, "en", "s"), (901, "the", None, "s")], DOCS)
    asked = [(i + 1000, t, None, None) for i, t, _, _ in said(seed=9)] + [
        (1, None, "en", "s"), (1, "", "en", "s"), (2, "12 + 3 — !", "fr", "s"), (None, "the garden", None, None), (None, "the garden", None, None),
        (3, "THE HOUSE and the Garden " * 5000, "de", "s"), (4, "日本", None, None),
    ]
    docs = spark.createDataFrame(asked, DOCS).selectExpr("*", "'xx' as lang_pred", "0.5 as score")
    found = [tuple(r) for r in crf.predict_languages(docs, learned).collect()]
    truth = {i + 1000: lang for i, _, lang, _ in said(seed=9)}
    assert all(lang == truth[i] and 0.5 < s <= 1 for i, lang, s in found if i in truth) and len(found) == len(asked)
    assert sorted(r[1:] for r in found if r[0] in (1, 2)) == [("und", 0.0)] * 3
    assert [r[1] for r in found if r[0] in (None, 3)] == ["en"] * 3
    assert [r[1] in SAID for r in found if r[0] == 4] == [True]
    nothing = crf.predict_languages(docs, learned.where("false")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)} and len(nothing) == len(asked)
    assert crf.predict_languages(docs.where("false"), learned).collect() == []
    assert {r.lang_pred for r in crf.predict_languages(docs, learned.where("lang = 'en'")).collect()} == {"en", "und"}


def test_code_switched_text_is_cut_where_it_switches(spark):
    model = crf.learn(spark.createDataFrame(said(240), DOCS))
    parts = [(lang, SAID[lang].split()) for lang in ("en", "fr", "de", "en")]
    text = " ".join(w for _, words in parts for w in words)
    runs = crf.language_runs(spark.createDataFrame([(7, text, None, None), (8, "", None, None)], DOCS), model).orderBy("first_word").collect()
    labels = [r.lang for r in runs for _ in range(r.words)]
    truth = [lang for lang, words in parts for _ in words]
    assert len(labels) == len(truth) and sum(a == b for a, b in zip(labels, truth)) >= 0.95 * len(truth)
    assert {r.doc_id for r in runs} == {7}
    assert (model.move.argmax(1) == np.arange(3)).all()  # languages stay


# --- The registered queries -------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_collocations"])
def test_query_against_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare(llm_queries()[name](spark, folder), connect(folder), llm_oracles()[name]) == ""


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    found = {r.doc_id: r for r in llm_queries()["op13_language_id"](spark, folder).collect()}
    assert set(found) == {r.doc_id for r in docs}
    assert all(found[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in docs)
    held = [r for r in docs if found[r.doc_id].held_out and re.search(r"[^\W\d_]", r.text or "")]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held) > 100
