"""Near-duplicate operators, the classifier and the pipeline against plain versions."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from keelson.llm import kneser_ney
from keelson.llm.bag_minhash import keep_one, near_groups, signatures
from keelson.llm.common import components, linked
from keelson.llm.paragraphs import repeated_paragraphs
from keelson.llm.queries import op1_substring_dedup, op4_minhash_near_dedup
from keelson.llm.shingles import bags, shingles


def prose(seed, words):
    rng = np.random.default_rng(seed)
    parts = ["en", "re", "tion", "the", "ha", "é", "ou", "st", "ly", "an"]
    return ["".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(words)]


def changed(words, at):
    return [f"new{i}" if i in at else w for i, w in enumerate(words)]


def bag(text, width=5):
    words = (text or "").lower().split()
    if len(words) < width:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def overlap(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_groups(rows, similarity=0.8):
    items = [(i, bag(t)) for i, t in rows]
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if items[a][1] and items[b][1] and overlap(items[a][1], items[b][1]) >= similarity:
                root[find(a)] = find(b)
    out = {}
    for n, (i, x) in enumerate(items):
        same = [items[m][0] for m in range(len(items)) if find(m) == find(n)]
        out[i] = min(same) if x else None
    return out


@pytest.fixture(scope="module")
def near(spark):
    base = prose(1, 200)
    rows = [(0, " ".join(base)), (1, "  ".join(base).upper()), (2, " ".join(changed(base, {10}))), (3, " ".join(changed(base, {100, 150})))]
    rows += [(4, " ".join(changed(base, set(range(0, 200, 7))))), (5, None), (6, ""), (7, "a b"), (8, "A  b"), (9, "a b c")]
    rows += [(10 + i, " ".join(changed(base, {i, i + 1}))) for i in range(40)]
    rows += [(60 + i, " ".join(prose(100 + i, 120))) for i in range(20)]
    rows += [(90, "word " * 300), (91, "word " * 290), (92, "word " * 100)]
    chain = prose(9, 300)
    rows += [(100 + i, " ".join(changed(chain, set(range(0, 6 * i, 6))))) for i in range(8)]
    return rows


def test_near_groups(spark, near):
    docs = spark.createDataFrame(near, "doc_id long, text string")
    found = {r["doc_id"]: r["group_id"] for r in near_groups(docs).collect()}
    assert found == brute_groups(near)


def test_near_groups_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r["doc_id"]: r["group_id"] for r in near_groups(docs).collect()}
    assert found == brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_keep_one_keeps_columns_and_wordless_rows(spark, near):
    docs = spark.createDataFrame([(i, t, "row") for i, t in near], "doc_id long, text string, row_key string")
    kept = keep_one(docs)
    groups = brute_groups(near)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, g in groups.items() if g in (None, i))


def test_groups_of_rows_without_ids(spark, tmp_path):
    a, b, c = prose(31, 80), prose(32, 80), " ".join(prose(33, 80))
    rows = [(i, " ".join(a)) for i in (5, 6, None, 7)] + [(None, " ".join(changed(a, {40})))]
    rows += [(None, " ".join(b)), (None, " ".join(b)), (None, " ".join(changed(b, {40}))), (None, c), (None, ""), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = op4_minhash_near_dedup(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    assert Counter((r["doc_id"], r["group_id"], r["kept"]) for r in found) == Counter(
        {(5, 5, True): 1, (6, 5, False): 1, (7, 5, False): 1, (None, 5, False): 2, (None, None, False): 2, (None, None, True): 4, (9, None, True): 1}
    )
    kept = [(r["doc_id"], r["text"]) for r in keep_one(docs).collect()]
    # one of the group of b stays, and c, and all texts without words
    assert len(kept) == 6 and (5, " ".join(a)) in kept and (None, c) in kept
    assert Counter(t for i, t in kept if i is None and not t) == Counter(["", None]) and (9, "") in kept
    assert sum(t in (" ".join(b), " ".join(changed(b, {40}))) for _, t in kept) == 1


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    common, only = prose(1, 400), prose(2, 100)
    for repeat in (1, 3):
        texts = [" ".join(common * repeat), " ".join(common * repeat + only), " ".join(list(rng.permutation(common)))]
        hashes, owner = shingles(pa.array(texts))
        times = signatures(*bags(hashes, owner), 3, 2000)
        assert np.isfinite(times).all()
        assert np.mean(times[0] == times[1]) == pytest.approx(overlap(bag(texts[0]), bag(texts[1])), abs=0.05)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1000, 1300)] + [(1, 500 + i) for i in range(300)] + [(7, 7), (9, 8), (8, 9)]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(1000, 1301)} == {1000}
    assert {found[500 + i] for i in range(300)} == {1} and found[9] == 8 and 7 not in found


def test_linked_finds_links_away_from_the_pivot(spark):
    members = spark.createDataFrame([(b, i) for b in (1, 2) for i in range(12)], "bucket int, id long")
    asked = []

    def verify(pairs):
        asked.extend(tuple(r) for r in pairs.collect())
        return pairs.where("(a >= 6 and b >= 6) or (a in (2, 3) and b in (2, 3))")

    found = {r["id"]: r["root"] for r in linked(members, verify).collect()}
    assert found == {**{i: 6 for i in range(6, 12)}, 2: 2, 3: 2}


def test_repeated_paragraphs(spark):
    passage, other = prose(1, 60), prose(2, 60)
    short = " ".join(prose(3, 6))
    rows = [
        (1, "\n".join([short, " ".join(passage), " ".join(prose(4, 50))])), (2, "\n".join([" ".join(prose(5, 50)), short, " ".join(passage)])),
        (3, " ".join(changed(passage, {30}))), (4, " ".join(other) + "\n" + " ".join(other)), (5, None), (6, ""), (7, "\n\n"),
        (8, " ".join(changed(passage, set(range(0, 60, 5))))),
    ]
    found = sorted(tuple(r) for r in repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).drop("passage").collect())
    assert found == [(1, 1, 1, False), (2, 2, 1, True), (3, 0, 1, True), (4, 0, 4, False), (4, 1, 4, True)]


def test_paragraphs_of_rows_with_shared_ids(spark):
    """Rows of one id, or of none, have their own lines at the same places."""
    for doc_id in (None, 7):
        bases = [prose(200 + i, 60) for i in range(12)]
        rows = [(doc_id, " ".join(b)) for b in bases] + [(100 + i, " ".join(changed(b, {30}))) for i, b in enumerate(bases)]
        rows += [(doc_id, " ".join(bases[0]))]
        found = repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        passages = {}
        for r in found:
            passages.setdefault(r["passage"], []).append(r)
        assert len(found) == 25 and sorted(map(len, passages.values())) == [2] * 11 + [3]
        assert all(sum(not r["removed"] for r in p) == 1 for p in passages.values())
        assert {r["first_doc_id"] for r in found} == ({7} if doc_id else {100 + i for i in range(12)})


def test_query_takes_short_lines(spark, tmp_path):
    line = " ".join(prose(3, 5))
    rows = [(1, line + "\n" + " ".join(prose(4, 4))), (2, " ".join(prose(5, 30)) + "\n" + line), (3, " ".join(prose(4, 4)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op1_substring_dedup(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.select("doc_id", "paragraph", "first_doc_id", "removed").collect()) == [(1, 0, 1, False), (2, 1, 1, True)]


def test_query_takes_runs_in_and_across_lines(spark, tmp_path):
    """Fifty words that two texts share, inside longer lines, across line ends and without any line end."""
    def around(seed, run, end):
        return " ".join(prose(seed, 70)) + " " + end.join(run) + " " + " ".join(prose(seed + 1, 70))

    rows = []
    for n in range(12):
        run = prose(300 + n, 50)
        parts = [" ".join(run[:20]), " ".join(run[20:])]
        rows += [(10 * n, around(1000 + 10 * n, parts, " ")), (10 * n + 1, around(1005 + 10 * n, parts, "\n" if n % 2 else " "))]
    rows += [(900, " ".join(prose(2000, 200))), (901, None), (None, " ".join(prose(2001, 49)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op1_substring_dedup(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["first_doc_id"], r["removed"]) for r in found} == {
        (10 * n + k, 10 * n, k == 1) for n in range(12) for k in (0, 1)
    }
    assert all(70 <= r["first_word"] <= 95 and r["words"] == 25 for r in found)


def test_paragraphs_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = [((r["doc_id"], n), x) for r in docs.collect() for n, x in enumerate(r["text"].split("\n")) if len(x.split()) >= 25]
    sets = [(i, set(bag(x))) for i, x in lines]
    by_line, linked_lines, holders = dict(sets), set(), {}
    for i, s in sets:
        for x in s:
            holders.setdefault(x, set()).add(i)
    for i, s in sets:
        near = {j for x in s for j in holders[x]} - {i}
        if any(len(s & by_line[j]) >= 0.8 * len(s | by_line[j]) for j in near):
            linked_lines.add(i)
    found = {(r["doc_id"], r["paragraph"]) for r in repeated_paragraphs(docs).collect()}
    assert found == linked_lines


def brute_kn(counts):
    """Interpolated modified Kneser-Ney over a dict of 4-grams, straight from the definition."""
    tables = {4: dict(counts)}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    held = {}
    for k, t in tables.items():
        n = Counter(min(c, 5) for c in t.values())
        if all(n[i] for i in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d = [max(0, min(i, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]
        else:
            d = [0.5, 1.0, 1.5]
        held[k] = lambda c, d=d: d[min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / (len(tables[1]) + 1)
        k = len(g)
        near = {x: c for x, c in tables[k].items() if x[:-1] == g[:-1]}
        if not near:
            return p(g[1:])
        s = sum(near.values())
        c = near.get(g, 0)
        return (max(0, c - held[k](c)) / s if c else 0) + sum(map(held[k], near.values())) / s * p(g[1:])

    return p


def test_kneser_ney(spark):
    good = [" ".join(prose(i, 30)) for i in range(6)]
    bad = "#### $$$ %%% @@@ ~~~ " * 10
    rows = [(i, t, "en") for i, t in enumerate(good)] + [(10, bad, "en"), (11, None, "en"), (12, "", None), (13, "quoi", "fr"), (14, good[0], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)] + [(10, 0, 0), (13, 1, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in kneser_ney.classify(docs, labels, block_bytes=500).collect()}

    def units(t):
        x = "\x02\x02\x02" + t + "\x03"
        return [x[i - 3 : i + 1] for i in range(3, len(x))]

    p = brute_kn(Counter(g for t in good for g in units(t)))
    for i, t, lang in rows:
        if t and lang == "en":
            logs = [np.log(p(g)) for g in units(t)]
            assert found[i]["perplexity"] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)
    assert not found[10]["accepted"] and all(found[i]["accepted"] for i in (0, 1, 2, 3, 4, 5, 11, 12, 13, 14))
    assert [found[i]["perplexity"] for i in (11, 12, 13)] == [None] * 3
    assert found[12]["lang"] is None


def test_classifier_keeps_held_out_good_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = labels.where("doc_id % 3 = 0")
    found = {r["doc_id"]: r["accepted"] for r in kneser_ney.classify(docs, labels.where("doc_id % 3 <> 0")).collect()}
    good = [found[r["doc_id"]] for r in held.where("quality = 1").collect()]
    bad = [found[r["doc_id"]] for r in held.where("quality = 0").collect()]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.6


def test_pipeline(spark, sf_dir):
    """Each stage against what the operator says of its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    state = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        state = spark.createDataFrame(stage(spark, state, sf_dir).collect(), stage(spark, state, sf_dir).schema)
        kept[name] = state
    quality = {r["doc_id"] for r in kneser_ney.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("accepted").collect()}
    assert {r["doc_id"] for r in kept["quality classifier"].collect()} == quality
    groups = brute_groups([(r["doc_id"], r["text"]) for r in kept["quality classifier"].collect()])
    assert {r["doc_id"] for r in kept["minhash near-dedup"].collect()} == {i for i, g in groups.items() if g in (None, i)}
    assert kept["suffix-array dedup"].count() == kept["minhash near-dedup"].count()
    for name in ("quality classifier", "minhash near-dedup", "suffix-array dedup", "mixing"):
        assert kept[name].columns == docs.columns
    assert kept["bpe"].count() == kept["mixing"].count()
    assert Counter(map(tuple, kept["bpe"].collect())) == Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
