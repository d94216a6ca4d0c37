"""The ten operators against brute force, on a hostile fixture and on whole small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm import mixture, shards
from keelson.llm.bpe import round_trip
from keelson.llm.mixture import mix_sources, mixed_documents
from keelson.llm.queries import llm_oracles, llm_queries
from keelson.llm.rp_forest import near_duplicates
from keelson.llm.shards import assign_shards
from keelson.llm.suffix_dedup import _prepared, dedup_bytes, without_repeats
from keelson.llm.token_count import count_tokens
from keelson.llm.topk import top_k
from keelson.session import scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, block long, place string, key string"


def prose(seed, words):
    rng = np.random.default_rng(seed)
    parts = ["en", "re", "tion", "the", "ha", "é", "ß", "ou", "st", "ly", "an"]
    return " ".join("".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    a, b = prose(1, 300), prose(2, 80)
    return [
        None, "", "", " \n\t ", "x", "x y", a, a, a.replace("the", "thé", 3), b, a[100:400] + b, b + " " + b, "ab" * 200, "z" * 500,
        "ab" * 150 + "q", "a b\xa0c d e <|endoftext|> f  g\n\n h’s it's  ", "é ́x 日本語 テキスト 👍🏽 42 007", "\x00\x1f \x85 q",
        prose(3, 6000), prose(4, 40) + b[:99], prose(5, 40) + b[:100], prose(6, 40) + b[:101], b[-120:] + prose(7, 30),
    ]


@pytest.fixture(scope="module")
def documents(spark, texts):
    langs, sources = ["en", "fr", None], ["s1", "s2", None, "s1", "S0", "é", ""]
    rows = [
        (i, t, langs[i % 3], sources[i % 7], None if t is None else len(t), "clash", i, None, "k") for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- 2: token counts --------------------------------------------------------------------------


def check_counts(documents, cache):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    found = rows_of(count_tokens(documents, path, cache))
    given = documents.collect()
    assert len(found) == len(given)
    for r in given:
        text = r["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert tuple(found[r["doc_id"]]) == (r["doc_id"], len(text.encode()), n, n > 2048), repr(text[:50])


def test_token_counts(spark, documents, sf_dir):
    check_counts(documents, scratch_dir(spark, "cache"))
    check_counts(real(spark, sf_dir), scratch_dir(spark, "cache"))


def test_token_cache_is_used_and_appended(spark, documents):
    cache = scratch_dir(spark, "cache")
    count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), cache).count()
    first = spark.read.parquet(cache).count()
    assert first == spark.read.parquet(cache).select("content").distinct().count() < documents.count()
    count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), cache).count()
    assert spark.read.parquet(cache).count() == first
    count_tokens(documents, public_tokenizers.path("piece_bpe_32k.model"), cache, normalise="exact").count()
    assert spark.read.parquet(cache).count() > first


def test_a_digest_stored_twice_counts_once(spark, documents):
    """As two runs at once leave it."""
    cache, path = scratch_dir(spark, "cache"), public_tokenizers.path("word_bpe_49k.json")
    count_tokens(documents, path, cache).count()
    spark.read.parquet(cache).write.mode("append").parquet(f"{cache}-copy")
    spark.read.parquet(f"{cache}-copy").write.mode("append").parquet(cache)
    check_counts(documents, cache)


# --- 5: suffix-array dedup --------------------------------------------------------------------


def brute_spans(rows, length=100):
    seen, out = {}, {}
    data = {i: (t or "").encode() for i, t in rows}
    for i in sorted(data):
        mark = np.zeros(len(data[i]), bool)
        for p in range(len(data[i]) - length + 1):
            s = data[i][p : p + length]
            if s in seen:
                mark[p : p + length] = True
            else:
                seen[s] = (i, p)
        edges = np.diff(np.concatenate([[0], mark.astype(int), [0]]))
        kept = bytes(np.frombuffer(data[i], np.uint8)[~mark])
        out[i] = (i, len(data[i]), int(mark.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block_bytes", [1 << 23, 3000])
def test_suffix_dedup(spark, documents, texts, block_bytes):
    found = rows_of(dedup_bytes(documents, block_bytes=block_bytes))
    wanted = brute_spans(list(enumerate(texts)))
    assert {i: tuple(r) for i, r in found.items()} == wanted


def test_suffix_dedup_on_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in real(spark, sf_dir).collect()]
    found = rows_of(dedup_bytes(real(spark, sf_dir), block_bytes=50_000))
    assert {i: tuple(r) for i, r in found.items()} == brute_spans(rows)


def test_suffix_dedup_of_rows_without_ids(spark, sf_dir):
    """They are documents of their own, dealt over all blocks, and keep their other columns whatever the names."""
    texts = [t for (t,) in real(spark, sf_dir).select("text").distinct().limit(120).collect() if t]
    texts += [texts[0] + " and more", texts[0][50:]]
    given = [(None if i % 3 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumns({"block": F.lit(7), "row": F.lit("r"), "place": F.col("doc_id")})
    known = _prepared(docs, 13)
    assert known.where("row.doc_id is null").select("block").distinct().count() > 3
    ids = {r["text"]: r["doc_id"] for r in known.collect()}
    wanted = brute_spans([(ids[t], t) for t in texts])
    shown = {ids[t]: i for i, t in given}
    found = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in dedup_bytes(docs, block_bytes=20_000).collect())
    assert found == sorted((str(shown[i]), *rest) for i, *rest in wanted.values())
    cut = without_repeats(docs, block_bytes=20_000)
    assert cut.columns == docs.columns and cut.where("block = 7 and row = 'r' and place <=> doc_id").count() == len(texts)


def test_suffix_cut_keeps_characters_and_columns(spark, documents):
    cut = without_repeats(documents)
    assert cut.columns == documents.columns and cut.count() == documents.count()
    sizes = rows_of(dedup_bytes(documents))
    for r in cut.collect():
        whole = sizes[r["doc_id"]]
        assert 0 <= len(r["text"].encode()) - (whole["n_bytes"] - whole["n_removed"]) <= 6 * whole["n_spans"]


# --- 6: sharding ------------------------------------------------------------------------------


def brute_capacity(sizes, shards):
    """The smallest capacity by trying greedy passes over the plain list."""
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle, used, fill = (low + high) // 2, 1, 0
        for s in sizes:
            if fill + s > middle:
                used, fill = used + 1, 0
            fill += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check_shards(documents, shards=40):
    given = documents.collect()
    found = assign_shards(documents, shards).collect()
    assert len(found) == len(given)
    texts = {r["doc_id"]: r["text"] for r in given}
    groups, loads = defaultdict(set), Counter()
    slots = defaultdict(list)
    for r in found:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        groups[texts[r["doc_id"]]].add(r["shard"])
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in groups.values())
    assert all(0 <= s < shards for s in loads)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    weights = Counter()
    for t in texts.values():
        weights[t] += len((t or "").encode()) + 16
    ordered = sorted(weights.values(), reverse=True)
    assert max(loads.values()) == brute_capacity(ordered, shards)
    return loads


def test_shards(spark, documents, sf_dir):
    check_shards(documents)
    check_shards(documents, 3)
    loads = check_shards(real(spark, sf_dir))
    assert len(loads) == 40


def test_a_huge_group_leaves_no_shard_empty(spark):
    rows = [(i, "hot " * 50) for i in range(300)] + [(1000 + i, prose(i, 20)) for i in range(600)]
    loads = check_shards(spark.createDataFrame(rows, "doc_id long, text string"), 10)
    rest = sorted(loads.values())[:-1]
    assert len(loads) == 10 and max(rest) - min(rest) < 0.05 * max(rest)


def test_cuts_between_equal_sizes():
    assert shards.cuts([(10, 8)], 4) == [2, 4, 6]
    assert shards.cuts([], 3) == [0, 0]
    assert shards.cuts([(100, 1), (1, 10)], 3) == [1, 6]


# --- 7: mixing --------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total, capped, out = sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        out = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if out[s] > cap * sizes[s]]
        if not over:
            return out | capped
        capped |= {s: float(cap * sizes[s]) for s in over}


def check_mix(documents, near):
    import re

    given = {r["doc_id"]: r for r in documents.collect()}
    size = {i: len(re.findall(mixture.WORD, r["text"] or "")) for i, r in given.items()}
    sources = Counter()
    for i, r in given.items():
        sources[r["source"]] += size[i]
    goals = brute_targets(sources)
    found = rows_of(mix_sources(documents))
    assert len(found) == len(given)
    taken = Counter()
    for i, r in found.items():
        source = given[i]["source"]
        assert (r["size"], r["source_size"]) == (size[i], sources[source])
        assert r["target"] == pytest.approx(goals[source], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * size[i]
        taken[source] += r["taken"]
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= near * goal + 3 * mixture.BLOCK, (s, taken[s], goal)
    assert found == rows_of(mix_sources(documents.repartition(5)))


def test_mix(spark, documents, sf_dir):
    check_mix(documents, 0.02)
    check_mix(real(spark, sf_dir), 0.02)


def test_mixed_documents_hold_the_words_taken(spark, documents):
    taken = rows_of(mix_sources(documents))
    mixed = mixed_documents(documents)
    assert mixed.columns == documents.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len([w for w in r["text"].replace("\n", " ").replace("\t", " ").split(" ") if w])
        assert r["size"] == "clash" and r["n_chars"] == len(r["text"])
    for i, r in taken.items():
        assert words[i] == r["taken"], i


# --- 8: BPE -----------------------------------------------------------------------------------


def check_bpe(documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    found = rows_of(round_trip(documents, path))
    given = documents.collect()
    assert len(found) == len(given)
    for r in given:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(found[r["doc_id"]]) == (
            r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
        ), repr((r["text"] or "")[:60])


def test_bpe(documents, spark, sf_dir):
    check_bpe(documents)
    check_bpe(real(spark, sf_dir))


# --- 9: top-k ---------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(24)], 0, "clash") for i in range(120)]
    rows += [(200 + i, rows[3][1], 1, None) for i in range(50)]
    rows += [(300 + i, [x + 0.01 * i for x in rows[7][1]], 1, None) for i in range(10)]
    rows += [(400, None, 0, ""), (401, [None] * 24, 0, ""), (402, [float("nan")] * 24, 0, ""), (403, [0.0] * 24, 0, ""), (404, [], 0, ""), (420, [1.0, 2.0], 0, ""), (421, [float("inf")] * 24, 0, "")]
    rows += [(440, rows[5][1], 0, ""), (440, rows[5][1], 0, "")]
    return spark.createDataFrame(rows, VECTORS)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute_top(rows, k=20):
    width = max(len(v) for _, v in rows if v)
    kept = [(i, np.floor(64 * np.pad(np.array(v, float), (0, width - len(v))))) for i, v in rows if usable(v)]
    out = set()
    for q, x in {i: x for i, x in kept if i % 20 == 0}.items():
        best = sorted(((-int(x @ y), i) for i, y in kept if i != q))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block", [2048, 17])
def test_top_k(vectors, block):
    found = top_k(vectors, vectors.where("vec_id % 20 = 0"), block=block)
    assert {tuple(r) for r in found.collect()} == brute_top([(r[0], r[1]) for r in vectors.collect()])


def test_top_k_against_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    rows = llm_queries()["op9_top_k"](spark, sf_dir)
    wanted = con.sql(llm_oracles()["op9_top_k"])
    assert sorted(map(tuple, rows.select(wanted.columns).collect())) == sorted(wanted.fetchall())


# --- 10: embedding near-dedup -----------------------------------------------------------------


def brute_links(rows, cosine=0.9):
    good = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows) if usable(v) and any(v)]
    links = defaultdict(set)
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][2], good[b][2]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[good[a][0]].add(good[b][0])
                links[good[b][0]].add(good[a][0])
    out = []
    for n, (i, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        root = min(rows[m][0] for m in seen)
        out.append((i, len(links[n]), root, i == root))
    return sorted(out)


@pytest.mark.parametrize("cell", [1024, 40])
def test_embedding_links(vectors, cell):
    found = near_duplicates(vectors, cell=cell, leaf=16, trees=10, spill=0.12)
    assert sorted(tuple(r) for r in found.collect()) == brute_links([(r[0], r[1]) for r in vectors.collect()])


def test_embedding_links_on_whole_table(spark, sf_dir):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = near_duplicates(rows, cell=64)
    assert sorted(tuple(r) for r in found.collect()) == brute_links([(r[0], r[1]) for r in rows.collect()])


def near_group(n, seed=5, noise=0.041, width=64):
    """Vectors around one centre, nearly all pairs of which reach a cosine of 0.9."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(width)
    return centre / np.linalg.norm(centre) + noise * rng.standard_normal((n, width))


@pytest.mark.parametrize("cell", [1024, 64])
def test_embedding_links_of_a_dense_group(spark, cell):
    """A group of near vectors keeps its links with the parameters of production; small cells make it blocks."""
    x = np.concatenate([near_group(600), np.random.default_rng(6).standard_normal((900, 64))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    wanted = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["n_links"] for r in near_duplicates(rows, cell=cell).collect()}
    got = np.array([found[i] for i in range(len(x))])
    assert (got <= wanted).all() and got.sum() >= 0.99 * wanted.sum() > 0


# --- All --------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_empty_tables(spark, tmp_path, sf_dir, name):
    for table in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert llm_queries()[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(set(llm_queries()) - {"op9_top_k", "op10_embedding_near_dedup"}))
def test_null_ids_and_repeated_rows(spark, tmp_path, documents, name):
    hard = documents.union(documents).withColumn("doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")))
    hard.write.parquet(f"{tmp_path}/documents.parquet")
    labels = T.StructType.fromDDL("doc_id long, quality int, toxic int")
    spark.createDataFrame([(None, 1, 0), (6, 1, 0), (6, 0, 0), (7, None, None), (9, 1, 0)], labels).write.parquet(f"{tmp_path}/labels.parquet")
    found = llm_queries()[name](spark, str(tmp_path))
    if not name.startswith("op1_"):
        assert found.count() == hard.count()
    else:
        found.collect()
