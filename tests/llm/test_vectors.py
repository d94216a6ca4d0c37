"""Links at the bound, of any length and size of components."""

import math
import tracemalloc

import numpy as np
import pytest

from keelson.llm import rp_forest
from keelson.llm.queries import llm_queries  # noqa: F401  (the registered parameters are the defaults used here)
from keelson.llm.rp_forest import COSINE, LEAF, SPILL, TREES, leaf_pairs, near_duplicates


def linked(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect()}


def at_cosine(c, scale=1.0):
    return [scale * c, scale * math.sqrt(1 - c * c)]


def test_nothing_below_the_bound_links(spark):
    rows = [(0, [1.0, 0.0], 0)]
    rows += [(1, at_cosine(0.9 - 5e-10), 0)]
    assert linked(spark, rows) == {0: (0, 0, True), 1: (0, 1, True)}
    rows[1] = (1, at_cosine(0.9 + 5e-10), 0)
    assert linked(spark, rows) == {0: (1, 0, True), 1: (1, 0, False)}


def test_every_length_has_links_of_its_own(spark):
    rows = [(i, [1.0, float(i), 5.0], 0) for i in range(0, 40, 10)] + [(100, [1.0, 0.0], 1), (101, [1.0, 0.01], 1), (102, [1.0], 1), (103, [7.0], 1)]
    found = linked(spark, rows)
    assert found[100] == (1, 100, True) and found[101] == (1, 100, False) and found[102] == (1, 102, True)


def test_huge_and_tiny_components(spark):
    sizes = [1e200, 1e-200, 1.0, 5e-324, 1.7e308]
    rows = [(i, [s, 0.0], 0) for i, s in enumerate(sizes)] + [(10, at_cosine(0.95, 1e200), 0), (11, [0.0, 1e-200], 0)]
    found = linked(spark, rows)
    assert {found[i] for i in range(1, 5)} == {(5, 0, False)} and found[0] == (5, 0, True)
    assert found[10] == (5, 0, False) and found[11] == (0, 11, True)


def test_scaled_copies_are_one_group(spark):
    direction = np.random.default_rng(5).standard_normal(16)
    rows = [(i, (direction * (1 + i / 7)).tolist(), 0) for i in range(300)]
    found = linked(spark, rows)
    assert {v[:2] for v in found.values()} == {(299, 0)}


@pytest.mark.parametrize("members,noise", [(300, 0.02), (300, 0.035), (1000, 0.035), (1000, 0.041)])
def test_recall_in_a_near_group(members, noise):
    """All trees of the registered parameters over one group, as a cell's task sees it."""
    rng = np.random.default_rng(members)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    x = np.concatenate([centre + noise * rng.standard_normal((members, 64)), rng.standard_normal((1000, 64))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(unit @ unit.T >= COSINE, 1))
    truth = set(zip(a.tolist(), b.tolist()))
    found = set()
    for tree in range(TREES):
        found |= set(map(tuple, leaf_pairs(x, 17 * tree + 1, LEAF, SPILL, COSINE).tolist()))
    assert found <= truth and len(found) >= 0.99 * len(truth) > 0


def near_group(members, background, noise=0.0138, seed=9):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(64)
    near = centre / np.linalg.norm(centre) + noise * rng.standard_normal((members, 64))
    return np.concatenate([near, rng.standard_normal((background, 64))])


def test_memory_of_a_near_group_does_not_follow_its_links():
    """Each pair used to be held with both its vectors, 1 KB a pair."""
    x = near_group(1200, 300)
    tracemalloc.start()
    pairs = leaf_pairs(x, 3, LEAF, SPILL, COSINE)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) == 1200 * 1199 // 2 and peak < 150e6


def test_links_come_in_runs(monkeypatch):
    x = near_group(500, 300, noise=0.041)
    side = np.arange(800) % 2
    whole = [leaf_pairs(x, 3, LEAF, SPILL, COSINE, s).tolist() for s in (None, side)]
    monkeypatch.setattr(rp_forest, "HELD", 2000)
    for s, wanted in zip((None, side), whole):
        runs = list(rp_forest.leaf_runs(x, 3, LEAF, SPILL, COSINE, s))
        assert len(runs) > 10 and max(map(len, runs)) <= 2 * 2000
        assert sorted(set(map(tuple, np.concatenate(runs).tolist()))) == sorted(map(tuple, wanted))


def test_rounds_and_partitions_change_nothing(spark, monkeypatch):
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(near_group(500, 500))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")

    def found(df):
        return sorted(map(tuple, near_duplicates(df, cell=64).collect()))

    whole = found(vectors)
    assert {r[1:3] for r in whole[:500]} == {(499, 0)} and all(r[1] == 0 for r in whole[500:])
    assert found(vectors.selectExpr("vec_id", "cast(embedding as array<double>) as embedding")) == whole
    monkeypatch.setattr(rp_forest, "ROUND", 1)
    monkeypatch.setattr(rp_forest, "PART", 1 << 14)
    rounds = []
    monkeypatch.setattr(rp_forest, "stored", lambda df, name, f=rp_forest.stored: (rounds.append(name), f(df, name))[1])
    assert found(vectors) == whole and rounds.count("vector-links-of-round") > 5
