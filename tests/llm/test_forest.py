"""The order, the depth and the neighbours of the forest."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quartermet.llm import lsh_forest

RNG = np.random.default_rng(5)


def test_candidates_are_the_neighbours_of_the_longest_prefix(monkeypatch):
    monkeypatch.setattr(lsh_forest, "LIKELY", 0.0)
    monkeypatch.setattr(lsh_forest, "NEAR", 3)
    labels = RNG.integers(0, 3, (60, 8)).astype(np.uint32)
    sketches = RNG.integers(0, 2, (60, 128)).astype(np.uint8)
    found = lsh_forest.candidates(labels, sketches, np.arange(60), 1)
    order = sorted(range(60), key=lambda i: labels[i].tolist())
    place = {i: k for k, i in enumerate(order)}

    def shared(i, j):
        return next((k for k in range(8) if labels[i, k] != labels[j, k]), 8)

    asked = {}
    for a, b in found.tolist():
        asked.setdefault(a, []).append(b)
    for i in range(60):
        near = [j for j in range(60) if j != i and abs(place[i] - place[j]) <= 3]
        best = max(shared(i, j) for j in near)
        assert any(shared(i, j) == best for j in asked[i])
    assert lsh_forest.candidates(labels, sketches, np.zeros(60, int), 1).shape == (0, 2)


def test_regions_are_cut_at_the_shortest_prefix_that_few_share(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 10)
    labels = np.zeros((90, lsh_forest.TREES, 8), ">u4")
    labels[:6, 0, 3] = 1  # 6 share four labels
    labels[6:36, 0, 3] = 2  # 30 share four, 10 of each five
    labels[6:36, 0, 4] = np.arange(30) % 3
    labels[36:, 0, 3] = 3  # 54 share all eight
    rows = [(7, 0, 90, k, k, labels[k].tobytes(), k) for k in range(90)] + [(8, 1, 2, 200, 1, labels[0].tobytes(), 200)]
    regions = spark.createDataFrame(rows, "key long, tree int, c long, rep long, n long, sig binary, component long")
    got = {r.rep: r.x for r in lsh_forest.cut_deeper(regions, 1).collect()}
    assert len(got) == 91 and got[200] == 0
    parts = {}
    for k, x in got.items():
        parts.setdefault(x, set()).add(k)
    assert set(range(6)) in parts.values()
    assert all({6 + r, *range(6 + r, 36, 3)} in parts.values() for r in range(3))
    rest = [p for p in parts.values() if min(p) >= 36 and 200 not in p]
    assert len(rest) > 3 and sum(map(len, rest)) == 54
    assert lsh_forest.cut_deeper(regions.where(F.col("key") == 8), 1).count() == 1


def test_links_of_deeper_regions_are_not_lost(spark, monkeypatch):
    """Regions cut deep, one neighbour looked at: the closing round still finds every link."""
    cloudpickle.register_pickle_by_value(lsh_forest)
    monkeypatch.setattr(lsh_forest, "REGION", 8)
    monkeypatch.setattr(lsh_forest, "NEAR", 1)
    words = ["".join(RNG.choice(list("aeioubdgklmnprst"), 6)) for _ in range(400)]
    base = list(RNG.choice(words, 150))
    rows = []
    for k in range(70):
        own = list(base)
        for at in RNG.choice(150, int(RNG.integers(0, 6)), replace=False):
            own[at] = f"{own[at]}{k}"
        rows.append((k, " ".join(own)))
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for _, t in rows]
    root = list(range(70))
    for a, b in itertools.combinations(range(70), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root = [root[a] if x == root[b] else x for x in root]
    want = {k: min(j for j in range(70) if root[j] == root[k]) for k in range(70)}
    try:
        got = lsh_forest.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(lsh_forest)
    assert {r.doc_id: r.component_id for r in got} == want and 1 < len(set(want.values())) < 70
