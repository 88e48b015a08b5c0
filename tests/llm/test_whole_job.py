"""Groups that outgrow a bound, and rows that share names, lose nothing."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark import cloudpickle

from quartermet.llm import lattice, lsh_forest

RNG = np.random.default_rng(31)
SCHEMA = "doc_id long, text string, chunk int, row string, n int"


def prose(n: int) -> str:
    return " ".join("".join(RNG.choice(list("aeioubdgklmnprst"), 6)) for _ in range(n))


def changed(text: str, every: int) -> str:
    words = text.split()
    words[::every] = [w + "x" for w in words[::every]]
    return " ".join(words)


@pytest.fixture
def by_value():
    """Workers see patched bounds."""
    cloudpickle.register_pickle_by_value(lsh_forest)
    yield
    cloudpickle.unregister_pickle_by_value(lsh_forest)


@pytest.mark.parametrize(("region", "shingles"), [(2, 1 << 21), (4096, 900)])
def test_large_regions_are_compared_whole(spark, monkeypatch, by_value, region, shingles):
    monkeypatch.setattr(lsh_forest, "REGION", region)
    monkeypatch.setattr(lsh_forest, "SHINGLES", shingles, raising=False)
    parts, rows = [prose(12) for _ in range(26)], []
    for k in range(80):  # every text has most parts of one template; pairs differ in three
        own = np.sort(RNG.permutation(26)[:21])
        less = np.delete(own, [3 + k % 3, 9 + k % 4, 15 + k % 5])
        rows += [(k, " ".join(parts[i] for i in own)), (1000 + k, " ".join(parts[i] for i in less))]
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for _, t in rows]
    names, root = [i for i, _ in rows], list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root = [root[a] if x == root[b] else x for x in root]
    want = {names[k]: min(names[j] for j in range(len(rows)) if root[j] == root[k]) for k in range(len(rows))}
    assert len(set(want.values())) > 40
    got = lsh_forest.groups(spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_groups_of_one_name_stay_apart(spark):
    one, two, three, four = prose(60), prose(60), prose(60), prose(60)
    rows = [(None, one), (None, two), (None, changed(two, 70)), (7, three), (7, four), (7, changed(four, 70)), (8, four)]
    kept = lsh_forest.drop_near_copies(spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA)).collect()
    texts = {r.text for r in kept}
    assert len(kept) == len(texts) == 4 and {one, three} <= texts
    assert len(texts & {two, changed(two, 70)}) == len(texts & {four, changed(four, 70)}) == 1
    assert [r.doc_id for r in kept].count(None) == [r.doc_id for r in kept].count(7) == 2


def test_large_cells_are_dealt(spark, monkeypatch):
    cloudpickle.register_pickle_by_value(lattice)
    monkeypatch.setattr(lattice, "CELL", 8, raising=False)
    one_cell = lattice._one_cell

    def bounded(rows, similar):
        assert rows.num_rows <= 24  # two blocks of about four each
        return one_cell(rows, similar)

    monkeypatch.setattr(lattice, "_one_cell", bounded)
    base = RNG.normal(size=(3, 16))
    rows = [(k, (base[k % 3] + RNG.normal(size=16) * 0.2).tolist()) for k in range(150)]
    rows += [(150 + k, rows[0][1]) for k in range(3)] + [(160, [1.0, 2.0]), (161, [1.0, 2.0])]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    linked = np.array([[len(a) == len(b) and a @ b >= 0.95 for b in unit] for a in unit])
    reach = linked
    for _ in range(8):
        reach = reach @ reach
    try:
        got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(lattice)
    want = {rows[k][0]: (int(linked[k].sum()) - 1, rows[int(reach[k].argmax())][0]) for k in range(len(rows))}
    assert max(n for n, _ in want.values()) > 30
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_sketches_lose_no_links():
    least, share = int(lsh_forest.LIKELY * 128), 0.75 + 0.25 / 256
    lost = sum(math.comb(128, k) * share**k * (1 - share) ** (128 - k) for k in range(least))
    assert lost < 0.00002
