"""Linked vectors against comparing all pairs, and components against a search."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tallybrook.llm import vectors as module
from tallybrook.llm.components import components, forest
from tallybrook.llm.queries import op10_vectors
from tallybrook.llm.vectors import link_vectors


def smallest_reachable(nodes, links):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for n in sorted(nodes):
        todo = [n]
        while todo:
            m = todo.pop()
            if m not in found:
                found[m] = n
                todo += near[m]
    return found


def brute(rows, least=0.98):
    """rows (vec_id, vector, label) with distinct ids."""
    good = [(i, np.array(v, dtype=np.float64), c) for i, v, c in rows if c is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = []
    for p, (i, x, c) in enumerate(good):
        for j, y, d in good[:p]:
            if c == d and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                pairs.append((i, j))
    count = defaultdict(int)
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    root = smallest_reachable([r[0] for r in rows], pairs)
    return sorted((i, count[i], root[i], root[i] == i) for i, _, _ in rows)


def made(rng, n, d=16, groups=8):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = rows[int(rng.integers(len(rows)))][1]
            v = (np.array(base) + rng.normal(size=d) * rng.choice([0, 0.02, 0.05, 0.08])).tolist()
        else:
            v = rng.normal(size=d).tolist()
        rows.append((i * 3 + 1, [float(np.float32(x)) for x in v], int(rng.integers(groups))))
    return rows


def in_a_subspace(d, effective, n):
    """Unit vectors of ``d`` dimensions that lie in ``effective`` ones."""
    rng = np.random.default_rng(12)
    base = np.linalg.qr(rng.normal(size=(d, effective)))[0]
    low = rng.normal(size=(n, effective))
    return (low / np.sqrt((low**2).sum(1))[:, None]) @ base.T


def test_against_all_pairs(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    rows = made(rng, 700, groups=2)
    rows += [(5000 + i, rows[0][1], rows[0][2]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, link_vectors(df, f"file://{tmp_path}/a").collect())) == brute(rows)
    # Blocks of few vectors change nothing.
    monkeypatch.setattr(module, "TOGETHER", 7)
    assert sorted(map(tuple, link_vectors(df, f"file://{tmp_path}/b").collect())) == brute(rows)


@pytest.mark.parametrize("d, effective, n", [(64, 2, 1500), (384, 4, 6000), (384, 8, 6000), (64, 64, 6000)])
def test_of_linked_vectors_one_visits_the_list_of_the_other(d, effective, n):
    unit = in_a_subspace(d, effective, n)
    index = module.fit(unit)
    home = index.encode(unit)[0]
    i, j = np.nonzero(unit @ unit.T >= 0.98)
    visits = index.visits(unit, home, 0.98)
    assert len(i) > n - 1 and np.all(visits[i, home[j]] | visits[j, home[i]])


@pytest.mark.parametrize("d, effective, n", [(64, 2, 1500), (384, 4, 3000)])
def test_vectors_near_a_small_subspace(spark, tmp_path, d, effective, n):
    unit = in_a_subspace(d, effective, n)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(unit)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in link_vectors(df, f"file://{tmp_path}").collect()}
    cosine = unit @ unit.T
    # Cosines at the very border may fall to either side.
    assert not np.any(np.abs(cosine - 0.98) < 1e-12)
    assert got == dict(enumerate(((cosine >= 0.98).sum(1) - 1).tolist()))


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (3, [1e30, 1e28], 1),
        (4, [0.0, 0.0], 1),
        (5, None, 1),
        (6, [], 1),
        (7, [1.0, None], 1),
        (8, [float("nan"), 1.0], 1),
        (9, [float("inf"), 1.0], 1),
        (10, [1.0, 0.0], None),
        (11, [1.0, 0.0], 2),
        (12, [1.0, 0.0, 0.0], 1),
        (13, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    assert sorted(map(tuple, link_vectors(df, f"file://{tmp_path}/a").collect())) == brute(rows)
    twice = spark.createDataFrame([(1, [1.0], 1), (1, [1.0], 1), (None, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, link_vectors(twice, f"file://{tmp_path}/b").collect()), key=str) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert link_vectors(df.limit(0), f"file://{tmp_path}/c").collect() == []


def test_recall_on_the_test_vectors(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
        got = sorted(map(tuple, op10_vectors(spark, folder).collect()))
        want = brute(rows)
        found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
        assert found >= 0.99 * all_ and all(g[1] <= w[1] for g, w in zip(got, want))
        assert sum(g != w for g, w in zip(got, want)) <= 0.01 * len(want)


def test_components(spark, tmp_path):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(500)] + [(2000 + i, 2000 + rng.randrange(400)) for i in range(400)]
    links += links[:50] + [(b, a) for a, b in links[100:200]] + [(5, 5)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.component for r in components(df, f"file://{tmp_path}").collect()}
    want = smallest_reachable({n for link in links for n in link}, links)
    assert got == {n: c for n, c in want.items() if n != c}
    a, b = forest(np.array([x for x, _ in links]), np.array([y for _, y in links]))
    assert dict(zip(a.tolist(), b.tolist())) == got
