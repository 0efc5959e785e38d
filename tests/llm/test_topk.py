"""Top-k against scoring everything."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tallybrook.llm import topk
from tallybrook.llm.queries import op7_topk
from tallybrook.llm.topk import SortedLists, search


def brute(rows, k=20):
    good = [(i, np.floor(64 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, x in good:
        if q % 20 or (q, tuple(x.tolist())) in asked:
            continue
        asked.add((q, tuple(x.tolist())))
        scored = sorted((-int(x @ y), i) for i, y in good if i != q and len(x) == len(y))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(60)] + [(1000, [0.0] * 6), (1001, [1.0, 2.0]), (1020, [3.0, -1.0])]
    rows += [(2000, None), (2020, [None] * 6), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6), (2080, []), (None, [1.0] * 6)]
    rows += [(40, rows[40][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, size string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == brute(rows)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 5)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0).collect())) == brute(rows)


def test_the_walk_ends_early_where_it_can():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 10, (5000, 2))
    vectors[:30] += 1000
    lists = SortedLists(np.arange(5000), vectors)
    query = np.array([3, 1])
    places, scores = lists.top(query, 20, -1)
    order = np.lexsort((np.arange(5000), -(vectors @ query)))[:20]
    assert places.tolist() == order.tolist() and scores.tolist() == (vectors @ query)[order].tolist()
    touched = []
    lists.vectors = type("Rows", (), {"__getitem__": lambda s, i: touched.append(len(i)) or vectors[i].astype(float), "dtype": np.dtype(float)})()
    lists.top(query, 20, -1)
    assert sum(touched) < 200


def test_only_the_bound_ends_the_walk():
    """Vectors like random ones: every candidate is met before the bound falls below the kth score, and the walk goes on until it does."""
    rng = np.random.default_rng(8)
    vectors = rng.integers(-9, 10, (3000, 16))
    lists = SortedLists(np.arange(3000), vectors)
    depths = []
    real = lists.order
    lists.order = type("Order", (), {"__getitem__": lambda s, at: depths.append(at[0].shape) or real[at]})()
    query = rng.integers(-9, 10, 16)
    places, scores = lists.top(query, 5, -1)
    whole = vectors @ query
    assert places.tolist() == np.lexsort((np.arange(3000), -whole))[:5].tolist()
    reached = sum(d[0] for d in depths)
    at = lambda depth: sum(int(q) * int(np.sort(vectors[:, d])[-depth if q > 0 else depth - 1]) for d, q in enumerate(query))
    assert at(reached) < scores[-1] <= at(reached - depths[-1][0])


def best_of(vectors, ids, query, own, k):
    allowed = np.flatnonzero(ids != own)
    scores = [sum(int(a) * int(b) for a, b in zip(query, v)) for v in vectors[allowed]]
    best = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[allowed[i]]))[:k]
    return allowed[best].tolist(), [scores[i] for i in best]


def test_queries_of_a_meeting_read_each_list_once():
    """Vectors like random ones: all queries walk far down, but the entries read don't grow with their number."""
    rng = np.random.default_rng(9)
    vectors, ids = rng.integers(-9, 10, (2000, 16)), np.arange(2000)
    queries = rng.integers(-9, 10, (200, 16))
    entries = []
    lists = SortedLists(ids, vectors)
    real = lists.order
    lists.order = type("Order", (), {"__getitem__": lambda s, at: entries.append(real[at].size) or real[at]})()
    got = {i: (places.tolist(), scores.tolist()) for i, places, scores in lists.tops(queries, 5, ids[:200])}
    assert sum(entries) <= 2 * vectors.size
    assert got == {i: best_of(vectors, ids, q, i, 5) for i, q in enumerate(queries)}


def test_a_batch_ends_early_where_it_can():
    rng = np.random.default_rng(10)
    vectors, ids = rng.integers(0, 10, (5000, 2)), np.arange(5000)
    vectors[:30] += 1000
    queries = rng.integers(1, 9, (50, 2))
    lists = SortedLists(ids, vectors)
    touched = []
    lists.vectors = type("Rows", (), {"__getitem__": lambda s, i: touched.append(len(i)) or vectors[i].astype(float), "dtype": np.dtype(float)})()
    got = {i: (places.tolist(), scores.tolist()) for i, places, scores in lists.tops(queries, 20, np.full(50, -1))}
    assert sum(touched) < 200
    assert got == {i: best_of(vectors, ids, q, -1, 20) for i, q in enumerate(queries)}


def test_a_batch_of_odd_queries(monkeypatch):
    """Queries of all types of numbers, without components, alone in their direction and with ids that repeat."""
    monkeypatch.setattr(topk, "TOGETHER", 7)
    monkeypatch.setattr(topk, "FEW", 2)
    rng = np.random.default_rng(11)
    for n in (1, 15, 400):
        vectors, ids = rng.integers(-64, 65, (n, 6)), rng.integers(0, 50, n)
        vectors[n // 2 :] = vectors[0]
        size = np.repeat([0, 1, 64, 640_000, 1 << 40, 1 << 62], 10)
        queries = np.array([[int(x) for x in rng.integers(-m, m + 1, 6)] for m in size], dtype=object)
        queries[10:15, 1:] = 0
        own = rng.integers(0, 50, len(queries))
        lists = SortedLists(ids, vectors)
        for some in (slice(0, 40), slice(0, 60)):
            asked = queries[some].astype(np.int64) if some.stop == 40 else queries
            got = {i: (ids[places].tolist(), scores.tolist()) for i, places, scores in lists.tops(asked, 20, own)}
            want = [best_of(vectors, ids, q, own[i], 20) for i, q in enumerate(asked)]
            assert got == {i: (ids[places].tolist(), scores) for i, (places, scores) in enumerate(want)}


def test_large_components_stay_exact():
    vectors = np.array([[1 << 27, 1], [1 << 27, 0], [-(1 << 27), 5]])
    places, scores = SortedLists(np.arange(3), vectors).top(np.array([1 << 27, 1]), 2, -1)
    assert places.tolist() == [0, 1] and scores.tolist() == [(1 << 54) + 1, 1 << 54]


def test_a_query_of_much_larger_norm_than_the_candidates(spark, monkeypatch):
    rng = np.random.default_rng(6)
    small = rng.integers(-64, 65, (400, 64))
    order = np.arange(400)
    for size in (64, 64_000, 640_000, 1 << 28):
        query = rng.integers(-size, size + 1, 64)
        places, scores = SortedLists(order, small).top(query, 20, -1)
        best = np.lexsort((order, -(small @ query)))[:20]
        assert places.tolist() == best.tolist() and scores.tolist() == (small @ query)[best].tolist()
    monkeypatch.setattr(topk, "CANDIDATES", 200)
    rows = [(i + 1, (v / 64).tolist()) for i, v in enumerate(small)] + [(500, (rng.integers(-640_000, 640_001, 64) / 64).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0).collect())) == brute(rows)


def test_components_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    rng = np.random.default_rng(7)
    rows = [(i, rng.integers(-300, 300, 5).astype(float).tolist()) for i in range(1, 120)]
    rows += [(200 + i, (rng.normal(size=5) * 10.0 ** rng.integers(6, 300)).tolist()) for i in range(30)]
    rows += [(300, [1.7e308] * 5), (301, [1.7e308] * 5), (302, [-1.7e308] * 5), (320, [5e6, 0.5, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * Fraction(x)) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:20]
        want += [(q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(map(tuple, search(df, F.col("vec_id") % 20 == 0).collect())) == sorted(want)
    # Many dimensions near the bound leave 64 bits, too.
    ends = SortedLists(np.arange(2), np.full((2, 256), 1 << 28)).top(np.full(256, 1 << 28), 2, -1)
    assert ends[0].tolist() == [0, 1] and ends[1].tolist() == [1 << 64] * 2


def test_no_rows(spark):
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op7_topk(spark, folder).collect())) == brute(rows)
