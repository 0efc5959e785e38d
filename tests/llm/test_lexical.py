"""Ranked lexical search against scoring every document in plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallybrook.llm import lexical
from tallybrook.llm.lexical import Best, Items, rank

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(CAPITALS) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    found = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in found]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for (i, c), size in zip(found, sizes):
            m = 25 + (75 * size * n) // length if length else 25
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item_id, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


DOCS = [
    (1, "The cat, the CAT and the dog"), (2, "Ärger über Öl – ÄRGER!"), (3, None), (4, ""), (5, "... --"), (None, "cat cat 7seven"),
    (6, "x" * 50_000 + " cat " + "dog " * 20_000), (7, "the cat"), (7, "the cat"), (8, "the dog"), (9, "a b c　d e_f"),
]
ITEMS = [(1, "cat"), (1, "the dog the dog"), (2, "ärger Ärger"), (3, None), (4, "?!"), (5, "unheard of"), (6, "cat dog the 7seven e f"), (6, "cat dog the 7seven e f"), (None, "a b")]


def frames(spark, docs, items):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, score int")
    return docs, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id int, text string, block int")


@pytest.mark.parametrize("tile", [(2_048, 512, 256), (2, 2, 3)])
def test_odd_texts(spark, monkeypatch, tile):
    for name, value in zip(("COLUMNS", "ITEMS", "ROWS"), tile):
        monkeypatch.setattr(lexical, name, value)
    got = rank(*frames(spark, DOCS, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(DOCS, ITEMS)


def test_ties_blocks_and_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 40)
    words = ["alpha", "beta", "gamma", "delta", "one", "two"]
    rng = np.random.default_rng(1)
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 5)))) for i in rng.permutation(400)]
    items = [(i, " ".join(rng.choice(words, 3))) for i in range(9)]
    d, q = frames(spark, docs, items)
    assert sorted(map(tuple, rank(d.repartition(7), q).collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    d, q = frames(spark, DOCS, ITEMS)
    assert rank(d.limit(0), q).collect() == [] and rank(d, q.limit(0)).collect() == []
    assert rank(d.where("doc_id = 3"), q).collect() == []


def test_sums_of_a_tile_stay_exact(monkeypatch):
    monkeypatch.setattr(lexical, "REPEATS", 1_000)
    monkeypatch.setattr(lexical, "EXACT", 10**12)
    text = b"often " * 4_500 + b" ".join(b"t%d" % i for i in range(300))
    items = Items.of([(1, text), (2, b"often t1")])
    weights = np.arange(1, 302)
    total = np.zeros((len(items.term_of), 2))
    for tile in items.tiles(weights):
        assert len(tile.columns) == 1 or tile.weights.sum(axis=0).max() * lexical.IMPACT < lexical.EXACT
        total[tile.columns, tile.items] += tile.weights
    by_term = np.zeros((301, 2))
    np.add.at(by_term, items.term_of, total)
    assert by_term[items.column[b"often"]].tolist() == [4_500 * weights[items.column[b"often"]], weights[items.column[b"often"]]]
    assert by_term[items.column[b"t1"]].tolist() == [weights[items.column[b"t1"]]] * 2


def test_very_frequent_repeats_give_the_same(spark, monkeypatch):
    items = [(1, "cat " * 25 + "dog " * 7), (2, "dog cat")]
    monkeypatch.setattr(lexical, "REPEATS", 10)
    assert sorted(map(tuple, rank(*frames(spark, DOCS, items)).collect()), key=str) == brute(DOCS, items)


def test_ties_with_the_last_rank_keep_the_smaller_id():
    best = Best(1, 2)
    for ids in ([9, 8, 7], [3, 5], [4]):
        best.add(np.full((len(ids), 1), 6), np.array(ids), np.zeros(len(ids), dtype=bool))
    assert best.rows[3].tolist() == [3, 4]
