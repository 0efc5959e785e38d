"""Spelling variants against comparing every two words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import variants
from tallybrook.llm.variants import group_variants, near_rows, near_words
from tallybrook.sources.tables import shared_folder

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def is_near(a, b):
    return abs(len(a) - len(b)) <= 1 and distance(a, b) == 1


def brute(docs):
    counts = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out, key=str)


def found(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, word string, n int, root int")
    got = group_variants(df, shared_folder(spark))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, got.collect()), key=str)


def some_words(rng, alphabet, count):
    made = {"".join(rng.choice(list(alphabet), rng.integers(7, 11))) for _ in range(count)}
    for w in sorted(made)[::3]:
        i = int(rng.integers(0, len(w)))
        made |= {w[:i] + w[i + 1 :], w[:i] + "é" + w[i:], w[:i] + "b" + w[i + 1 :]}
    return sorted(w for w in made if len(w) >= 7)


def test_odd_texts(spark):
    words = ["grammar", "grammaire", "grammär", "grammaÿr", "gram×mar", "GRAMMAR", "GrÄmmar", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "z" * 3000, "z" * 3001]
    docs = [(i, " ".join(words[i % 5 :] * (1 + i % 3))) for i in range(40)]
    docs += [(100, None), (101, ""), (None, "grammar, grammar; nowhere"), (102, "grammar" * 2000), (3, docs[3][1]), (3, docs[3][1]), (103, "grammer grammers grammer grammers" + " grammer" * 70)]
    docs += [(104, "commonword " * 3000), (105, "commonwrd " * 250), (106, "commonwr " * 20), (107, "commnwr " * 2)]
    assert found(spark, docs) == brute(docs)


def test_without_words(spark):
    assert found(spark, [(1, None), (2, "so few"), (3, "singleword")]) == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert group_variants(empty, shared_folder(spark)).collect() == []


@pytest.mark.parametrize("cells", [65_536, 60, 1])
def test_groups_dealt_anew(spark, monkeypatch, cells):
    monkeypatch.setattr(variants, "CELLS", cells)
    monkeypatch.setattr(variants, "WALKED", 500)
    words = some_words(np.random.default_rng(2), "ab", 250)
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = [tuple(r) for r in near_words(df, shared_folder(spark)).collect()]
    assert len(got) == len(set(got))
    n = {w: i + 2 for i, w in enumerate(words)}
    assert sorted(got) == sorted((a, b, n[b]) for a in words for b in words if is_near(a, b))


def test_one_list_holds_most_words(spark, monkeypatch):
    """A third of all words and more share their first half, others their last."""
    monkeypatch.setattr(variants, "CELLS", 300)
    rng = np.random.default_rng(3)
    tails = some_words(rng, "abc", 150)
    words = sorted({"common" + t[:6] for t in tails} | {t[:7] + "ending" for t in tails})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long").repartition(5)
    got = sorted(tuple(r) for r in near_words(df, shared_folder(spark)).collect())
    assert got == sorted((a, b, 2) for a in words for b in words if is_near(a, b))


def test_walk_over_a_list():
    rng = np.random.default_rng(4)
    for size in (1, 2, 4):
        words = sorted({"".join(rng.choice(list("abc"), size + int(rng.integers(0, 2)))) for _ in range(60)})
        group = np.zeros(len(words), dtype=int)
        sizes = np.array([len(w) for w in words])
        middle = variants._matrix(pa.array(words), np.zeros(len(words), dtype=int), sizes)
        got = sorted(zip(*(x.tolist() for x in near_rows(middle, sizes, group + size, group))))
        least = size
        expected = [
            (i, j) for i, a in enumerate(words) for j, b in enumerate(words)
            if len(a) == least and is_near(a, b) and (len(b) > least or i < j)
        ]
        assert got == sorted(expected)
