"""Mixing against the same rules in Python."""

from __future__ import annotations

from collections import Counter, defaultdict

from tallybrook.llm.mixing import mix, source_targets, take


def fill(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped: set = set()
    while True:
        open_ = [s for s in names if s not in stopped]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in stopped else level * weight[s] for s in names}
        stopped |= more


def test_targets_fill_up(spark):
    for sizes in ({"a": 10, "b": 1, "ü": 1000, "c": 7, None: 3, "Z": 0}, {"a": 5}, {"a": 0, "b": 0}, {None: 4, "x": 4000}):
        df = spark.createDataFrame(list(sizes.items()), "source string, words long")
        got = {r.source: r.target for r in source_targets(df, "source", "words").collect()}
        want = fill(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in want)


def test_mix_of_uneven_sources(spark):
    rows = [(i, "w " * (i % 50), "hot" if i % 3 else f"s{i % 7}", i) for i in range(6000)]
    rows += [(9000 + i, "same text here", "copies", 0) for i in range(500)] + [(9999, "twice", None, 0)] * 2
    rows += [(None, None, None, 0), (10_000, "", "hot", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mix(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    sizes, taken, target, most = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        most[r.source] = max(most[r.source], r.size)
        assert 0 <= r.copies <= 3
    assert target == fill(dict(sizes))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 6 * most[s] + 1
    again = mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_taken_rows_keep_the_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 1), (2, "c", "y", 2), (3, None, None, 3)], "doc_id long, text string, source string, copies int")
    rows = take(docs).collect()
    assert take(docs).columns == docs.columns
    assert Counter(r.doc_id for r in rows) == {r.doc_id: r.copies for r in mix(docs).collect() if r.copies}


def test_columns_of_any_name_come_back_as_they_were(spark):
    names = ["size", "_hash", "_source", "_class", "_slice", "_rank", "_kept", "_id", "_copy", "copies", "target", "whole", "col"]
    docs = spark.createDataFrame([(i, "a b c"[: i % 6], "xyz"[i % 3], *[f"{n}{i}" for n in names]) for i in range(60)], ["doc_id", "text", "source", *names])
    by_id = {r.doc_id: tuple(r) for r in docs.collect()}
    out = take(docs)
    assert out.columns == docs.columns and all(tuple(r) == by_id[r.doc_id] for r in out.collect())
    replaced = {"size", "source_size", "target", "copies"}
    mixed = mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in replaced] + ["size", "source_size", "target", "copies"]
    assert all(r._hash == f"_hash{r.doc_id}" and r._kept == f"_kept{r.doc_id}" for r in mixed.collect())


def test_no_rows(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
