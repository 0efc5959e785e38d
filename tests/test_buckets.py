"""Tables of buckets: what a batch rewrites, how they grow, two writers."""

from __future__ import annotations

import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.operators import upsert as module
from tallybrook.operators.upsert import committed_versions, read_version, upsert_table, version_files


def batch(spark, first, last, value):
    return spark.range(first, last).selectExpr("string(id) AS k", f"{value} AS v")


def files(tmp_path, folders):
    return {b: sorted(p.name for p in (tmp_path / "t" / f).iterdir()) for b, f in folders.items()}


def test_a_batch_rewrites_its_own_buckets_only(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    upsert_table(batch(spark, 0, 400, 1), root, ["k"], buckets=16)
    before = version_files(spark, root)
    names = files(tmp_path, before)
    assert sorted(before) == list(range(16))
    changes = batch(spark, 7, 9, 2).unionAll(batch(spark, 1000, 1001, 2))
    hit = {r[0] for r in changes.select(F.pmod(F.hash("k"), F.lit(16))).collect()}
    upsert_table(changes, root, ["k"])
    after = version_files(spark, root)
    assert {b for b in after if after[b] != before[b]} == hit
    kept = files(tmp_path, after)
    assert all(kept[b] == names[b] for b in after if b not in hit)
    expected = sorted([(str(i), 2 if i in (7, 8) else 1) for i in range(400)] + [("1000", 2)])
    assert rows(read_version(spark, root, keys=["k"])) == expected == rows(read_version(spark, root))
    # The version before is still whole.
    assert read_version(spark, root, below=2).where("v = 2").isEmpty()


def test_an_empty_batch_takes_all_buckets_over(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_table(batch(spark, 0, 0, 1), root, ["k"], buckets=4)
    assert read_version(spark, root, keys=["k"]).columns == ["k", "v"] and read_version(spark, root).isEmpty()
    upsert_table(batch(spark, 0, 50, 1), root, ["k"])
    before = version_files(spark, root)
    upsert_table(batch(spark, 0, 0, 1), root, ["k"])
    assert version_files(spark, root) == before and read_version(spark, root).count() == 50


def test_buckets_are_split_in_turn_and_joins_need_no_shuffle(spark, rows, tmp_path):
    """A table of 8 buckets grows over ten batches beyond twice as many."""
    root = str(tmp_path / "t")
    upsert_table(batch(spark, 0, 200, 0), root, ["k"], buckets=8)
    per_bucket = sum(module._newest(spark, root)[1].sizes.values()) // 8
    sizes, kept = [], []
    for turn in range(1, 11):
        before = version_files(spark, root)
        first = 200 + 90 * turn
        upsert_table(batch(spark, first - 90, first, turn).unionAll(batch(spark, turn, turn + 1, -1)), root, ["k"], bucket_bytes=per_bucket)
        state = module._newest(spark, root)[1]
        sizes.append((state.buckets, state.split))
        after = version_files(spark, root)
        kept.append(sum(after.get(b) == f for b, f in before.items()))
        table = read_version(spark, root, keys=["k"])
        got = rows(table)
        assert got == sorted((str(i), -1 if 1 <= i <= turn else 0 if i < 200 else (i - 200) // 90 + 1) for i in range(first))
        # Every row lies in the bucket that its hash names.
        for b, folder in after.items():
            there = spark.read.parquet(f"{root}/{folder}")
            assert there.where(state.bucket(["k"]) != b).isEmpty()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = table.join(batch(spark, 0, 5000, 9).withColumnRenamed("v", "w"), "k")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert joined.count() == first
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert "Exchange" not in plan[plan.index("SortMergeJoin") : plan.index("Bucketed: true")]
    assert sizes[-1][0] > 8 and any(s for _, s in sizes)
    assert sizes == sorted(sizes)


def test_files_outside_the_batch_survive_a_split(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_table(batch(spark, 0, 2000, 0), root, ["k"], buckets=8)
    before = version_files(spark, root)
    size = sum(module._newest(spark, root)[1].sizes.values())
    # Nine buckets are wanted: one split, and the one bucket that the key is in.
    upsert_table(batch(spark, 5, 6, 1), root, ["k"], bucket_bytes=-(-size // 9))
    after = version_files(spark, root)
    state = module._newest(spark, root)[1]
    assert (state.buckets, state.split) == (8, 1) and 8 in after
    assert sum(after.get(b) == f for b, f in before.items()) >= 6
    assert read_version(spark, root, keys=["k"]).count() == 2000


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 60), max_size=12, unique=True), min_size=1, max_size=4), st.integers(1, 4000))
def test_any_batches_against_a_dictionary(spark, rows, tmp_path_factory, batches, bucket_bytes):
    root = str(tmp_path_factory.mktemp("any"))
    expected = {}
    for turn, keys in enumerate(batches):
        df = spark.createDataFrame([(f"k{k}", k % 3, turn) for k in keys], "k string, part int, v int")
        upsert_table(df, root, ["k", "part"], buckets=2, bucket_bytes=bucket_bytes)
        expected |= {(f"k{k}", k % 3): turn for k in keys}
    assert rows(read_version(spark, root, keys=["k", "part"])) == sorted((*k, v) for k, v in expected.items())


def test_two_writers_lose_no_batch(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    upsert_table(batch(spark, 0, 20, 0), root, ["k"], buckets=4)
    both_read = threading.Barrier(2, timeout=60)
    real, first_time = module._written, threading.local()

    def together(*args):
        out = real(*args)
        if not getattr(first_time, "done", False):
            first_time.done = True
            # Both have written from the same version before either lists its own.
            both_read.wait()
        return out

    monkeypatch.setattr(module, "_written", together)
    made, failures = [], []

    def write(first):
        try:
            made.append(upsert_table(batch(spark, first, first + 15, 1), root, ["k"]))
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    threads = [threading.Thread(target=write, args=(f,)) for f in (10, 100)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures and sorted(made) == [2, 3]
    changed = {*range(10, 25), *range(100, 115)}
    assert rows(read_version(spark, root)) == sorted((str(i), int(i in changed)) for i in {*range(20), *changed})


def test_a_claim_that_is_never_listed_is_reported(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    upsert_table(batch(spark, 0, 5, 0), str(root), ["k"], buckets=2)
    (root / "_versions" / "0000000002.json").touch()
    monkeypatch.setattr(module, "PATIENCE", 0.2)
    with pytest.raises(TimeoutError, match="never listed"):
        upsert_table(batch(spark, 0, 5, 1), str(root), ["k"])
    assert committed_versions(spark, str(root)) == [1] and read_version(spark, str(root)).where("v = 1").isEmpty()


def test_folders_of_removed_versions_go(spark, tmp_path):
    root = tmp_path / "t"
    for turn in range(6):
        upsert_table(batch(spark, turn, turn + 3, turn), str(root), ["k"], buckets=4)
    assert committed_versions(spark, str(root)) == [5, 6]
    used = {f for v in (5, 6) for f in version_files(spark, str(root), v).values()}
    there = {f"rows/{p.parent.name}/{p.name}" for p in root.glob("rows/*/_bucket=*")}
    assert there == used
