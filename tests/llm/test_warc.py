"""Archives as an exact round trip, and against the rules in Python."""

from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard
from compare import connect, difference

from tallybrook.llm import oracle, warc
from tallybrook.llm.queries import op3_warc

ROWS = [
    (5, "http://a/5", "<p>same</p>"),
    (3, "http://a/3\r\nX: y", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (7, "http://a/é", "ö\r\n\r\nWARC/1.1\r\n"),
    (1, "u", None),
    (2, "u", ""),
    (4, "u", "x" * 3_000_000),
    (8, "u", "dup"),
    (8, "u", "dup"),
    (None, "u", "dup"),
    (None, "u", "alone"),
]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "") if len(data) >= least else None
        revisit = to is not None and to != i
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), sha, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, tmp_path, least, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 700)
    folder = f"file://{tmp_path}"
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    warc.write_archive(pages, folder, least)
    out = warc.read_archive(spark, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == expected(ROWS, least)
    for r in out:
        if r.record_type == "response" and r.page_id not in (None, 8):
            assert bytes(r.payload).decode() == next(h or "" for i, _, h in ROWS if i == r.page_id)
    headers, _, payload = warc.parse(warc.find_record(spark, folder, 7))
    assert payload.decode() == ROWS[3][2] and headers["warc-target-uri"] == "http://a/é"
    with pytest.raises(KeyError):
        warc.find_record(spark, folder, 12345)


def test_bundles_are_plain_zstandard(spark, tmp_path):
    warc.write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}")
    files = list(tmp_path.glob("*.warc.zst"))
    plain = b"".join(zstandard.ZstdDecompressor().stream_reader(f.open("rb"), read_across_frames=True).read() for f in files)
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    bad = files[0]
    data = bytearray(bad.read_bytes())
    data[20] ^= 255
    bad.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged|Error|error"):
        warc.read_archive(spark, f"file://{tmp_path}").collect()


def test_no_rows(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}")
    assert warc.read_archive(spark, f"file://{tmp_path}").collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    out = op3_warc(spark, folder)
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected(rows)


def test_read_back_in_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    monkeypatch.setattr(warc, "READ_BYTES", 10_000)
    rows = [(i, f"http://a.org/{i}", f"<p>{i}" * 100) for i in range(200)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}")
    read = warc.read_archive(spark, f"file://{tmp_path}")
    assert read.rdd.getNumPartitions() > 4 and sorted(r.page_id for r in read.collect()) == list(range(200))


def test_a_payload_in_a_third_of_all_pages_is_split(spark, tmp_path):
    """The join that sends pages to their archive splits the rows of a payload that many share."""
    names = ("adaptive.skewJoin.skewedPartitionThresholdInBytes", "adaptive.advisoryPartitionSizeInBytes", "adaptive.skewJoin.skewedPartitionFactor", "autoBroadcastJoinThreshold", "shuffle.partitions")
    before = {n: spark.conf.get(f"spark.sql.{n}") for n in names}
    try:
        for n, v in zip(names, ("20k", "20k", "1.5", "-1", "16")):
            spark.conf.set(f"spark.sql.{n}", v)
        html = "CASE WHEN id % 3 = 0 THEN repeat('hot', 300) ELSE string(rand(5)) || repeat(string(rand(id)), 40) END"
        pages = spark.range(0, 6_000, 1, 8).selectExpr("id AS page_id", "'http://a.org' AS url", f"{html.replace('rand(id)', 'rand(6)')} AS html")
        pages.write.parquet(f"{tmp_path}/pages")
        dealt = warc.dealt_pages(spark.read.parquet(f"{tmp_path}/pages"), f"file://{tmp_path}")
        dealt.collect()
        assert "skew=true" in dealt._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.set(f"spark.sql.{n}", v)
