"""CSV with line breaks in quotes, in small byte ranges, against the reader that takes a file in one task."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallybrook.sources import tables
from tallybrook.sources.records import range_parities, read_records
from tallybrook.sources.tables import BROKEN, IS_BROKEN, read_csv, read_multiline

FIELDS = ["", "a", "plain text", "two\nlines", 'a "quoted" word', '"', '""\n""', "comma, comma", "\n", "\n\n\n", "é\nü", "x" * 90, "long\n" * 30, "end\n", "cr\r\nlf"]


@pytest.fixture
def ranges(spark):
    """Ranges of 64 bytes, each a task."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "64"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def one_task(spark, folder, files):
    parts = [tables._files_of(spark, tables._header(spark, str(f)), [str(f)], multiline=True) for f in files]
    return tables._by_name(parts, str(folder))


def text_of(rows, header):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def test_equal_to_one_task(spark, ranges, rows, tmp_path):
    rng = random.Random(3)
    files = []
    for i, header in enumerate((["k", "b", "c"], ["c", "k", "extra\nname", "b"], ["k", "b", "c"])):
        made = [[f"{i}-{n}", *[rng.choice(FIELDS) for _ in header[1:]]] for n in range(12)]
        files.append(tmp_path / f"part {i}.csv")
        files[-1].write_bytes(text_of(made, header).encode())
    got, want = read_multiline(spark, str(tmp_path)), one_task(spark, tmp_path, files[:1] + files[2:])
    assert set(got.columns) == {"k", "b", "c", "extra\nname", BROKEN, IS_BROKEN}
    assert got.rdd.getNumPartitions() > 30
    assert rows(got.where("coalesce(c, '') NOT LIKE '1-%'"), *want.columns) == rows(want)
    # Python's reader agrees on the file whose column name has a line break.
    expected = list(csv.DictReader(io.StringIO(files[1].read_bytes().decode(), newline="")))
    found = rows(got.where("c LIKE '1-%'"), "c", "k", "`extra\nname`", "b")
    assert found == sorted(((e["c"], *[e[n] or None for n in ("k", "extra\nname", "b")]) for e in expected), key=lambda r: [(v is not None, str(v)) for v in r])


def test_broken_rows_blank_lines_and_returns(spark, ranges, rows, tmp_path):
    text = 'k,b\r\n1,"two\r\nlines"\r\n\r\n2,x,too much\r\n3\r\n"4","a ""b"" c"\r\n5,'
    (tmp_path / "a.csv").write_bytes(text.encode())
    got, want = read_multiline(spark, str(tmp_path)), one_task(spark, tmp_path, [tmp_path / "a.csv"])
    assert rows(got, "k", "b", IS_BROKEN) == rows(want, "k", "b", IS_BROKEN)
    assert rows(got.where(IS_BROKEN), BROKEN) == [("2,x,too much",), ("3",)]


def test_a_record_over_many_ranges(spark, ranges, rows, tmp_path):
    long = "line\n" * 60
    (tmp_path / "a.csv").write_text(f'k,b\n1,"{long}"\n2,y\n"3","z\n{long}"\n')
    assert rows(read_csv(spark, str(tmp_path), multiline=True), "k", "b") == [("1", long), ("2", "y"), ("3", f"z\n{long}")]


def test_a_file_that_ends_inside_quotes_is_read_whole(spark, ranges, rows, tmp_path):
    (tmp_path / "a.csv").write_text('k,b\n1,5" nail\n' + "".join(f"{i},y\n" for i in range(2, 30)))
    (tmp_path / "b.csv").write_text('k,b\n100,"x\ny"\n')
    got = read_multiline(spark, str(tmp_path))
    assert rows(got, "k", "b") == rows(one_task(spark, tmp_path, [tmp_path / "a.csv", tmp_path / "b.csv"]), "k", "b")


def test_header_only_and_none(spark, ranges, tmp_path):
    (tmp_path / "t").mkdir()
    with pytest.raises(FileNotFoundError):
        read_multiline(spark, str(tmp_path / "t"))
    (tmp_path / "t" / "a.csv").write_text("k,b\n")
    assert read_multiline(spark, str(tmp_path / "t")).collect() == []
    (tmp_path / "t" / "b.csv").write_text("k,k\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_multiline(spark, str(tmp_path / "t"))


def test_parities_and_records(spark, ranges, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('k,b\n' + "".join(f'{i},"{"m" * (i % 50)}\n{i}"\n' for i in range(20)))
    parities = range_parities(spark, [str(file)]).cache()
    data = file.read_bytes()
    # A range has the lines that begin behind its first byte, but for the first range.
    for r in parities.collect():
        begin = 0 if r.start == 0 else data.find(b"\n", r.start - 0) + 1
        assert (data[:begin].count(b'"') % 2 == 1) == r.opens
    records = read_records(spark, [str(file)], parities)
    assert records.where("is_first").select("record").collect()[0][0] == "k,b"
    assert records.count() == 21 and records.where(F.col("record").contains("\n")).count() == 20
