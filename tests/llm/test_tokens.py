"""Word ids against the tokenizers library, the coder as an exact round trip, and the files."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs as arrow_fs
from tokenizers import Tokenizer

from tallybrook.llm import memory, rans, tokenfile
from tallybrook.llm.queries import op6_tokens
from tallybrook.llm.words import WordEncoder
from test_shingles import twins

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'", "a", "the", " ", "  ", "\t", "\n", "é", "😀", "İ", "ing", "23", "<|startoftext|>", "</w>", " ", "\x00", "́", "中", "²", "½", "ª", "s", "t", "re", "ve", "ll", "d", "'s", "!", "!!", "\xad", "Σ", "Ā"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_random_texts(library):
    encoder = WordEncoder(VOCABULARY)
    assert encoder.split_here
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += ["word " * 30_000, "x" * 30_000, "'" * 100, ""]
    assert [x.tolist() for x in encoder.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_regular_words_have_ids_of_their_own(library):
    texts = [f"{w} and more" for w in twins()]
    found = [x.tolist() for x in WordEncoder(VOCABULARY).encode_batch(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts] and found[0] != found[1]


def test_characters_of_short_words_are_not_hashed(library, monkeypatch):
    hashed = []

    class Counted(memory.Substrings):
        def __init__(self, data, *base):
            hashed.append(len(data))
            super().__init__(data, *base)

    monkeypatch.setattr(memory, "Substrings", Counted)
    texts = ["It's a few short wordings, naïvely"] * 50 + ["extraordinarily", "abcdefgh abcdefg abcdefghi hgfedcba"]
    found = [x.tolist() for x in WordEncoder(VOCABULARY).encode_batch(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(hashed) == len("extraordinarily") + len("abcdefghi")


def test_short_words_are_told_apart():
    rng = random.Random(3)
    letters = "aab\u0249\u2c65"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    units, bounds = memory.joined_units(words)
    one, two = memory.short_names(units, bounds[:-1], bounds[1:])
    assert len(set(zip(words, one.tolist(), two.tolist()))) == len(set(words)) == len(set(zip(one.tolist(), two.tolist())))


def test_small_letters_outside_the_common_ones(library):
    texts = ["a\u023ab \u023e!", "\u023a\u023a\u0243"]
    found = [x.tolist() for x in WordEncoder(VOCABULARY).encode_batch(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_are_left_to_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = WordEncoder(path), Tokenizer.from_file(path)
    assert not encoder.split_here
    assert encoder.encode_batch(["It's a test"])[0].tolist() == library.encode("It's a test", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.integers(1, 5))
def test_round_trip(symbols, repeat):
    data = np.array(symbols * repeat, dtype=np.uint32)
    table = rans.Table.from_counts(np.bincount(data, minlength=301))
    table = rans.Table.from_bytes(table.to_bytes())
    assert np.array_equal(rans.decode(rans.encode(data, table), table), data)


def test_checkpoints_size_and_damage():
    rng = np.random.default_rng(1)
    data = np.minimum(rng.geometric(0.01, 300_000), 49_000).astype(np.uint32)
    counts = np.bincount(data, minlength=49_408)
    table = rans.Table.from_counts(counts)
    block = rans.encode(data, table)
    share = counts[counts > 0] / len(data)
    assert len(block) < 1.1 * (-(share * np.log2(share)).sum() * len(data) / 8)
    points = 300_000 // rans._lanes(300_000) // rans.CHECKPOINT_ROWS
    assert points >= 4
    for k in range(points):
        first = (k + 1) * rans.CHECKPOINT_ROWS * rans._lanes(300_000)
        assert np.array_equal(rans.decode(block, table, from_checkpoint=k), data[first:])
    with pytest.raises(IndexError):
        rans.decode(block, table, from_checkpoint=points)
    broken = bytearray(block)
    broken[len(block) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(bytes(broken), table)
    with pytest.raises(ValueError, match="table"):
        rans.encode(np.array([49_407]), table)


def test_tables_keep_rare_symbols():
    counts = np.ones(40_000, dtype=np.int64)
    counts[7] = 10**12
    table = rans.Table.from_counts(counts)
    assert table.freq.min() == 1 and table.freq.sum() == 1 << rans.SCALE
    assert np.array_equal(table.symbol[table.start.astype(np.int64)], np.arange(40_000))
    assert rans.Table.from_counts(np.zeros(5)).freq[0] == 1 << rans.SCALE


def expected(rows, library):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 50)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))) for i in rng.sample(range(10**6), 300)]
    rows += [(-5, None), (5, ""), (None, "no id"), (77, "again"), (77, "again")]
    folder = f"file://{tmp_path}/corpus"
    (tmp_path / "corpus").mkdir()
    tokenfile.write_corpus(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), folder, VOCABULARY, 2)
    out = tokenfile.read_corpus(spark, folder).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.crc32) for r in out), key=lambda r: r[1]) == expected(rows, library)
    assert all(zlib.crc32(r.ids) == r.crc32 for r in out)
    files = sorted((tmp_path / "corpus").glob("part-*.rans"))
    assert files and not list((tmp_path / "corpus").glob("_writing*"))
    files[0].write_bytes(files[0].read_bytes()[:-9] + b"123456789")
    with pytest.raises(Exception, match="damaged"):
        tokenfile.read_corpus(spark, folder).collect()


def test_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    folder = f"file://{tmp_path}/empty"
    tokenfile.write_corpus(spark.createDataFrame([], "doc_id long, text string"), folder, VOCABULARY, 2)
    assert tokenfile.read_corpus(spark, folder).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op6_tokens(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
    assert arrow_fs.FileSystem.from_uri("file:///tmp")
