"""Piece ids against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tallybrook.llm import memory
from tallybrook.llm.pieces import PieceEncoder, encode_texts
from tallybrook.llm.queries import op8_pieces
from test_shingles import twins

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", "  ", "\t", "\n", "\r\n", "é", "😀", "▁", "ing", "12", "<s>", "</s>", "<0x0A>", " ", "　", "\x00", "́", "中文", "…", "​", "﻿", "�", "aaaa", "==", "//", "    "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(VOCABULARY)


def test_random_texts(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    assert [x.tolist() for x in encoder.encode_batch(texts)] == library.encode(texts)


def test_regular_words_have_ids_of_their_own(library):
    found = [x.tolist() for x in PieceEncoder(VOCABULARY).encode_batch(list(twins()))]
    assert found == library.encode(list(twins())) and found[0] != found[1]


def test_long_runs(encoder, library):
    for text in ("a" * 50_000, " " * 3000, "antidisestablishmentarianism" * 500, "x\n" * 20_000, "\n" * 500):
        assert encoder.encode(text) == library.encode(text)


def test_the_agenda_of_one_run_and_of_many_agree(encoder):
    rng = random.Random(4)
    runs = {"▁" + "".join(rng.choice("abcdefghinorstuéñ'.,") for _ in range(rng.randint(0, 20))) for _ in range(2000)}
    many = encoder.segment_short(sorted(runs))
    assert many == {r: encoder.segment(r) for r in many} and len(many) > 1500


def test_forgetting_and_small_groups_change_nothing(library, monkeypatch):
    monkeypatch.setattr(memory, "MOST", 50)
    monkeypatch.setattr(memory, "TOGETHER", 200)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(PARTS) + rng.choice(PARTS) for _ in range(30)) for _ in range(60)]
    encoder = PieceEncoder(VOCABULARY)
    assert [x.tolist() for x in encoder.encode_batch(texts)] == library.encode(texts)
    assert len(encoder.memory.keys) <= 50


def test_runs_with_one_equal_hash_are_told_apart(library, monkeypatch):
    real = memory.Substrings

    class Weak(real):
        def __init__(self, data, which=0):
            super().__init__(data, which)
            self.which = which

        def hash(self, start, end):
            found = super().hash(start, end)
            return found % np.uint64(7) if self.which == 0 else found

    monkeypatch.setattr(memory, "Substrings", Weak)
    encoder = PieceEncoder(VOCABULARY)
    texts = ["one two three", "four five six seven", "one nine ten two"]
    assert [x.tolist() for x in encoder.encode_batch(texts)] == library.encode(texts)


def test_a_differing_id_fails(monkeypatch):
    encoder = PieceEncoder(VOCABULARY)
    monkeypatch.setattr(encoder, "segment_short", lambda runs: {r: [5] for r in runs})
    with pytest.raises(AssertionError, match="differ"):
        encoder.encode("some words")


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "y"), (None, "a b", None), (3, "a b", "z"), (3, "a b", "z")],
        "doc_id long, text string, decoded string",
    )
    rows = encode_texts(docs, VOCABULARY).collect()
    assert len(rows) == 5
    assert {bytes(r.token_ids) for r in rows if not r.text} == {np.array([1, 2], "<u4").tobytes()}
    assert [r.decoded for r in rows if r.text] == ["a b"] * 3
    assert encode_texts(docs.limit(0), VOCABULARY).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op8_pieces(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
