"""The stages one after another, each held against its own rules on what it is given."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from tallybrook.llm.mixing import mix
from tallybrook.llm.toxicity import fit
from test_private import plain as spans_of
from test_shingles import brute as near_copies

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "private", "mixing", "pieces"]
    given, tables = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs.collect()
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{name}")
        tables[name] = docs
        assert name == "pieces" or docs.columns == columns
    out = {n: t.collect() for n, t in tables.items()}

    model = fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = {r for r in given["toxicity"] if model.score(r.text) < 0.5}
    assert set(out["toxicity"]) == clean and 0.8 < len(clean) / len(given["toxicity"]) < 1

    kept = {i for i, _, _, first in near_copies([(r.doc_id, r.text) for r in given["near_copies"]], k=5) if first}
    assert {r.doc_id for r in out["near_copies"]} == kept and len(out["near_copies"]) == len(kept)

    before = {r.doc_id: r.text for r in given["private"]}
    assert len(out["private"]) == len(before)
    changed = [r for r in out["private"] if r.text != before[r.doc_id]]
    assert changed and all(re.search(r"\[(EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", r.text) for r in changed)
    assert all(spans_of(r.text) == "" for r in out["private"] if r not in changed)
    assert all(r.n_chars == len(r.text) for r in out["private"])

    copies = {r.doc_id: r.copies for r in mix(tables["private"]).collect()}
    assert Counter(r.doc_id for r in out["mixing"]) == {i: n for i, n in copies.items() if n}

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in out["mixing"]}
    assert len(out["pieces"]) == len(out["mixing"])
    for r in out["pieces"]:
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert bytes(r.token_ids) == np.array(ids, "<u4").tobytes() and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids)

    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(map(str, again)) == Counter(map(str, out["pieces"]))


def test_no_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
