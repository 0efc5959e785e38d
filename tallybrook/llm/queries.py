"""The operators of this package as queries over the test tables; each returns the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.article import extract_text
from tallybrook.llm.lexical import rank
from tallybrook.llm.memory import bound_batches
from tallybrook.llm.mixing import mix
from tallybrook.llm.pieces import digest_texts
from tallybrook.llm.private import BASE, find_private, span_list
from tallybrook.llm.repeats import cut_repeats
from tallybrook.llm.shingles import group
from tallybrook.llm.tokenfile import read_corpus, write_corpus
from tallybrook.llm.toxicity import fit, held_out, score
from tallybrook.llm.topk import search
from tallybrook.llm.variants import group_variants
from tallybrook.llm.vectors import link_vectors
from tallybrook.llm.warc import read_archive, write_archive
from tallybrook.sources.tables import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_repeats(spark: SparkSession, root: str) -> DataFrame:
    cut = cut_repeats(table(spark, root, "documents").select("doc_id", "text"), shared_folder(spark))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_shingles(spark: SparkSession, root: str) -> DataFrame:
    return group(table(spark, root, "documents").select("doc_id", "text"), shared_folder(spark), words=2)


def op3_warc(spark: SparkSession, root: str) -> DataFrame:
    folder = shared_folder(spark)
    write_archive(table(spark, root, "pages"), folder)
    return read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_mixing(spark: SparkSession, root: str) -> DataFrame:
    mixed = mix(table(spark, root, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, root, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op6_tokens(spark: SparkSession, root: str) -> DataFrame:
    folder = shared_folder(spark)
    write_corpus(table(spark, root, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_corpus(spark, folder).select("doc_id", "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


def op7_topk(spark: SparkSession, root: str) -> DataFrame:
    return search(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_pieces(spark: SparkSession, root: str) -> DataFrame:
    return digest_texts(table(spark, root, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_private(spark: SparkSession, root: str) -> DataFrame:
    found = find_private(table(spark, root, "documents").select("doc_id", "text"))
    counts = [F.expr(f"bigint(size(filter(spans, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in BASE]
    base = F.sha2(span_list("spans", base_only=True).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, span_list("spans").alias("spans"))


def op10_vectors(spark: SparkSession, root: str) -> DataFrame:
    return link_vectors(table(spark, root, "embeddings"), shared_folder(spark))


def op11_variants(spark: SparkSession, root: str) -> DataFrame:
    return group_variants(table(spark, root, "documents"), shared_folder(spark))


def op12_lexical(spark: SparkSession, root: str) -> DataFrame:
    return rank(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op13_article(spark: SparkSession, root: str) -> DataFrame:
    return extract_text(table(spark, root, "pages"), shared_folder(spark))


def queries() -> dict[str, Query]:
    found = (
        op1_repeats, op2_shingles, op3_warc, op4_mixing, op5_toxicity, op6_tokens, op7_topk,
        op8_pieces, op9_private, op10_vectors, op11_variants, op12_lexical, op13_article,
    )
    return {f.__name__: f for f in found}
