"""From raw documents to token ids: the stages in their order, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.memory import bound_batches
from tallybrook.llm.mixing import take
from tallybrook.llm.pieces import encode_texts
from tallybrook.llm.private import redact
from tallybrook.llm.shingles import without_near_copies
from tallybrook.llm.toxicity import fit, score
from tallybrook.sources.tables import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents that score this or more are rejected as toxic.
LEAST_TOXIC = 0.5
VOCABULARY = "piece_bpe_32k.model"


def clean_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained from the labels of ``sf_dir``, doesn't take for toxic."""
    bound_batches(spark)
    classifier = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, classifier).where(F.col("toxicity") < LEAST_TOXIC).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, similarity of 0.8 or more."""
    bound_batches(spark)
    return without_near_copies(docs, shared_folder(spark))


def without_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text gives way to the name of its kind."""
    return redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document (little-endian 32-bit numbers, begin and end included), and what they decode to."""
    bound_batches(spark)
    rows = encode_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    n = (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens")
    return rows.select("doc_id", "lang", "source", n, "token_ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_only),
    ("near_copies", one_of_each),
    ("private", without_private),
    ("mixing", mixed),
    ("pieces", tokens),
]

#: Training of the classifier and the ids of the vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        written = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return STAGES[-1][1](spark, docs, sf_dir)
