"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained in numpy from
texts confirmed as toxic and from unlabelled text. With a class prior the risk on
the unseen clean class can be estimated from both, and is kept from going below
zero, where a classifier would only learn the confirmed texts by heart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.hashing import LOWER, NO_LETTER, Substrings, as_bytes, runs
from tallybrook.llm.memory import small_slices

#: Bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: Training is bounded: at most so many confirmed texts, and about as many unlabelled ones.
MOST_CONFIRMED = 4_000
MOST_UNLABELLED = 16_000
#: Rows with this remainder of crc32(id as text) modulo FOLDS are held out from training.
FOLDS, HELD_OUT = 5, 0


@dataclass(frozen=True)
class Settings:
    steps: int = 400
    rate: float = 0.05
    decay: float = 5e-4
    #: A feature takes part if its shares among confirmed and unlabelled texts differ by so many standard errors.
    least_z: float = 4.0


@dataclass(frozen=True)
class Classifier:
    """Weights of the features that tell something, by sorted feature; all others weigh nothing."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Between 0 and 1; the higher, the likelier toxic."""
        z = float(self.weights[find(self.keys, features(text))].sum()) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0))))


def features(text: str | None) -> np.ndarray:
    """Distinct hashed words and beginnings of words, sorted; letters only, ASCII in lower case."""
    data = LOWER[as_bytes(text)]
    start, end = runs(data, NO_LETTER)
    if not len(start):
        return np.zeros(0, dtype=np.uint32)
    sub = Substrings(data)
    parts = [sub.hash(start, end)]
    for n in BEGINNINGS:
        long = end - start > n
        # Of another kind than the word of the same letters.
        parts.append(sub.hash(start[long], start[long] + n) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique((np.concatenate(parts) >> np.uint64(32)).astype(np.uint32))


def find(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places in the sorted ``keys`` of those ``found`` that are among them."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return at[keys[at] == found]


def telling(confirmed: list[np.ndarray], unlabelled: list[np.ndarray], least_z: float) -> np.ndarray:
    """Features with clearly different shares among confirmed and unlabelled texts, sorted."""
    keys, p = np.unique(np.concatenate(confirmed), return_counts=True)
    others, u = np.unique(np.concatenate(unlabelled), return_counts=True)
    every = np.union1d(keys[p > 1], others[u > 1])
    shares = []
    for names, counts, rows in ((keys, p, confirmed), (others, u, unlabelled)):
        at = np.minimum(np.searchsorted(names, every), max(0, len(names) - 1))
        count = np.where(names[at] == every, counts[at], 0) if len(names) else np.zeros(len(every))
        # Half a text more on either side keeps rare features from looking certain.
        shares.append((count + 0.5) / (len(rows) + 1))
    p, u = shares
    both = (p * len(confirmed) + u * len(unlabelled)) / (len(confirmed) + len(unlabelled))
    error = np.sqrt(both * (1 - both) * (1 / len(confirmed) + 1 / len(unlabelled)))
    return every[np.abs(p - u) > least_z * error]


def train(confirmed: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, settings: Settings = Settings()) -> Classifier:
    """Minimise prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)) with logistic losses.

    ``prior`` is the share of toxic texts among the unlabelled ones. Each step
    sees all texts. Where the corrected risk of the clean class is negative, the step
    goes the other way for that part, as the non-negative estimator has it. Without
    confirmed texts nothing can be learned; every score is then near zero.
    """
    if not confirmed or not unlabelled:
        return Classifier(np.zeros(0, dtype=np.uint32), np.zeros(0), -30.0)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    keys = telling(confirmed, unlabelled, settings.least_z)
    confirmed = [find(keys, f) for f in confirmed]
    unlabelled = [find(keys, f) for f in unlabelled]
    weights = np.zeros(len(keys))
    rows = [*confirmed, *unlabelled]
    n_p, n_u = len(confirmed), len(unlabelled)
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    first, second = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    slope = np.empty(len(rows))
    for step in range(1, settings.steps + 1):
        z = np.bincount(owner, weights[flat], len(rows)) + bias
        s = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        # Losses log(1 + exp(-z)) for toxic and log(1 + exp(z)) for clean; their slopes are s - 1 and s.
        clean_loss = np.logaddexp(0, z)
        corrected = clean_loss[n_p:].mean() - prior * clean_loss[:n_p].mean()
        if corrected >= 0:
            slope[:n_p] = prior * ((s[:n_p] - 1) - s[:n_p]) / n_p
            slope[n_p:] = s[n_p:] / n_u
        else:
            slope[:n_p] = prior * s[:n_p] / n_p
            slope[n_p:] = -s[n_p:] / n_u
        grad = np.append(np.bincount(flat, slope[owner], len(keys)) + settings.decay * weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        move = settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        weights = weights - move[:-1]
        bias -= float(move[-1])
    return Classifier(keys, weights, bias)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; NULL ids are held out, too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def _dice(doc_id: Column) -> Column:
    """A number from 0 to 1 that hangs on the id alone."""
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _one_text(rows: DataFrame) -> DataFrame:
    """One text for each id, so that an id that many rows repeat is in the sample once."""
    return rows.groupBy("doc_id").agg(F.min("text").alias("text")).select("text")


def _collect_features(rows: DataFrame) -> list[np.ndarray]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in small_slices(batch, 0):
                found = [features(t).tobytes() for t in few.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["features"])

    collected = rows.mapInArrow(encode, "features binary").collect()
    # In an order of their own: training mustn't hang on which task was first.
    return [np.frombuffer(b, dtype=np.uint32) for b in sorted(bytes(r.features) for r in collected)]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Labels of held-out ids are not read. The sample is bounded by MOST_CONFIRMED
    and MOST_UNLABELLED, chosen by a hash of the id; only its features come to the
    driver. The class prior is the share of toxic rows among all labelled ones
    that aren't held out. Doubly labelled ids count as toxic if any row says so;
    NULL labels and ids are left out.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not seen["toxic"]:
        return train([], [], 0.0)
    ids = known.where("toxic = 1").orderBy(_dice(F.col("doc_id")), "doc_id").limit(MOST_CONFIRMED).select("doc_id")
    texts = docs.select("doc_id", "text")
    # MOST_CONFIRMED ids at most: small whatever the corpus.
    confirmed = _collect_features(_one_text(texts.join(F.broadcast(ids), "doc_id", "left_semi")))
    share = MOST_UNLABELLED / max(1, docs.count())
    others = texts.where(~held_out(F.col("doc_id")) & (_dice(F.col("doc_id")) < share))
    unlabelled = _collect_features(_one_text(others))
    return train(confirmed, unlabelled, seen["toxic"] / seen["n"], settings)


def score(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``toxicity``, the score of the whole text.

    Defined cases: a NULL or empty text has the score of a text without words. A
    column ``toxicity`` of ``docs`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kept = docs.drop("toxicity")

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            # A slice of texts at a time leaves Arrow for Python.
            slices = small_slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0)
            found = [model.score(t) for few in slices for t in few.column(0).to_pylist()]
            yield pa.array(found, pa.float64())

    return kept.select("*", scores(F.col(text)).alias("toxicity"))
