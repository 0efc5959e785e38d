"""The classifier on held-out labels, and its defined cases."""

from __future__ import annotations

import zlib

import numpy as np

from tallybrook.llm import toxicity
from tallybrook.llm.queries import op5_toxicity
from tallybrook.llm.toxicity import Settings, telling, train


def auc(scores: np.ndarray, marks: np.ndarray) -> float:
    order = np.argsort(scores, kind="stable")
    place = np.empty(len(scores))
    place[order] = np.arange(len(scores))
    n = int(marks.sum())
    return (place[marks].sum() - n * (n - 1) / 2) / (n * (len(marks) - n))


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in op5_toxicity(spark, folder).collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    tested = [r for r in labels if rows[r.doc_id].held_out]
    scores = np.array([rows[r.doc_id].score for r in tested])
    marks = np.array([r.toxic == 1 for r in tested])
    assert auc(scores, marks) > 0.95
    assert (scores[~marks] >= 0.5).mean() < 0.03
    assert (scores[marks] >= 0.5).mean() > 0.85


def test_features_are_letters_in_lower_case():
    assert set(toxicity.features("Bad, WORDS!! bad")) == set(toxicity.features("words bad"))
    assert len(toxicity.features(None)) == len(toxicity.features("")) == len(toxicity.features("12 ,;")) == 0


def test_held_out_labels_do_not_count(spark):
    docs = spark.createDataFrame([(i, f"nice text {i}" + " vile" * (i % 3 == 0)) for i in range(600)], "doc_id long, text string")
    out = {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    truth = [(i, int(i % 3 == 0)) for i in range(600)]
    lies = [(i, 1 - t if i in out else t) for i, t in truth]
    schema = "doc_id long, toxic int"
    first = toxicity.fit(docs, spark.createDataFrame(truth, schema))
    second = toxicity.fit(docs, spark.createDataFrame(lies, schema))
    assert np.array_equal(first.weights, second.weights) and first.bias == second.bias
    assert first.score("some vile words") > 0.5 > first.score("nice text")


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (2, "", 1.0), (None, "x", 1.0), (3, "vile " * 100_000, 1.0), (3, "vile " * 100_000, 1.0)],
        "doc_id long, text string, toxicity double",
    )
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.toxicity < 1e-6 for r in rows)
    odd = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (2, None), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, odd)
    assert all(0 <= r.toxicity <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_training_follows_the_gradient_of_the_risk():
    """Every step against numeric slopes of the risk as it is written down, for features as a table of zeros and ones."""
    rng = np.random.default_rng(3)
    prior, settings = 0.2, Settings(steps=25, least_z=0.0)
    draw = lambda n, chance: [np.flatnonzero(rng.random(12) < chance).astype(np.uint32) for _ in range(n)]
    confirmed, unlabelled = draw(40, np.linspace(0.9, 0.1, 12)), draw(90, np.linspace(0.3, 0.4, 12))
    model = train(confirmed, unlabelled, prior, settings)

    keys = telling(confirmed, unlabelled, 0.0)
    table = lambda rows: np.array([[float(k in set(r.tolist())) for k in keys] for r in rows])
    p, u = table(confirmed), table(unlabelled)

    def parts(w):
        z_p, z_u = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        toxic = prior * np.log1p(np.exp(-z_p)).mean()
        return toxic, np.log1p(np.exp(z_u)).mean() - prior * np.log1p(np.exp(z_p)).mean()

    def slope(f, w, step=1e-6):
        return np.array([(f(w + step * e) - f(w - step * e)) / (2 * step) for e in np.eye(len(w))])

    w = np.append(np.zeros(len(keys)), np.log(prior / (1 - prior)))
    first, second, reversed_steps = np.zeros(len(w)), np.zeros(len(w)), 0
    for step in range(1, settings.steps + 1):
        if parts(w)[1] >= 0:
            grad = slope(lambda v: sum(parts(v)), w)
        else:
            grad = slope(lambda v: -parts(v)[1], w)
            reversed_steps += 1
        grad += settings.decay * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w = w - settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    assert (model.keys == keys).all()
    assert np.allclose(model.weights, w[:-1], atol=1e-4) and abs(model.bias - w[-1]) < 1e-4


def test_a_prior_above_one_half_counts():
    rng = np.random.default_rng(4)
    confirmed = [np.array([1, 2], dtype=np.uint32)] * 30
    unlabelled = [np.array([1, 2], dtype=np.uint32) if rng.random() < 0.8 else np.array([3], dtype=np.uint32) for _ in range(100)]
    low, high = (train(confirmed, unlabelled, prior) for prior in (0.5, 0.8))
    assert high.bias != low.bias
