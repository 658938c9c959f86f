import random

import numpy as np
from pyspark.sql import functions as F

from trapiche.llm.toxicity import (
    FEATURES,
    fit_chain,
    fit_link,
    prior_shift,
    score_toxicity,
    train_chain,
)

CHAIN = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def corpus(size, seed):
    draw = random.Random(seed)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(size):
        text = draw.choices(words, k=draw.randrange(5, 80))
        junk, toxic = draw.random() < 0.3, draw.random() < 0.3
        if junk:
            text += ["click", "here"]
        if toxic:
            text.insert(draw.randrange(len(text)), draw.choice(["villain", "villains", "rotten"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus(1_200, 1)
    known = [x for x in labels if x[0] % 4] + [(5_000, 1, 1), (1, None, None), (None, 1, 1)]
    table = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    edge = [(9_000, None), (9_001, ""), (9_002, "!!"), (None, "villain rotten"), (9_003, "x " * 50_000 + "villain")]
    docs = documents(rows + edge).withColumn("flagged", F.lit("own")).withColumn("labels", F.lit(1))
    chain = train_chain(docs, table, CHAIN)
    found = {r["doc_id"]: r for r in score_toxicity(docs, chain).collect()}
    held = [(found[own]["flagged_"], bool(toxic)) for own, _, toxic in labels if own % 4 == 0]
    assert np.mean([a == b for a, b in held]) > 0.97
    junk = [(found[own]["p_low_quality"] > 0.5) == (not q) for own, q, _ in labels if own % 4 == 0]
    assert np.mean(junk) > 0.97
    for own in (9_000, 9_001, 9_002):
        assert found[own]["p_toxic"] == 0 and not found[own]["flagged_"]
    assert found[None]["flagged_"] and found[9_003]["flagged_"]


def test_later_links_use_earlier_probabilities():
    # The second category equals the first: only the chained probability tells it from words
    # that never repeat.
    draw = random.Random(3)
    rows = []
    for i in range(300):
        label = draw.randrange(2)
        rows.append((np.array([label, 10 + i]), [label, label]))
    chain = fit_chain(rows, ["a", "b"])
    assert chain.links[1].earlier[0] > 0
    assert len(chain.links[0].earlier) == 0


def test_out_of_fold_predictions(monkeypatch):
    seen = []

    def spy(rows, chained):
        seen.append((chained, len(rows)))
        return fit_link(rows, chained)

    monkeypatch.setattr("trapiche.llm.toxicity.fit_link", spy)
    fit_chain([(np.array([i % 2]), [i % 2, i % 2]) for i in range(10)], ["a", "b"], folds=5)
    assert seen == [(0, 10)] + [(0, 8)] * 5 + [(1, 10)] + [(1, 8)] * 5


def test_even_sample_does_not_raise_the_odds(spark, documents):
    assert prior_shift((10, 10), (90, 10)) == np.log(1 / 9)
    assert prior_shift((10, 0), (10, 0)) == 0
    rows, labels = corpus(400, 5)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = train_chain(documents(rows), table, CHAIN)
    part = train_chain(documents(rows), table, CHAIN, rows=80)
    assert whole.shifts == (0.0, 0.0) and part.shifts[1] < 0


def test_nothing_to_learn_from_and_empty_table(spark, documents):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert train_chain(documents([(1, "x")]), empty, CHAIN) is None
    rows, labels = corpus(60, 2)
    table = spark.createDataFrame(labels, empty.schema)
    chain = train_chain(documents(rows), table, CHAIN)
    assert score_toxicity(documents([]), chain).collect() == []
    assert chain.links[0].weights.shape == (FEATURES,)


def test_no_chain_scores_zero(documents):
    found = score_toxicity(documents([(1, "x")]), None, categories=("toxic",)).collect()
    assert [(r["p_toxic"], r["flagged"]) for r in found] == [(0.0, False)]


def test_an_id_that_repeats_is_collected_once(spark, documents, monkeypatch):
    """One labelled id in 20,000 rows: what reaches the driver stays within the bound."""
    rows, labels = corpus(60, 2)
    seen = []

    def spy(ready, categories):
        seen.append(len(ready))
        return fit_chain(ready, categories)

    monkeypatch.setattr("trapiche.llm.toxicity.fit_chain", spy)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    again = [(rows[0][0], f"copy {i}") for i in range(20_000)]
    train_chain(documents(rows + again), table, CHAIN, rows=40)
    assert 0 < seen[0] <= 40
