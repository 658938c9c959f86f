import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from trapiche.llm.language import (
    fit_ftrl,
    fit_temperature,
    identify_languages,
    ngram_counts,
    softmax,
)

SYLLABLES = {
    "aa": ["bar", "tom", "lik", "san", "dor"],
    "bb": ["eé", "oui", "ça", "eau", "lle"],
    "cc": ["sch", "ung", "äu", "pfe", "ich"],
}


def corpus(size=300, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(size):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=3)) for _ in range(draw.randrange(3, 40))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy_and_edge_cases(documents):
    rows = corpus()
    edge = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", "bb"), (None, "eau oui", None)]
    clash = documents(rows + edge).withColumn("score", F.lit("own")).withColumn("found", F.lit(1))
    found = identify_languages(clash).collect()
    by_id = {r["doc_id"]: r for r in found}
    for own in (1000, 1001, 1002):
        assert (by_id[own]["lang_pred"], by_id[own]["score_"]) == ("und", 0.0)
    assert by_id[None]["held_out"] and by_id[None]["lang_pred"] == "bb"
    for own, _, lang in rows:
        r = by_id[own]
        assert r["held_out"] == (zlib.crc32(str(own).encode()) % 5 == 0)
        assert r["lang_pred"] == lang and 0.5 < r["score_"] <= 1


def test_held_out_labels_are_never_learned(documents):
    rows = corpus()
    poisoned = [
        (own, text, "zz" if zlib.crc32(str(own).encode()) % 5 == 0 else lang)
        for own, text, lang in rows
    ]
    clean = {r["doc_id"]: r["lang_pred"] for r in identify_languages(documents(rows)).collect()}
    other = {r["doc_id"]: r["lang_pred"] for r in identify_languages(documents(poisoned)).collect()}
    assert clean == other


def test_nothing_to_learn_from(documents):
    found = identify_languages(documents([(1, "some text", None), (2, "more", None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert identify_languages(documents([])).collect() == []


def test_counts_of_a_long_text_in_blocks(monkeypatch):
    text = "Ab c1d Éa, " * 500
    whole = ngram_counts(text)
    monkeypatch.setattr("trapiche.llm.language.BLOCK", 97)
    assert (ngram_counts(text) == whole).all()
    assert ngram_counts("12 34") is None and ngram_counts(None) is None


def test_elastic_net_leaves_noise_at_zero():
    draw = np.random.default_rng(2)
    rows = []
    for _ in range(400):
        label = int(draw.integers(2))
        noise = np.unique(draw.integers(2, 50, 5))
        rows.append((label, np.append([label], noise), np.ones(len(noise) + 1)))
    weights, _ = fit_ftrl(rows, 2, 50, l1=5.0)
    assert weights[0, 0] > 0 > weights[0, 1] and (weights[:, 2:] == 0).mean() > 0.8


def test_temperature_calibrates():
    draw = np.random.default_rng(3)
    odds = softmax(draw.normal(size=(3, 4_000)))
    labels = np.array([draw.choice(3, p=p) for p in odds.T])
    assert 0.8 < fit_temperature(np.log(odds) * 5, labels) / 5 < 1.25
