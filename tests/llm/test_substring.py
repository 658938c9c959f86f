import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trapiche.llm.substring import drop_repeated_windows
from trapiche.llm.windows import minimisers, runs_of, window_names, word_hashes


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, window):
    first = {}
    words = [(own, split(text or "")) for own, text in rows]
    for own, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, own), own)
    result = []
    for own, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < own:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        result.append((own, len(w), len(w) - len(kept), " ".join(kept)))
    return sorted(result)


def rows_of(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    passages = [draw.choices(words, k=draw.choice([6, 9, 20])) for _ in range(4)]
    rows = []
    for _ in range(60):
        text = draw.choices(words, k=draw.randrange(30))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(text) + 1)
            text[at:at] = draw.choice(passages)
        rows.append((draw.randrange(10_000), draw.choice([" ", "\n", " \t"]).join(text)))
    rows = list(dict(rows).items())
    edge = [None, "", " ", "x " * 3_000, "x " * 3_001, "é\xa0ü " * 8, "é\xa0ü " * 9]
    return rows + [(20_000 + i, t) for i, t in enumerate(edge)]


@pytest.mark.parametrize("hot", [1, 3, 1_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed, hot):
    rows = rows_of(seed)
    found = drop_repeated_windows(
        documents(rows), window=6, minimiser_words=2, hot_documents=hot
    ).collect()
    names = ("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(tuple(r[n] for n in names) for r in found) == brute(rows, 6)
    for r in found:
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]


def test_rows_that_repeat_and_rows_without_id(documents):
    text = " ".join(f"w{i}" for i in range(8))
    rows = [(2, text), (2, text), (None, text), (None, text), (5, f"a {text} b")]
    for hot in (1, 1_000):
        found = drop_repeated_windows(documents(rows), window=6, hot_documents=hot).collect()
        assert sorted((r["doc_id"] or 9, r["kept_text"]) for r in found) == [
            (2, text), (2, text), (5, "a b"), (9, ""), (9, ""),
        ]


def test_empty_table_short_texts_and_clashing_names(documents):
    assert drop_repeated_windows(documents([])).collect() == []
    clash = documents([(1, "a b"), (2, "a b")])
    for name in ("id", "mark", "spans", "minimiser", "shared"):
        clash = clash.withColumn(name, F.lit("own"))
    found = drop_repeated_windows(clash).collect()
    assert [(r["n_words"], r["n_removed"]) for r in found] == [(2, 0), (2, 0)]


def test_word_hashes_do_not_depend_on_place_or_block(monkeypatch):
    text = ("alpha\tbeta " * 50 + "x" * 40).encode()
    whole = word_hashes(text)
    assert len(whole) == 101 and len(set(whole.tolist())) == 3
    monkeypatch.setattr("trapiche.llm.windows.BLOCK_BYTES", 7)
    assert (word_hashes(text) == whole).all()


def test_minimisers_names_and_runs():
    draw = np.random.default_rng(5)
    hashes = draw.integers(0, 2**63, 200).astype(np.uint64)
    single = minimisers(hashes, 1, 1)
    slid = minimisers(hashes, 13, 1)
    assert all(slid[i] == single[i : i + 13].min() for i in range(len(slid)))
    words = draw.integers(0, 3, 300)
    names = window_names(words, 7)
    seen = {}
    for i, name in enumerate(names.tolist()):
        assert seen.setdefault(name, tuple(words[i : i + 7])) == tuple(words[i : i + 7])
    assert len(seen) == len(set(seen.values()))
    starts, lengths = runs_of(np.array([4, 4, 5, 4]))
    assert starts.tolist() == [0, 2, 3] and lengths.tolist() == [2, 1, 1]


def test_long_texts_of_one_minimiser(documents):
    """Repeated words give one minimiser very many windows: they are settled by digest."""
    rows = [(i, f"w{i} " + "a " * 3_000 + f"v{i}") for i in range(40)]
    rows += [(100, "b " * 70 + "a " * 60), (101, "b " * 70)]
    expected = brute(rows, 50)
    for hot_windows in (1_000, 10**9):
        found = drop_repeated_windows(documents(rows), hot_windows=hot_windows).collect()
        names = ("doc_id", "n_words", "n_removed", "kept_text")
        assert sorted(tuple(r[n] for n in names) for r in found) == expected
