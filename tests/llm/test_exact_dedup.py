import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trapiche.llm.exact_dedup import exact_dedup
from trapiche.llm.fuse_filter import build_filter

ROWS = [
    (7, "a  b\nc"),
    (3, "a b c"),
    (5, "a b\tc"),
    (4, "a b c "),
    (9, None),
    (8, ""),
    (2, " "),
    (6, "long " * 50_000),
    (1, "long\n" * 50_000),
    (10, "é ü"),
    (11, "é\x0b ü"),
    (12, "é\xa0ü"),
]


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for own, text in rows:
        groups[normal(text)].append(own)
    return {
        (own, min(g), len(g), own == min(g), hashlib.sha256(t.encode()).hexdigest())
        for t, g in groups.items()
        for own in g
    }


@pytest.mark.parametrize("sent", [0, 1_000])
def test_equals_brute_force(documents, sent):
    found = exact_dedup(documents(ROWS), sent_keys=sent)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert {tuple(r[n] for n in names) for r in found.collect()} == brute(ROWS)


def test_many_buckets(documents):
    rows = [(i, f"text {i % 70}") for i in range(300)]
    found = exact_dedup(documents(rows), bucket_rows=20).collect()
    assert all(r["keep_id"] == r["doc_id"] % 70 for r in found)
    assert sum(r["kept"] for r in found) == 70


def test_rows_that_repeat_and_rows_without_id(documents):
    rows = [(1, "x"), (1, "x"), (2, "x"), (None, "x"), (None, "y"), (None, "y")]
    found = exact_dedup(documents(rows)).collect()
    x = [r for r in found if r["text"] == "x"]
    assert {r["group_size"] for r in x} == {4} and {r["keep_id"] for r in x} == {1}
    assert [r["doc_id"] for r in x if r["kept"]] == [1]
    y = [r for r in found if r["text"] == "y"]
    assert sum(r["kept"] for r in y) == 1 and {r["group_size"] for r in y} == {2}


def test_one_repeated_id_shows_no_window(documents):
    rows = [(i, f"text {i % 7}") for i in range(20)] + [(3, "text 3"), (3, "text 3"), (3, "other")]
    found = exact_dedup(documents(rows))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    kept = sorted((r["doc_id"], r["text"]) for r in found.collect() if r["kept"])
    assert kept == sorted([(i, f"text {i}") for i in range(7)] + [(3, "other")])


def test_only_repeated_texts_travel(documents):
    rows = [(i, f"text {i}") for i in range(50)] + [(100, "text 3")]
    plan = exact_dedup(documents(rows))._jdf.queryExecution().optimizedPlan().toString()
    # One branch of the union has no join: rows of texts found once are not shuffled.
    assert plan.count("Join") == 1 and plan.strip().startswith("Union")


def test_empty_table_and_clashing_names(documents):
    assert exact_dedup(documents([])).collect() == []
    clash = documents([(1, "x"), (2, "x")])
    for name in ("keep_id", "kept", "digest", "body", "held", "copy", "size"):
        clash = clash.withColumn(name, F.lit("own"))
    found = exact_dedup(clash)
    assert "keep_id_" in found.columns
    assert {(r["doc_id"], r["keep_id"], r["keep_id_"], r["kept_"]) for r in found.collect()} == {
        (1, "own", 1, True),
        (2, "own", 1, False),
    }


def test_filter_has_no_false_negatives_and_few_false_positives():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    made = build_filter(keys[:10_000])
    assert made.contains(keys[:10_000]).all()
    assert made.contains(keys[10_000:]).mean() < 0.02
    assert len(made.cells) < 1.3 * 10_000


@pytest.mark.parametrize("size", [1, 2, 3, 10, 100])
def test_small_filters(size):
    keys = np.random.default_rng(size).integers(0, 2**63, size).astype(np.uint64)
    assert build_filter(np.append(keys, keys)).contains(keys).all()
