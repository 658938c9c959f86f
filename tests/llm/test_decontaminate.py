import random

import pytest
from pyspark.sql import functions as F

from trapiche.llm.decontaminate import Searcher, error_budget, find_leaks, myers, pieces, plain

LETTERS = "abcdefghij "


def draw_text(draw, length):
    return plain("".join(draw.choices(LETTERS, k=length)))


def edited(draw, text, edits):
    text = list(text)
    for _ in range(edits):
        at = draw.randrange(len(text))
        kind = draw.randrange(3)
        if kind == 0:
            text[at] = draw.choice(LETTERS)
        elif kind == 1:
            text.insert(at, draw.choice(LETTERS))
        else:
            del text[at]
    return "".join(text)


def best_place(item, text):
    """(distance, first end) by the whole edit matrix."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


@pytest.mark.parametrize("seed", range(5))
def test_bit_parallel_distance_equals_the_matrix(seed):
    draw = random.Random(seed)
    item = draw_text(draw, draw.randrange(1, 150))
    text = draw_text(draw, 100) + edited(draw, item, draw.randrange(10) if len(item) > 20 else 0)
    assert myers(item, text, len(item)) == best_place(item, text)


@pytest.mark.parametrize("seed", range(8))
def test_search_loses_no_place_within_the_budget(seed):
    draw = random.Random(100 + seed)
    items = [(i, draw_text(draw, draw.choice([5, 45, 120, 250]))) for i in range(12)]
    searcher = Searcher(items, 0.1)
    for number, item in items:
        budget = error_budget(len(item))
        held = edited(draw, item, draw.randrange(budget + 1)) if budget else item
        text = plain(draw_text(draw, 200) + " " + held + " " + draw_text(draw, 200))
        found = {i: (distance, end) for i, distance, end in searcher.find(text)}
        for i, other in items:
            distance, end = best_place(other, text)
            if distance <= error_budget(len(other)):
                assert found.pop(i) == (distance, end)
        assert found == {}


def test_pieces_cover_the_item():
    parts = pieces("abcdefghijk", 3)
    assert "".join(p for _, p in parts) == "abcdefghijk" and len(parts) == 4


ITEM = "The quick brown fox jumps over the lazy dog, twice."


def test_documents(spark, documents):
    rows = [
        (1, f"intro {ITEM} outro"),
        (2, "INTRO: the QUICK\n\nbrown fox; jumps over the lazy -- dog twice"),
        (3, "the quick brown fix jumps over a lazy dog twice"),
        (4, "the quick brown fox went home"),
        (5, None),
        (6, ""),
        (7, "x " * 100_000 + ITEM),
        (None, ITEM),
        (8, ITEM),
        (8, ITEM),
    ]
    benchmark = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "?!"), (None, "zzz yyy")], "item_id long, text string"
    )
    clash = documents(rows).withColumn("id", F.lit("own")).withColumn("item_id", F.lit("own"))
    for block in (4_000_000, 30):
        found = find_leaks(clash, benchmark, block_chars=block).collect()
        assert sorted((r["id"] or 0, r["item_id"], r["distance"]) for r in found) == [
            (0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 4), (7, 1, 0), (8, 1, 0), (8, 1, 0),
        ]
    assert find_leaks(documents([]), benchmark).collect() == []
    assert find_leaks(clash, benchmark.where("false")).collect() == []
