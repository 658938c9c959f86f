import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from trapiche.llm.components import connected_components
from trapiche.llm.simhash import close_pairs, fingerprint, simhash_groups


def plain_fingerprint(text):
    words = [w for w in _split(text or "") if w]
    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(lower[i : i + 3]) for i in range(max(1, len(lower) - 2))] if lower else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return text.split(" ")


def brute(rows):
    prints = {own: plain_fingerprint(t) for own, t in rows}
    near = defaultdict(set)
    for a in prints:
        for b in prints:
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                near[a].add(b)
    component = {}
    for start in sorted(prints):
        todo = [start]
        while todo:
            at = todo.pop()
            if at not in component:
                component[at] = start
                todo.extend(near[at])
    return {(own, f"{prints[own]:016x}", component[own]) for own in prints}


def rows_of(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        text = draw.choices(words, k=draw.choice([5, 60, 300]))
        rows.append((len(rows), " ".join(text)))
        for _ in range(draw.choice([0, 0, 2, 4])):
            text = list(text)
            text[draw.randrange(len(text))] = "NEW"
            rows.append((len(rows), "\n".join(text)))
    edge = [None, "", " \t", "one", "One", "two words", "É x y z", "é x y z", "a\xa0b c d", "a " * 100_000]
    return rows + [(1000 + i, t) for i, t in enumerate(edge)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, seed):
    rows = rows_of(seed)
    found = simhash_groups(documents(rows)).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in found} == brute(rows)
    kept = [r["doc_id"] for r in found if r["kept"]]
    assert sorted(kept) == sorted({r["component_id"] for r in found})


def test_fingerprint_of_long_text_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(150_000))
    assert fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_pairs_equal_brute_force(spark, distance):
    draw = random.Random(distance)
    prints = {0, -1}
    for _ in range(60):
        base = draw.getrandbits(64)
        for _ in range(4):
            flipped = base
            for _ in range(draw.randrange(7)):
                flipped ^= 1 << draw.randrange(64)
            prints.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    expected = {
        (a, b)
        for a in prints
        for b in prints
        if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance
    }
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    found = close_pairs(table, distance).collect()
    assert {(r["a"], r["b"]) for r in found} == expected


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def test_rows_that_repeat_rows_without_id_and_empty_table(documents):
    rows = [(4, "same text here"), (4, "same text here"), (9, "same text here"), (None, "same text here")]
    found = simhash_groups(documents(rows)).collect()
    assert {r["component_id"] for r in found} == {4}
    assert [r["doc_id"] for r in found if r["kept"]] == [4]
    assert simhash_groups(documents([])).collect() == []


def test_clashing_names(documents):
    clash = documents([(1, "x y z"), (2, "x y z")])
    for name in ("print", "fingerprint", "component_id", "kept", "copy", "root"):
        clash = clash.withColumn(name, F.lit("own"))
    found = simhash_groups(clash).collect()
    assert {(r["doc_id"], r["kept"], r["kept_"]) for r in found} == {(1, "own", True), (2, "own", False)}
