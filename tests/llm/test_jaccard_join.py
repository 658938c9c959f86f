import random
from collections import defaultdict

import numpy as np
import pytest

from trapiche.llm import jaccard_join
from trapiche.llm.jaccard_join import (
    CountTree,
    Groups,
    connect,
    jaccard_groups,
    overlap_needed,
)


def plain_set(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    words = [w for w in text.split(" ") if w] if text else []
    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    return {tuple(lower[i : i + 4]) for i in range(max(1, len(lower) - 3))} if lower else set()


def brute(rows):
    sets = [(own, plain_set(text)) for own, text in rows]
    near = defaultdict(list)
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                near[i].append(j)
    found = []
    for i, (own, tokens) in enumerate(sets):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [sets[j][0] for j in seen if sets[j][0] is not None]
        found.append((own, len(tokens), min(ids, default=None)))
    return sorted(found, key=repr)


def rows_of(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = draw.choices(words, k=60)
    rows = []
    for _ in range(50):
        text = draw.choices(words, k=draw.choice([1, 3, 5, 9, 30, 80, 300, 900]))
        if draw.random() < 0.4:
            text = passage + text
        rows.append((len(rows), " ".join(text)))
        for _ in range(draw.choice([0, 0, 2, 5])):
            text = list(text)
            for _ in range(draw.choice([0, 1, 1, 1 + len(text) // 60])):
                text[draw.randrange(len(text))] = draw.choice(words)
            if draw.random() < 0.5:
                text = text[: max(1, int(len(text) * draw.uniform(0.8, 1)))]
            rows.append((len(rows), "\n".join(text)))
    edge = [None, "", " \t", "one", "One", "two words", "É x y z q", "é x y z q", "a " * 50_000, "a a a a"]
    rows += [(1000 + i, t) for i, t in enumerate(edge)]
    return rows + [(3, rows[3][1]), (None, rows[5][1]), (None, "only without an id"), (None, None)]


def found(documents, rows, **options):
    result = jaccard_groups(documents(rows).selectExpr("*", "1 AS n_shingles", "2 AS N"), **options)
    return sorted((tuple(r) for r in result.collect()), key=repr)


def test_equals_brute_force(documents):
    rows = rows_of(1)
    assert found(documents, rows) == brute(rows)


def test_classes_in_cells(documents, monkeypatch):
    """Near copies in a chain and strays beside them, in cells of a few sets."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text, rows = draw.choices(words, k=200), []
    for _ in range(120):
        text = list(text)
        for _ in range(2):
            text[draw.randrange(200)] = draw.choice(words)
        rows.append((len(rows), " ".join(text)))
    for at in (20, 60, 100):
        for _ in range(6):
            far = rows[at][1].split(" ")
            for _ in range(9):
                far[draw.randrange(200)] = draw.choice(words)
            rows.append((len(rows), " ".join(far)))
    monkeypatch.setattr(jaccard_join, "POINT_CELLS", 1)
    expected = brute(rows)
    assert len({r[2] for r in expected}) > 1
    assert found(documents, rows, cell_sets=8) == expected


def test_empty_table(documents):
    assert found(documents, []) == []
    assert found(documents, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_similar_sets_share_a_group(percent):
    draw, groups = np.random.default_rng(percent), Groups(percent)
    for size in [*range(1, 60), 100, 177, 500, 3000]:
        for _ in range(6):
            tokens = draw.integers(0, 1 << 63, size=2 * size + 5).astype(np.uint64)
            a, more = np.unique(tokens[:size]), tokens[size:]
            cut = draw.integers(0, size + 1)
            for drop in range(size + 1 - cut):
                b = np.unique(np.concatenate([a[: size - drop], more[: cut]]))
                common = len(np.intersect1d(a, b))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    assert np.intersect1d(groups.digests(a), groups.digests(b)).size
                    if drop > 3 * size // 10:
                        break


def test_tree_loses_nothing_and_prunes():
    draw = np.random.default_rng(1)
    sizes, sets = draw.integers(20, 400, size=240), []
    for size in sizes:
        sets.append(np.unique(draw.integers(0, 1 << 62, size=size).astype(np.uint64)))
    for i in range(0, 240, 3):
        sets[i + 1] = np.unique(np.append(sets[i][: int(len(sets[i]) * 0.95)], sets[i + 1][:2]))
    sizes = np.array([len(s) for s in sets])
    points = np.stack([np.bincount((s % np.uint64(32)).astype(int), minlength=32) for s in sets])
    tree, kept = CountTree(points, sizes, 85), 0
    for i in range(240):
        near = tree.similar(points[i], int(sizes[i]), np.ones(240, bool))
        kept += len(near)
        for j in range(240):
            common = len(np.intersect1d(sets[i], sets[j]))
            if common >= overlap_needed(85, sizes[i], sizes[j]):
                assert j in near
    assert kept < 0.05 * 240 * 240
    links = connect(points, sizes, np.arange(240), np.ones(240, bool), 85, sets)
    assert {(min(a, b), max(a, b)) for a, b in links} >= {(i, i + 1) for i in range(0, 240, 120)}


def test_shared_passage_makes_no_large_class(documents, monkeypatch):
    """A fifth of each text is the same; such sets are not compared with one another."""
    draw = random.Random(7)
    words = [f"w{i}" for i in range(5000)]
    passage = draw.choices(words, k=30)
    rows = [(i, " ".join(passage + draw.choices(words, k=draw.randint(115, 125)))) for i in range(240)]
    rows += [(1000 + i, f"{rows[i][1]} end") for i in range(5)]
    entered, connected = [], jaccard_join._connected

    def counted(members, *args):
        entered.append(members.count())
        return connected(members, *args)

    monkeypatch.setattr(jaccard_join, "_connected", counted)
    assert found(documents, rows) == brute(rows)
    assert 10 <= entered[0] < 40


def test_near_misses_are_verified_at_once(monkeypatch):
    """Copies of one text that differ too much from each other are not verified pair by pair."""
    draw = np.random.default_rng(3)
    text, fresh = np.arange(400, dtype=np.uint64) * np.uint64(977), iter(range(1 << 40, 1 << 41))
    sets = []
    for changed in [8] * 60 + [45] * 140:
        kept = draw.choice(text, 400 - changed, replace=False)
        sets.append(np.sort(np.append(kept, np.array([next(fresh) for _ in range(changed)], np.uint64))))
    common = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    sizes, apart = np.full(200, 400), ~np.eye(200, dtype=bool)
    overlaps = jaccard_join.Overlaps(sets)
    assert all((overlaps.of(i) == common[i])[apart[i]].all() for i in range(200))
    mixed_sets = [s[: 400 - 2 * i] for i, s in enumerate(sets[:150])]
    overlaps = jaccard_join.Overlaps(mixed_sets)
    for i in (0, 70, 149):
        exact = [len(np.intersect1d(mixed_sets[i], s)) for s in mixed_sets]
        assert [x for j, x in enumerate(overlaps.of(i).tolist()) if j != i] == exact[:i] + exact[i + 1 :]

    calls, plain = [], np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: calls.append(1) or plain(*a, **k))
    points = np.stack([np.bincount((s % np.uint64(32)).astype(int), minlength=32) for s in sets])
    links = connect(points, sizes, np.arange(200), np.ones(200, bool), 85, sets)
    near = 100 * common >= 85 * (800 - common)
    root = list(range(200))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert near[a, b] and top(a) != top(b)
        root[top(a)] = top(b)
    assert all(top(a) == top(b) for a, b in zip(*np.nonzero(near)))
    assert len(calls) < 1000


def test_what_sets_leave_out_costs_no_pair():
    """Similar sets keep a common digest, whatever the counts are."""
    draw, groups = np.random.default_rng(5), Groups(85)
    spares = groups.spares()
    left_out = 0

    def kept(tokens):
        nonlocal left_out
        digests = groups.digests(tokens)
        level = (digests & np.uint64((1 << jaccard_join.LEVEL_BITS) - 1)).astype(int)
        rest = []
        for own in np.unique(level):
            # Any order of all digests will do; this one is by other bits of theirs.
            mine = digests[level == own]
            rest.append(mine[np.argsort(mine * np.uint64(0x9E3779B97F4A7C15))[spares[own] :]])
            left_out += len(mine) - len(rest[-1])
        return np.concatenate(rest)

    for size in [*range(1, 80, 3), 150, 400, 1500]:
        for _ in range(10):
            tokens = draw.integers(0, 1 << 63, size=2 * size + 5).astype(np.uint64)
            drop = draw.integers(0, size // 5 + 1)
            a, b = np.unique(tokens[:size]), np.unique(tokens[drop : size + draw.integers(0, drop + 1)])
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common):
                assert np.intersect1d(kept(a), kept(b)).size
    assert left_out > 1000
