"""Jaccard join of word n-grams by a count-vector R-tree.

The tokens of a document are its distinct shingles. They are hashed into groups, twice over.

Dealing out. Two sets that are similar enough differ in at most t tokens, t depending on their
sizes. With t + 1 + s groups, at least s + 1 groups hold the same tokens in both, so sets meet by
the digests of their groups. All sets that have a digest are counted, and every set leaves out
its s most frequent ones: of s + 1 common digests the least frequent one stays in both, so none
is lost, and a passage that many documents share brings them together only where it fills more
than s groups. The sets of one digest, and those of digests whose smallest sets have met the same
smallest set, are one class. No token and no set is compared yet, and equal sets are one.

Join. Within a class the counts of tokens per group are points in an R-tree. The overlap of a
set with any set below a node is at most the sum over the groups of the smaller of its own count
and the node's largest; nodes and points whose sum is too small are pruned. What the bounds
cannot tell apart forms the classes of a second pass, which are far fewer and smaller: only
their tokens travel, and pairs that survive the tree again are verified by them: a few one by
one, many by lists of the sets that differ alike from the core of their class. Sets that are
connected already are not compared again, nor are nodes that hold no others, so a class of near
copies takes a number of comparisons near its size, not the square of it.

A class beyond the size of a cell is dealt to cells. Each cell is joined by itself, then a
sample of all cells, which merges what is large; then the sets outside the largest component
meet every cell. Every pair that is not connected by then has been compared.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.llm.common import named
from trapiche.llm.components import connected_components
from trapiche.llm.key_filter import key_filter
from trapiche.llm.windows import mixed
from trapiche.sinks.writers import store

SHINGLE_WORDS = 4
LEAST_PERCENT = 85
# Sets, and bytes of their tokens, that one task joins; of points, which are smaller, it joins
# as many more.
CELL_SETS = 8_192
POINT_CELLS = 8
CELL_BYTES = 1 << 25
SLOTS_OF_CELL = 8
# Children of a node of the tree, and tokens that a group of a point holds on average.
FAN = 16
GROUP_TOKENS = 8
# So many sets that survive the tree are verified at once.
FEW = 8
# Beyond so many groups they are only made more where counts would not fit 16 bits.
MOST_GROUPS, MOST_TOKENS = 512, 30_000
# Bytes that a token takes, by itself and in a point.
TOKEN_BYTES, POINT_BYTES = 8.0, 0.5
# Shingles hashed at a time, which bounds the memory of a very long text.
BLOCK = 1 << 16
# Low bits of a group digest that hold its level.
LEVEL_BITS = 7

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def token_hashes(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending XXH64 of the distinct shingles; a text of fewer words is one shingle."""
    # bytes.split() cuts at exactly the six white space bytes of the contract.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    found = []
    for start in range(0, len(words) - size + 1, BLOCK):
        block = words[start : start + BLOCK + size - 1]
        shingles = map(b" ".join, zip(*[block[i:] for i in range(size)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(0)), np.uint64)
        found.append(np.unique(hashes))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


class Groups:
    """Digests of token groups such that any two similar sets share one.

    Sizes are cut into levels. A set is entered at its own level and, if a set of the level
    below may be similar to it, at that one too. At a level, similar sets differ in at most
    `apart` tokens, so of apart + 1 + spare groups at least 1 + spare agree. In any order of all
    digests every set may leave out its first `spare` at a level: the last that two sets have in
    common stays in both.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1]
        while self.starts[-1] < 1 << 50:
            start = self.starts[-1]
            self.starts.append(max(start + 1, start * 3 // 2, -(-start * 100 // percent)))

    def _shape(self, level: int) -> tuple[int, int]:
        """Number of groups, and of those that a set may leave out."""
        small = self.starts[level + 1] - 1
        apart = (100 - self.percent) * (small + 100 * small // self.percent) // (100 + self.percent)
        spare = apart // 4
        return apart + 1 + spare, spare

    def spares(self) -> list[int]:
        """Groups that a set may leave out, by level."""
        return [self._shape(level)[1] for level in range(len(self.starts) - 1)]

    def digests(self, tokens: np.ndarray) -> np.ndarray:
        if len(tokens) == 0:
            return np.zeros(0, np.uint64)
        own = bisect.bisect_right(self.starts, len(tokens)) - 1
        levels = [own]
        if own and self.percent * len(tokens) <= 100 * (self.starts[own] - 1):
            levels.append(own - 1)
        found = []
        for level in levels:
            count = self._shape(level)[0]
            salt = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            scattered = mixed(tokens ^ salt)
            group = ((scattered >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            order = np.argsort(group, kind="stable")
            group = group[order].astype(np.int64)
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            content = np.zeros(count, np.uint64)
            content[group[first]] = np.add.reduceat(mixed(scattered[order]), first)
            digests = mixed(mixed(content + salt) + np.arange(count, dtype=np.uint64))
            found.append((digests >> np.uint64(LEVEL_BITS) << np.uint64(LEVEL_BITS)) + np.uint64(level))
        return np.concatenate(found)


def overlap_needed(percent: int, a, b):
    """Fewest common tokens of similar sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """An R-tree over points of token counts per group, with the sizes of the sets."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        widest = int(points.var(axis=0).argmax()) if len(points) else 0
        # Tiles: slabs of similar size, sorted by the coordinate that spreads most.
        slab = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (FAN * FAN)
        self.order = np.lexsort((points[:, widest], slab))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FAN:
            high, least, most = self.levels[-1]
            at = np.arange(0, len(least), FAN)
            self.levels.append(
                (
                    np.maximum.reduceat(high, at, axis=0),
                    np.minimum.reduceat(least, at),
                    np.maximum.reduceat(most, at),
                )
            )

    def _bounds(self, level: int, at: np.ndarray, point: np.ndarray, size: int):
        """Which nodes may hold a similar set, and the bounds on the overlap."""
        high, least, most = (x[at] for x in self.levels[level])
        bound = np.minimum(high, point).sum(axis=1)
        smallest = np.maximum(least, -(-self.percent * size // 100))
        fits = (100 * size >= self.percent * least) & (smallest <= most)
        return fits & (bound >= overlap_needed(self.percent, size, smallest)), bound

    def similar(self, point: np.ndarray, size: int, open_ones: np.ndarray) -> np.ndarray:
        """Numbers of the open points whose bound is large enough, the best bound first."""
        # A node is open if a point below it is.
        opened = [open_ones[self.order]]
        for _ in self.levels[1:]:
            opened.append(np.logical_or.reduceat(opened[-1], np.arange(0, len(opened[-1]), FAN)))
        at = np.flatnonzero(opened[-1])
        for level in range(len(self.levels) - 1, 0, -1):
            at = at[self._bounds(level, at, point, size)[0]]
            at = (at[:, None] * FAN + np.arange(FAN)).ravel()
            at = at[at < len(self.levels[level - 1][1])]
            at = at[opened[level - 1][at]]
        fits, bound = self._bounds(0, at, point, size)
        return self.order[at[fits][np.argsort(-bound[fits], kind="stable")]]


def point_of(tokens: np.ndarray) -> np.ndarray:
    """Tokens per group; larger sets have twice the groups of smaller ones."""
    groups = 8
    while groups * (GROUP_TOKENS if groups < MOST_GROUPS else MOST_TOKENS) < len(tokens):
        groups *= 2
    own = (mixed(tokens) & np.uint64(groups - 1)).astype(np.int64)
    return np.bincount(own, minlength=groups).astype(np.uint16)


def _folded(points: list[np.ndarray]) -> np.ndarray:
    """Points with as many groups as the smallest one has."""
    groups = min((len(p) for p in points), default=8)
    # A group of the smaller point is the sum of those with the same low bits.
    return np.array([p.reshape(-1, groups).sum(axis=0, dtype=np.int32) for p in points])


class Overlaps:
    """How many tokens a set has in common with every set of its class.

    What more than half of the sets hold is their core. A set is kept as what it lacks of the core
    and what it holds besides, so near copies cost as much as they differ.
    """

    def __init__(self, tokens: list[np.ndarray]):
        sizes = np.array([len(t) for t in tokens])
        owner = np.repeat(np.arange(len(tokens)), sizes)
        name, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)[1:]
        core = np.flatnonzero(2 * count > len(tokens))
        place = np.full(len(count), -1)
        place[core] = np.arange(len(core))
        inside = place[name] >= 0
        held = np.zeros((len(core), len(tokens)), bool)
        held[place[name[inside]], owner[inside]] = True
        lacked, lacking = np.nonzero(~held)
        self.in_core = held.sum(axis=0)
        self.lacks = len(core) - self.in_core
        name = np.append(name[~inside], core[lacked])
        owner = np.append(owner[~inside], lacking)
        # What one set alone lacks or holds it has in common with no other.
        shared = np.bincount(name, minlength=len(count))[name] > 1
        name, owner = name[shared], owner[shared]
        self.holders = owner[np.argsort(name, kind="stable")]
        self.edges = np.append(0, np.cumsum(np.bincount(name, minlength=len(count))))
        self.names = name[np.argsort(owner, kind="stable")]
        self.first = np.append(0, np.cumsum(np.bincount(owner, minlength=len(tokens))))

    def of(self, i: int) -> np.ndarray:
        """Common tokens of set i and each other set."""
        names = self.names[self.first[i] : self.first[i + 1]]
        lengths = self.edges[names + 1] - self.edges[names]
        ends = np.cumsum(lengths)
        at = np.arange(lengths.sum()) + np.repeat(self.edges[names] - (ends - lengths), lengths)
        alike = np.bincount(self.holders[at], minlength=len(self.lacks))
        return self.in_core - self.lacks[i] + alike


def connect(
    points: np.ndarray,
    sizes: np.ndarray,
    component: np.ndarray,
    asks: np.ndarray,
    percent: int,
    tokens: list[np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """Links that connect sets of different components; each is between a set that asks and any.

    After them no similar pair with a set that asks is left in two components. Without tokens a
    link is a pair that the bounds cannot tell apart.
    """

    def similar(i: int, j: int) -> bool:
        common = len(np.intersect1d(tokens[i], tokens[j], assume_unique=True))
        return 100 * common >= percent * (sizes[i] + sizes[j] - common)

    component = np.unique(component, return_inverse=True)[1]
    left = len(np.unique(component))
    tree, links, overlaps = CountTree(points, sizes, percent), [], None
    for i in np.flatnonzero(asks).tolist():
        if left == 1:
            break
        near = tree.similar(points[i], int(sizes[i]), component != component[i])
        sure = tokens is None
        if not sure and len(near) >= FEW:
            overlaps = overlaps or Overlaps(tokens)
            common = overlaps.of(i)[near]
            near = near[100 * common >= percent * (sizes[i] + sizes[near] - common)]
            sure = True
        for j in near.tolist():
            if component[j] != component[i] and (sure or similar(i, j)):
                links.append((i, j))
                component[component == component[j]] = component[i]
                left -= 1
    return links


def _described(size: int, percent: int):
    """Size, digest and group digests of each document's set."""
    groups = Groups(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, nodes, entered, points = [], [], [], [], []
            for text in batch["text"].to_pylist():
                tokens = token_hashes(text, size)
                sizes.append(len(tokens))
                digest = _digest(tokens)
                digests.append(digest)
                nodes.append(digest and int.from_bytes(digest[:8], "big", signed=True))
                entered.append(groups.digests(tokens))
                points.append(point_of(tokens).tobytes())
            offsets = np.cumsum([0, *map(len, entered)]).astype(np.int32)
            flat = np.concatenate(entered or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["mark"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(points, pa.binary()),
                ],
                ["id", "mark", "n", "digest", "node", "groups", "point"],
            )

    return run


def _digest(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _entered(described: DataFrame, sets: DataFrame) -> DataFrame:
    """Group digests that several sets have, `(met, node, held_by)`, a row for each of the sets.

    Digests travel once and meet in a window, so no list of the shared ones goes to any task.
    """
    # Of equal sets one enters.
    first = key_filter(sets.select(F.col("mark").alias("key")))
    entered = described.where("node IS NOT NULL").where(first.test(F.col("mark")))
    same = Window.partitionBy("met")
    return (
        entered.select(F.explode("groups").alias("met"), "node")
        .select(
            "met",
            "node",
            F.count(F.lit(1)).over(same).alias("held_by"),
            F.min("node").over(same).alias("hub"),
            F.max("node").over(same).alias("top"),
        )
        .where("hub < top")
        .select("met", "node", "held_by")
        .distinct()
    )


def _rarer(entered: DataFrame, spares: list[int]) -> DataFrame:
    """Without the most frequent digests of each set and level, as many as may be left out.

    The order is one of all digests; those that only one set has would come last.
    """
    level = F.col("met").bitwiseAND((1 << LEVEL_BITS) - 1)
    by_count = Window.partitionBy("node", level).orderBy(F.desc("held_by"), "met")
    spare = F.element_at(F.array(*map(F.lit, spares)), (level + 1).cast("int"))
    ranked = entered.withColumn("rank", F.row_number().over(by_count))
    return store(ranked.where(F.col("rank") > spare).select("met", "node"))


def _tokens(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [token_hashes(text, size) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["digest", "held"],
            )

    return run


def _stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same components with every member linked to the smallest one."""
    above: dict[int, int] = {}

    def top(i: int) -> int:
        while above.get(i, i) != i:
            above[i] = above.get(above[i], above[i])
            i = above[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return [(top(i), i) for i in sorted({i for link in links for i in link}) if top(i) != i]


def _joined(percent: int, verify: bool):
    """Links within the classes of a task, whose sets come as tokens or as points."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("class", "ascending"), ("number", "ascending")])
        classes = group["class"].to_numpy()
        numbers, component = group["number"].to_numpy(), group["component"].to_numpy()
        asks = group["asks"].to_numpy(zero_copy_only=False)
        held, sizes, found = group["held"], group["n"].to_numpy(), []
        edges = np.flatnonzero(np.diff(classes)) + 1
        for part in np.split(np.arange(len(classes)), edges):
            kind = np.uint64 if verify else np.uint16
            sets = [np.frombuffer(held[int(i)].as_buffer(), kind) for i in part]
            points = _folded([point_of(t) for t in sets] if verify else sets)
            tokens = sets if verify else None
            links = connect(points, sizes[part], component[part], asks[part], percent, tokens)
            for a, b in _stars(links):
                found.append((classes[part[0]], numbers[part[a]], numbers[part[b]]))
        columns = list(zip(*found)) or [()] * 3
        return pa.table(
            {name: pa.array(c, pa.int64()) for name, c in zip(("class", "a", "b"), columns)}
        )

    return run


_MEMBER = ["task", "class", "number", "n", "held", "component", "asks"]


def _links(rows: DataFrame, percent: int, verify: bool) -> DataFrame:
    """Rows of `_MEMBER` -> stored links."""
    return store(
        rows.select(_MEMBER)
        .groupBy("task")
        .applyInArrow(_joined(percent, verify), "class long, a long, b long")
    )


def _link_hot(hot: DataFrame, links: DataFrame, percent: int, verify: bool) -> DataFrame:
    """All links of classes in cells, `hot(class, cell, cells, number, n, held)`, given those
    within their cells."""
    pairs = links.select("a", "b")

    def placed(pairs: DataFrame) -> DataFrame:
        roots = connected_components(pairs)
        return store(
            hot.select("class", "cell", "cells", "number")
            .join(roots, F.col("number") == F.col("node"), "left")
            .select(
                "class", "cell", "cells", "number", F.coalesce("root", "number").alias("component")
            )
        )

    def filled(members: DataFrame) -> DataFrame:
        own = hot.select(
            F.col("class").alias("of"), F.col("number").alias("of_number"), "n", "held"
        )
        same = (F.col("of") == F.col("class")) & (F.col("of_number") == F.col("number"))
        return members.join(own, same)

    # A sample of every cell, as large as a cell: merges the large components of the cells.
    members = placed(pairs)
    sample = members.where(F.pmod(F.xxhash64("number", F.lit("sample")), F.col("cells")) == 0)
    asked = filled(sample).withColumns({"task": F.col("class"), "asks": F.lit(True)})
    pairs = pairs.union(_links(asked, percent, verify).select("a", "b"))
    # What is outside the largest component of its class meets every cell, in blocks.
    members = placed(pairs)
    sizes = members.groupBy("class", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy(F.col("class").alias("of_class")).agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.sum("size").alias("size"),
        F.max("size").alias("main_size"),
    )
    outside = F.col("size") - F.col("main_size")
    largest = largest.select(
        "of_class", "main", F.ceil(outside / CELL_SETS).cast("int").alias("blocks")
    ).where("blocks > 0")
    members = members.join(largest, F.col("class") == F.col("of_class"))
    each_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    each_cell = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    inside = members.where("component = main").withColumn("block", each_block)
    asking = members.where("component <> main").withColumn(
        "own", F.pmod(F.xxhash64("number"), "blocks")
    )
    others = asking.withColumn("block", each_block).where("block <> own")
    asking = asking.withColumn("cell", each_cell).withColumn("block", F.col("own").cast("int"))
    # A set that asks is there once in a task, as one that asks.
    both = (
        inside.withColumn("asks", F.lit(False))
        .unionByName(others.drop("own").withColumn("asks", F.lit(False)))
        .unionByName(asking.drop("own").withColumn("asks", F.lit(True)))
    )
    both = both.withColumn("task", F.xxhash64("class", "cell", "block"))
    return pairs.union(_links(filled(both), percent, verify).select("a", "b"))


def _connected(
    members: DataFrame, held: DataFrame, width: float, limits: tuple[int, int], percent: int
) -> DataFrame:
    """Pairs `(a, b)` that connect what is similar within the classes of `members(class, number,
    n, digest)`.

    `held(digest, held)` are tokens of `width` 8 bytes, or points, of about one byte for two
    tokens. Classes are gathered in tasks up to the limits of a cell, larger ones dealt to cells.
    """
    cell_sets, cell_bytes = limits
    verify = width == TOKEN_BYTES
    size = F.sum("n") * F.lit(width)
    cells = F.ceil(F.greatest(F.count(F.lit(1)) / cell_sets, size / F.lit(cell_bytes)))
    shapes = store(
        members.groupBy(F.col("class").alias("of_class")).agg(
            cells.cast("int").alias("cells"), size.alias("bytes_in")
        )
    )
    one = F.col("cells") <= 1
    facts = shapes.agg(
        F.coalesce(F.max("cells"), F.lit(1)).alias("most"),
        F.coalesce(F.sum(F.when(one, F.col("bytes_in"))), F.lit(0.0)).alias("small"),
    ).first()
    # Comparing takes longer than reading, so a slot is smaller than a cell may be.
    slots = 1 + SLOTS_OF_CELL * int(facts["small"]) // cell_bytes
    task = F.when(one, F.pmod(F.xxhash64("class"), F.lit(slots)))
    placed = (
        members.join(shapes, F.col("class") == F.col("of_class"))
        .withColumn("cell", F.pmod(F.xxhash64("number"), F.col("cells")).cast("int"))
        .withColumn("task", task.otherwise(F.xxhash64("class", "cell")))
        .select("digest", "number", "n", "class", "cell", "cells", "task")
        .join(held, "digest")
        .drop("digest")
    )
    split = facts["most"] > 1
    if split:
        placed = store(placed)
    links = _links(
        placed.withColumns({"component": F.col("number"), "asks": F.lit(True)}), percent, verify
    )
    pairs = links.select("a", "b")
    if split:
        hot = placed.where("cells > 1").select("class", "cell", "cells", "number", "n", "held")
        hot_classes = shapes.where("cells > 1").select("of_class")
        inside = links.join(hot_classes, F.col("class") == F.col("of_class"), "left_semi")
        pairs = pairs.union(_link_hot(hot, inside, percent, verify))
    return pairs


def jaccard_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    least_percent: int = LEAST_PERCENT,
    cell_sets: int = CELL_SETS,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """One row per document: id, `n_shingles` and `component_id`.

    A-Z are lower-cased, words cut at the six ASCII white space characters. Two documents link
    when the distinct shingles they share are at least `least_percent` of all they have; shingles
    are compared by XXH64. A text of fewer words is one shingle, and one without words, or null,
    links with nothing. The component is the smallest id reachable over links; components of
    rows without any id have a null id, and a row without words has its own. Rows that repeat
    count each. Other columns are not read. An empty table gives an empty result. Equal sets
    meet once, as one node.
    """
    rows = named(docs, id=id_col, text=text_col).select(
        "id", "text", F.xxhash64("id", "text").alias("mark")
    )
    id_type = rows.schema["id"].dataType
    described = store(
        rows.select("id", "mark", "text").mapInArrow(
            _described(shingle_words, least_percent),
            T.StructType()
            .add("id", id_type)
            .add("mark", T.LongType())
            .add("n", T.LongType())
            .add("digest", T.BinaryType())
            .add("node", T.LongType())
            .add("groups", T.ArrayType(T.LongType()))
            .add("point", T.BinaryType()),
        )
    )
    sets = store(
        described.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("id").alias("least"),
            F.min("mark").alias("mark"),
            F.min("node").alias("node"),
            F.min("n").alias("n"),
        )
        .withColumn("number", F.monotonically_increasing_id())
    )
    linked = _linked(rows, described, sets, shingle_words, least_percent, cell_sets, cell_bytes)
    component = sets.select(F.col("digest").alias("of_digest"), "least", "number").join(
        linked, F.col("number") == F.col("of_number"), "left"
    )
    component = store(
        component.select("of_digest", F.coalesce("least_linked", "least").alias("component_id"))
    )
    own = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        described.select("id", "n", "digest")
        .join(component, F.col("digest") == F.col("of_digest"), "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id")
        )
    )


def _linked(
    rows: DataFrame,
    described: DataFrame,
    sets: DataFrame,
    shingle_words: int,
    percent: int,
    cell_sets: int,
    cell_bytes: int,
) -> DataFrame:
    """Smallest id of the component, `(of_number, least_linked)`, of every set that has a link."""
    entered = _rarer(_entered(described, sets), Groups(percent).spares())
    hubs = entered.groupBy("met").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
    meetings = entered.join(hubs.where("hub < top"), "met").select("node", "hub")
    # The smallest set of a digest meets itself.
    meetings = store(meetings.distinct())
    # A hub stands for the smallest hub that it meets itself: near copies, of which each lacks
    # other groups, then have few classes, not one for every smallest set of some group.
    lowest = meetings.groupBy(F.col("node").alias("of_hub")).agg(F.min("hub").alias("class"))
    entered_in = store(
        meetings.join(lowest, F.col("hub") == F.col("of_hub")).select("class", "node").distinct()
    )
    met_nodes = meetings.select(F.col("node").alias("of_node")).distinct()
    members = store(sets.join(met_nodes, F.col("node") == F.col("of_node"), "left_semi"))
    wanted = key_filter(members.select(F.col("mark").alias("key")).distinct())
    points = described.where(wanted.test(F.col("mark"))).selectExpr("digest", "point AS held")
    met = entered_in.select("class", F.col("node").alias("of_node")).join(
        members, F.col("node") == F.col("of_node")
    )
    near = _connected(
        met.select("class", "number", "n", "digest"),
        points.dropDuplicates(["digest"]),
        POINT_BYTES,
        (POINT_CELLS * cell_sets, cell_bytes),
        percent,
    )
    classes = connected_components(near)
    members = store(
        members.join(classes.withColumnRenamed("node", "of"), F.col("number") == F.col("of"))
        .select("digest", "mark", "n", "number", "least", F.col("root").alias("class"))
    )
    wanted = key_filter(members.select(F.col("mark").alias("key")).distinct())
    tokens = (
        rows.where(wanted.test(F.col("mark")))
        .select("text")
        .mapInArrow(_tokens(shingle_words), "digest binary, held binary")
        .dropDuplicates(["digest"])
    )
    own = members.select("class", "number", "n", "digest")
    limits = (cell_sets, cell_bytes)
    roots = connected_components(_connected(own, tokens, TOKEN_BYTES, limits, percent))
    linked = members.join(roots, F.col("number") == F.col("node")).select("number", "root", "least")
    least = linked.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("least_linked"))
    return linked.join(least, F.col("root") == F.col("of")).select(
        F.col("number").alias("of_number"), "least_linked"
    )
