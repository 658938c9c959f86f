"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by angle. For each cluster, the candidates are sorted once by an upper
bound of their inner product with any member: the candidate's length times the cosine of its
angle to the centre less the largest angle of a member. Every member walks that one list and
stops where the bound proves that nothing further down can enter its result.

Candidates are dealt to slices of bounded size by a hash and travel once per pass; packed blocks
of anchors come to every slice after them, one block at a time. A first pass finds the positives,
a second one the negatives between the bounds that the positives set. Each slice gives a few
rows per anchor, and the best of all slices are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trapiche.llm.common import named, row_count
from trapiche.llm.vectors import inner_products, is_finite, matrix, whole
from trapiche.sinks.writers import store

ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
FACTOR = 256
# Bounds of a negative's score in hundredths of the positive's.
LEAST_PERCENT, MOST_PERCENT = 50, 95
CLUSTERS = 32
# Anchors, those with the smallest hashes, on which the centres are fitted.
FIT_ANCHORS = 4_096
FIT_ROUNDS = 8
# Candidates that one task holds, and the fewest that are worth a task.
SLICE_ROWS = 200_000
LEAST_SLICE_ROWS = 2_000
# Anchors of one cluster that are compared at a time, and candidates of a step of the walk.
BLOCK_ANCHORS = 512
STEP = 2_048
# Norms and, more so, angles are rounded; bounds get this much to spare.
_SLACK, _ANGLE_SLACK = 1e-9, 1e-7



def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a vector of zeros has no direction and stays zero."""
    floats = vectors.astype(float)
    lengths = np.sqrt((floats * floats).sum(axis=1))
    return floats / np.where(lengths > 0, lengths, 1)[:, None], lengths


def _angles(directions: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ centre, -1, 1))


def _centres(anchors: DataFrame, clusters: int, fit_anchors: int) -> np.ndarray:
    """Spherical k-means of a bounded number of anchors."""
    sample = anchors.orderBy(F.xxhash64("id"), "id", "vector").limit(fit_anchors).collect()
    if not sample:
        return np.zeros((0, 0))
    width = max(len(r["vector"]) for r in sample)
    rows = np.zeros((len(sample), width))
    for row, r in zip(rows, sample):
        row[: len(r["vector"])] = r["vector"]
    directions = _unit(rows)[0]
    centres = np.unique(directions, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(clusters, len(centres))).astype(int)]
    for _ in range(FIT_ROUNDS):
        own = (directions @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, directions)
        moved, lengths = _unit(sums)
        centres = np.where(lengths[:, None] > 0, moved, centres)
    return centres


def _fitted(vectors: np.ndarray, width: int) -> np.ndarray:
    """Rows cut or padded to the width of the centres."""
    if vectors.shape[1] >= width:
        return vectors[:, :width]
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def _clustered(centres: np.ndarray):
    """Cluster of each anchor and its angle to the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["vector"])
            cosines = _fitted(_unit(vectors)[0], centres.shape[1]) @ centres.T
            own = cosines.argmax(axis=1) if len(cosines) else np.zeros(0, int)
            angle = np.arccos(np.clip(cosines[np.arange(len(own)), own], -1, 1))
            # A vector of zeros has the same product with everything, whatever its angle.
            angle = np.where(vectors.any(axis=1), angle, 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in batch.schema.names), pa.array(own, pa.int32()), pa.array(angle)],
                [*batch.schema.names, "cluster", "angle"],
            )

    return run


class SharedList:
    """The candidates of a slice in descending order of the bound for one cluster."""

    def __init__(self, candidates: Candidates, centre: np.ndarray, reach: float):
        beyond = np.maximum(candidates.angles(centre) - reach - _ANGLE_SLACK, 0)
        # Per unit of an anchor's length, so that one order serves members of every length.
        bound = candidates.lengths * np.cos(np.minimum(beyond, np.pi))
        bound += np.abs(bound) * _SLACK
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]


class Candidates:
    """The rows of one slice, numbered in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.directions, self.lengths = _unit(self.vectors)

    def angles(self, centre: np.ndarray) -> np.ndarray:
        width = max(self.directions.shape[1], len(centre))
        padded = np.pad(centre, (0, width - len(centre)))
        angles = _angles(_fitted(self.directions, width), padded)
        return np.where(self.lengths > 0, angles, 0)


def walk(
    shared: SharedList,
    candidates: Candidates,
    vectors: np.ndarray,
    takes: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    lists: int,
    best: int,
    floor: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and row numbers of the `best` candidates of each list of each anchor.

    `takes(anchors, rows, scores)` says, as an array of anchors x lists x rows, which scores may
    enter which list. An anchor stops once, for each of its lists, the bound on what is left is
    below the list's last entry or below its `floor`. Missing entries have row -1. The last
    value is the number of products formed.
    """
    width = max(vectors.shape[1], candidates.vectors.shape[1])
    wide = _fitted(candidates.vectors, width)
    vectors = _fitted(vectors, width)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    count, places = len(vectors), len(candidates.ids)
    # One number that sorts by score, then by id: ids ascend with the row number.
    bits = max(1, int(places).bit_length())
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(wide).max(initial=0)) * max(1, width)
    kind = np.int64 if most < 1 << (61 - bits) else object
    nothing = -(1 << 62) if kind is np.int64 else -(most << (bits + 2)) - 1
    top = np.full((count, lists, best), nothing, kind)
    active, formed = np.arange(count), 0
    for start in range(0, places, STEP):
        last = top[active, :, -1]
        reached = np.where(last > nothing, last >> bits, np.iinfo(np.int64).min).astype(float)
        least = np.maximum(reached, floor[active])
        bound = lengths[active] * shared.bound[start]
        bound += np.abs(bound) * _SLACK + _SLACK
        active = active[(bound[:, None] >= least).any(axis=1)]
        if len(active) == 0:
            break
        rows = shared.order[start : start + STEP]
        scores = inner_products(vectors[active], wide[rows])
        formed += scores.size
        keys = (scores.astype(kind) << bits) + (places - rows)
        fits = takes(active, rows, scores)
        for number in range(lists):
            entered = np.where(fits[:, number], keys, nothing)
            both = np.concatenate([top[active, number], entered], axis=1)
            part = np.partition(both, both.shape[1] - best, axis=1)[:, -best:]
            top[active, number] = np.sort(part, axis=1)[:, ::-1]
    there = top > nothing
    scores = np.where(there, top >> bits, 0)
    rows = np.where(there, places - (top - (scores << bits)), -1)
    return scores, rows.astype(np.int64), formed


def _positives(block: dict, candidates: Candidates, shared: SharedList, best: int):
    def takes(anchors, rows, scores):
        same = block["label"][anchors][:, None] == candidates.labels[rows]
        other = block["id"][anchors][:, None] != candidates.ids[rows]
        return (same & other)[:, None, :]

    floor = np.full((len(block["id"]), 1), -np.inf)
    return walk(shared, candidates, block["vector"], takes, 1, best, floor)


def _negatives(block: dict, candidates: Candidates, shared: SharedList, best: int, percent):
    positives = block["positives"]
    least, most = percent

    def takes(anchors, rows, scores):
        differs = block["label"][anchors][:, None] != candidates.labels[rows]
        hundred, wanted = 100 * scores[:, None, :], positives[anchors][:, :, None]
        inside = (least * wanted <= hundred) & (hundred <= most * wanted)
        return inside & block["has"][anchors][:, :, None] & differs[:, None, :]

    # A list of an anchor that lacks that positive, or whose bounds are empty, needs nothing.
    open_lists = block["has"] & (least * positives <= most * positives)
    floor = np.where(open_lists, least * positives / 100 * (1 - _SLACK) - _SLACK, np.inf)
    return walk(shared, candidates, block["vector"], takes, positives.shape[1], best, floor)


def _slices(centres: np.ndarray, best: int, percent: tuple[int, int] | None):
    """Walks of every block of anchors over the candidates of each slice of a partition."""

    def walked(candidates: Candidates, block: dict, shared: SharedList) -> pa.RecordBatch:
        if percent is None:
            scores, rows, _ = _positives(block, candidates, shared, best)
        else:
            scores, rows, _ = _negatives(block, candidates, shared, best, percent)
        anchor, number, entry = np.nonzero(rows >= 0)
        found = rows[anchor, number, entry]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block["id"][anchor]),
                pa.array(block["mark"][anchor]),
                pa.array((number + 1).astype(np.int32)),
                pa.array(candidates.ids[found]),
                pa.array(scores[anchor, number, entry].tolist(), pa.int64()),
            ],
            ["anchor_id", "mark", "list", "id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, candidates, lists, cluster = None, [], None, None, None
        for batch in batches:
            slices = batch["slice"].to_numpy()
            blocks = batch["block"].to_numpy()
            for row in _breaks(slices, blocks):
                part = batch.slice(row[0], row[1] - row[0])
                if part["slice"][0].as_py() != number:
                    number, held, candidates, lists, cluster = slices[row[0]], [], None, None, None
                if blocks[row[0]] < 0:
                    held.append(part)
                    continue
                if candidates is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    candidates = Candidates(
                        table["id"].to_numpy(),
                        table["label"].to_numpy(),
                        matrix(table["vector"].combine_chunks()),
                    )
                    held = []
                if candidates is None:
                    continue
                for at in range(len(part)):
                    block = _block(part, at)
                    if block["cluster"] != cluster:
                        cluster = block["cluster"]
                        lists = SharedList(candidates, centres[cluster], block["reach"])
                    yield walked(candidates, block, lists)

    return run


def _breaks(slices: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rows of one slice that are all candidates or all blocks."""
    sides = blocks >= 0
    change = (slices[1:] != slices[:-1]) | (sides[1:] != sides[:-1])
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(slices)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _block(part: pa.RecordBatch, at: int) -> dict:
    """One packed row as arrays."""
    rows = pa.array(part["anchors"][at].as_py(), part["anchors"].type.value_type)
    block = {
        "cluster": part["cluster"][at].as_py(),
        "reach": part["reach"][at].as_py(),
        "id": rows.field("id").to_numpy(),
        "mark": rows.field("mark").to_numpy(),
        "label": rows.field("label").to_numpy(),
        "vector": matrix(rows.field("vector")),
    }
    if rows.type.get_field_index("positives") >= 0:
        lists = rows.field("positives")
        block["positives"] = matrix(lists)
        sizes = np.diff(lists.offsets.to_numpy())
        block["has"] = np.arange(block["positives"].shape[1]) < sizes[:, None]
    return block


def _walked(
    candidates: DataFrame,
    anchors: DataFrame,
    slices: int,
    centres: np.ndarray,
    best: int,
    percent: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows `(anchor_id, mark, list, id, score)`: the best of each slice."""
    fields = [c for c in ("id", "mark", "label", "vector", "positives") if c in anchors.columns]
    # Members of a cluster, in blocks of about BLOCK_ANCHORS rows dealt by a hash.
    sizes = anchors.groupBy(F.col("cluster").alias("of")).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ANCHORS).alias("parts"), F.max("angle").alias("reach")
    )
    dealt = anchors.join(F.broadcast(sizes), F.col("cluster") == F.col("of")).withColumn(
        "part", F.pmod("mark", F.col("parts"))
    )
    packed = dealt.groupBy("cluster", "part").agg(
        F.collect_list(F.struct(*fields)).alias("anchors"), F.first("reach").alias("reach")
    )
    blocks = packed.select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.col("cluster").alias("block"),
        "part",
        "cluster",
        "reach",
        "anchors",
    )
    rows = candidates.select("slice", F.lit(-1).alias("block"), "id", "label", "vector")
    together = rows.unionByName(blocks, allowMissingColumns=True)
    return (
        together.repartition(slices, "slice")
        .sortWithinPartitions("slice", "block", "part")
        .mapInArrow(
            _slices(centres, best, percent),
            "anchor_id long, mark long, list int, id long, score long",
        )
    )


def _first(rows: DataFrame, count: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    factor: int = FACTOR,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
    clusters: int = CLUSTERS,
    fit_anchors: int = FIT_ANCHORS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Ids and labels are whole numbers. Rows with a null id, label or vector, or with a null or
    non-finite component, take no part. Components become floor(factor * x); scores are exact
    inner products, shorter vectors being padded with zeros. Anchors are the rows whose id is
    divisible by `anchor_every`. An anchor's positives are its first rows of the same label and
    another id; for each, the first rows of another label are returned whose score lies between
    the two percentages of the positive's. Higher scores come first, of equal ones the smaller
    id. Candidates that repeat count each; anchors that repeat in id, label and vector count
    once. Other columns are not read. An empty table, or one without anchors, gives an empty
    result. The centres are fitted on at most `fit_anchors` anchors; they decide the order of
    the walks, not the result.
    """
    base = named(vectors, id=id_col, vector=vector_col, label=label_col).where(
        "id IS NOT NULL AND label IS NOT NULL"
    )
    base = base.where(is_finite(F.col("vector"))).select(
        F.col("id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        whole(F.col("vector"), factor).alias("vector"),
    )
    mark = F.xxhash64("id", "label", "vector")
    base = store(base.withColumn("mark", mark))
    count = row_count(base)
    cores = base.sparkSession.sparkContext.defaultParallelism
    slices = max(1, -(-count // slice_rows), min(cores, count // LEAST_SLICE_ROWS))
    candidates = base.withColumn("slice", F.pmod(F.xxhash64("mark"), F.lit(slices)).cast("int"))
    anchors = base.where(F.col("id") % anchor_every == 0).dropDuplicates(["id", "label", "vector"])
    centres = _centres(anchors, clusters, fit_anchors)
    kinds = "id long, label long, vector array<long>, mark long, cluster int, angle double"
    anchors = store(
        anchors.select("id", "label", "vector", "mark").mapInArrow(_clustered(centres), kinds)
        if len(centres)
        else anchors.selectExpr(
            "id", "label", "vector", "mark", "0 AS cluster", "CAST(0 AS double) AS angle"
        ).where("false")
    )
    found = _walked(candidates, anchors, slices, centres, positives)
    chosen = store(_first(found, positives, ["anchor_id", "mark"]))
    scores = chosen.groupBy(
        F.col("anchor_id").alias("of_id"), F.col("mark").alias("of_mark")
    ).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]
        ).alias("positives")
    )
    own = (F.col("id") == F.col("of_id")) & (F.col("mark") == F.col("of_mark"))
    bounded = anchors.join(scores, own).drop("of_id", "of_mark")
    met = _walked(
        candidates, bounded, slices, centres, negatives, (least_percent, most_percent)
    )
    best = _first(met, negatives, ["anchor_id", "mark", "list"])
    pos, neg = chosen.alias("pos"), best.alias("neg")
    same = (
        (F.col("pos.anchor_id") == F.col("neg.anchor_id"))
        & (F.col("pos.mark") == F.col("neg.mark"))
        & (F.col("pos.rank") == F.col("neg.list"))
    )
    return pos.join(neg, same).select(
        F.col("pos.anchor_id").alias("anchor_id"),
        F.col("pos.id").alias("positive_id"),
        F.col("neg.rank").alias("rank"),
        F.col("neg.id").alias("negative_id"),
        F.col("pos.score").alias("positive_score"),
        F.col("neg.score").alias("negative_score"),
    )
