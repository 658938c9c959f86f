"""Centroid clustering with ns-bounds, exact in whole numbers.

Every vector keeps, for each centroid, its last evaluated distance and the round of that
evaluation. The history of all centroids is retained, so a bound is loosened by the norm of the
total displacement since that round, not by the sum of the displacements of each round, which
is never smaller. Where the bounds do not prove the assignment, its own distance is evaluated
first, then those of the centroids that may be as near.

The state of each round is a table in the shared folder. The driver holds the centroids, whose
number is fixed; sums are added up inside each task before they travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trapiche.llm.common import named
from trapiche.llm.vectors import is_finite, lists_of, matrix, whole
from trapiche.sinks.writers import store

CLUSTERS = 16
ROUNDS = 3
COMPONENTS = 64
FACTOR = 64
SEED = 1
# Beyond this a squared distance of 64 components may not fit in 64 bits.
MAX_COMPONENT = 1 << 27
# Square roots and norms are rounded; bounds are compared with this much to spare.
_SLACK = 1e-9
_FAR = np.iinfo(np.int64).max


def _distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def assign(
    vectors: np.ndarray,
    cluster: np.ndarray,
    known: np.ndarray,
    since: np.ndarray,
    history: list[np.ndarray],
    exact_own: bool = False,
) -> int:
    """Assign every vector to its nearest centroid of the last round, in place.

    `known` holds squared distances, `since` the rounds they are from (-1: never evaluated).
    Returns the number of distances evaluated. With `exact_own` the distance to the assigned
    centroid is of the last round for every vector.
    """
    now, centroids = len(history) - 1, history[-1]
    numbers, rows = np.arange(len(centroids)), np.arange(len(vectors))
    moved = np.stack([np.sqrt(((centroids - old) ** 2).sum(1).astype(float)) for old in history])
    new = since[:, 0] < 0
    loosened = moved[since, numbers]
    reach = np.sqrt(known.astype(float))
    lower = np.where(new[:, None], -np.inf, (reach - loosened) * (1 - _SLACK) - _SLACK)
    upper = np.where(new, np.inf, reach[rows, cluster] + loosened[rows, cluster])
    lower[rows, cluster] = np.inf
    open_ones = upper * (1 + _SLACK) + _SLACK >= lower.min(axis=1, initial=np.inf)
    own = rows if exact_own else np.flatnonzero(open_ones)
    evaluated = 0
    if len(own):
        near = _distances(vectors[own], centroids[cluster[own]])
        known[own, cluster[own]], since[own, cluster[own]] = near, now
        upper[own] = np.sqrt(near.astype(float))
        evaluated += len(own)
    failing = open_ones[:, None] & (lower <= (upper * (1 + _SLACK) + _SLACK)[:, None])
    for number in numbers:
        at = np.flatnonzero(failing[:, number])
        if len(at):
            known[at, number] = _distances(vectors[at], centroids[number])
            since[at, number] = now
            evaluated += len(at)
    again = np.flatnonzero(failing.any(axis=1))
    # The first of equal distances has the smallest number.
    fresh = np.where(since[again] == now, known[again], _FAR)
    cluster[again] = fresh.argmin(axis=1)
    return evaluated


def _advance(history: list[np.ndarray], last: bool):
    """One round for the batches of a task."""
    count, width = history[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["vector"], width).astype(np.int64)
            if np.abs(vectors).max(initial=0) > MAX_COMPONENT:
                raise ValueError(f"components beyond {MAX_COMPONENT} have no exact distance")
            size = len(vectors)
            if "cluster" in batch.schema.names:
                cluster = batch["cluster"].to_numpy().astype(np.int32)
                known = matrix(batch["known"], count).astype(np.int64)
                since = matrix(batch["since"], count).astype(np.int32)
                before = batch["evaluations"].to_numpy()
            else:
                cluster = np.zeros(size, np.int32)
                known = np.zeros((size, count), np.int64)
                since = np.full((size, count), -1, np.int32)
                before = np.zeros(size, np.int64)
            assign(vectors, cluster, known, since, history, last)
            done = before + (since == len(history) - 1).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["vector"],
                    pa.array(cluster, pa.int32()),
                    lists_of(known, pa.int64()),
                    lists_of(since, pa.int32()),
                    pa.array(done, pa.int64()),
                ],
                ["id", "vector", "cluster", "known", "since", "evaluations"],
            )

    return run


def _partial_sums(count: int, width: int):
    """Per task and non-empty cluster: number of vectors and sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            cluster = batch["cluster"].to_numpy()
            np.add.at(sums, cluster, matrix(batch["vector"], width))
            sizes += np.bincount(cluster, minlength=count)
        met = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(met))),
                pa.array(sums[met].ravel()),
                pa.array(np.repeat(sizes[met], width)),
            ],
            ["cluster", "place", "total", "size"],
        )

    return run


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of the clusters; an empty one stays where it is."""
    count, width = centroids.shape
    sums = (
        state.select("cluster", "vector")
        .mapInArrow(_partial_sums(count, width), "cluster int, place int, total long, size long")
        .groupBy("cluster", "place")
        .agg(
            F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("size").alias("size")
        )
    )
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["size"]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    factor: int = FACTOR,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: id, `cluster`, `distance`, `cluster_inertia`, `inertia`,
    `centroid_sha256` and `evaluations`, the number of distances that were evaluated for it.

    Vectors with exactly `components` components, none null or non-finite, take part; each
    component x becomes floor(factor * x). Centroids start as the vectors whose
    `<seed>:<id>` has the smallest SHA-256, in that order (of one repeated id: smaller
    components first); a row without an id starts none, but is clustered. With fewer vectors
    than `clusters` there are as many centroids as vectors. Rows that repeat count each; other
    columns are not read. An empty table, or one without usable vectors, gives an empty result.
    A component beyond `MAX_COMPONENT` after scaling is an error.
    """
    spark = vectors.sparkSession
    vector = F.col("vector")
    kept = store(
        named(vectors, id=id_col, vector=vector_col)
        .where(is_finite(vector) & (F.size(vector) == components))
        .select("id", whole(vector, factor).alias("vector"))
    )
    marked = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = (
        kept.where("id IS NOT NULL")
        .select("vector", marked.alias("mark"))
        .orderBy("mark", "vector")
        .limit(clusters)
        .collect()
    )
    id_type = kept.schema["id"].dataType
    state_schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("vector", T.ArrayType(T.LongType())),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("known", T.ArrayType(T.LongType())),
            T.StructField("since", T.ArrayType(T.IntegerType())),
            T.StructField("evaluations", T.LongType()),
        ]
    )
    if not first:
        kinds = {
            "cluster": "int",
            "distance": "long",
            "cluster_inertia": "long",
            "inertia": "long",
            "centroid_sha256": "string",
            "evaluations": "long",
        }
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
        return kept.where("false").select(F.col("id").alias(id_col), *nothing)
    history = [np.array([row["vector"] for row in first], np.int64).reshape(-1, components)]
    state = store(kept.mapInArrow(_advance(history, rounds == 0), state_schema))
    for number in range(1, rounds + 1):
        history.append(_moved(state, history[-1]))
        state = store(state.mapInArrow(_advance(history, number == rounds), state_schema))
    # The last round evaluated every vector's distance to its centroid.
    own = F.element_at("known", F.col("cluster") + 1)
    placed = state.select("id", "cluster", own.alias("distance"), "evaluations")
    spread = {
        row["cluster"]: int(row["inertia"])
        for row in placed.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia"))
        .collect()
    }
    final = [
        (number, spread[number], sum(spread.values()), _digest(history[-1][number]))
        for number in spread
    ]
    facts = spark.createDataFrame(
        final, "number int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per cluster, whose number is a parameter.
    return placed.join(F.broadcast(facts), F.col("cluster") == F.col("number")).select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
        "evaluations",
    )


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
