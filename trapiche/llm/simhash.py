"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import copy_number, fresh, named
from trapiche.llm.components import connected_components
from trapiche.sinks.writers import store

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEGMENTS = 2
HASH_SEED = 42
# Shingles counted at a time, which bounds the memory of a very long text.
BLOCK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bits that more than half of the shingle hashes set; 0 for a text without words."""
    # bytes.split() cuts at exactly the six white space bytes of the contract.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle_words, len(words))
    count = len(words) - size + 1
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, count, BLOCK):
        block = words[start : start + BLOCK + size - 1]
        shingles = map(b" ".join, zip(*[block[i:] for i in range(size)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > count).tobytes(), "big", signed=True)


def fingerprint_of(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a column that is never null, so that no join tests it for null first."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle_words) for t in batch], dtype="int64")

    return F.coalesce(prints(text), F.lit(0))


def _ball(width: int, radius: int) -> list[int]:
    """Every mask of at most `radius` of `width` bits."""
    return [
        sum(1 << bit for bit in bits)
        for size in range(radius + 1)
        for bits in combinations(range(width), size)
    ]


def close_pairs(prints: DataFrame, max_distance: int, segments: int = SEGMENTS) -> DataFrame:
    """Pairs `(a, b)`, a < b, of distinct fingerprints that differ in at most `max_distance` bits.

    Of `segments` equal parts of two such fingerprints, one differs in at most
    max_distance // segments bits. Every fingerprint is entered in one table per segment, and
    probes it with the small ball around its own part; the distance of the whole fingerprint
    is verified inside the join.
    """
    width = BITS // segments
    masks = F.array(*[F.lit(m) for m in _ball(width, max_distance // segments)])
    low = F.lit((1 << width) - 1)
    parts = [
        F.struct(
            F.lit(i).alias("segment"),
            F.shiftrightunsigned("print", width * i).bitwiseAND(low).alias("part"),
        )
        for i in range(segments)
    ]
    table = prints.select(F.col("print").alias("b"), F.inline(F.array(*parts)))
    probes = table.select(
        F.col("b").alias("a"),
        F.col("segment").alias("probe_segment"),
        F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("part")))).alias("probe"),
    )
    near = (
        (F.col("probe_segment") == F.col("segment"))
        & (F.col("probe") == F.col("part"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    )
    return probes.join(table, near).select("a", "b").distinct()


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Every row with `fingerprint`, `component_id` and `kept` beside its own columns.

    Names that `docs` has already get an underscore. Texts without words, and null texts, have
    fingerprint zero and are linked like any other. The component is the smallest id reachable
    over links; a row stays if that is its own id, and of rows that repeat with one id and one
    fingerprint exactly one stays. Components of rows without any id have a null id. An empty
    table gives an empty result. Equal fingerprints meet once, as one node of the graph, so a
    group of copies adds no pairs.
    """
    prints = named(docs, id=id_col, text=text_col).select(
        "id", fingerprint_of(F.col("text"), shingle_words).alias("print")
    )
    nodes = store(prints.groupBy("print").agg(F.min("id").alias("least_id")))
    roots = connected_components(close_pairs(nodes.select("print"), max_distance))
    rooted = nodes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least_id"
    )
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least_id").alias("component"))
    # Stored: the join with the rows then reads two plain shuffles, which can be split.
    classes = store(
        rooted.join(smallest, F.col("root") == F.col("of")).select(
            F.col("print").alias("class_print"), "component"
        )
    )
    mark, copy = fresh(docs, "print", "copy")
    rows = docs.withColumn(mark, fingerprint_of(F.col(f"`{text_col}`"), shingle_words))
    rows = rows.withColumn(copy, copy_number(docs, id_col, [f"`{id_col}`", mark]))
    result = fresh(docs, "fingerprint", "component_id", "kept")
    own = F.col(f"rows.`{id_col}`")
    component = F.col("classes.component")
    return rows.alias("rows").join(
        classes.alias("classes"), F.col(f"rows.{mark}") == F.col("classes.class_print")
    ).select(
        *[F.col(f"rows.`{c}`") for c in docs.columns],
        F.lpad(F.lower(F.hex(F.col(f"rows.{mark}"))), 16, "0").alias(result[0]),
        component.alias(result[1]),
        (own.eqNullSafe(component) & (F.col(f"rows.{copy}") == 1)).alias(result[2]),
    )
