"""Substring duplicates by super-k-mer partitioning of word windows.

A window is a fixed number of consecutive words. Consecutive windows of a document that share
their minimiser, the least hash among their short runs of words, travel together as one packed
string to the bucket of that minimiser, so equal windows always meet. In the bucket windows are
named exactly by sorting, and every window of a document is dropped whose words also start in a
document with a smaller id.

A minimiser that one document alone has cannot belong to a repeated window: minimisers are
counted first, and only runs of shared ones travel. A minimiser of very many documents or windows
does not travel as strings: its windows are compared by 128-bit digests, first within each
batch of a task, where all but the smallest id are settled at once, then between batches in
slots by digest. So a passage that a third of all documents hold crosses the shuffle once per
batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import named
from trapiche.llm.key_filter import key_filter
from trapiche.llm.windows import minimisers, runs_of, window_names, word_hashes
from trapiche.sinks.writers import store

WINDOW_WORDS = 50
MINIMISER_WORDS = 8
# Documents of one minimiser above which its windows are settled by digest, and windows: a long
# text that repeats a few words may have very many of one minimiser.
HOT_DOCUMENTS = 1_000
HOT_WINDOWS = 50_000
# Windows by digest that one task compares, about.
SLOT_WINDOWS = 500_000
# Bytes of packed strings whose windows are sorted together.
CHUNK_BYTES = 1 << 23
# Stands for a missing id: the largest, so such a row takes nothing from others.
NO_ID = (1 << 63) - 1

_WINDOW = np.dtype(
    [("high", "<u8"), ("low", "<u8"), ("id", "<i8"), ("mark", "<i8"), ("begin", "<i8")]
)
_SPANS = ["id", "mark", "begin", "end"]
_SPAN_SCHEMA = "id long, mark long, begin long, end long"


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, int]]:
    """(id, mark, text, row) of each row that has a text."""
    ids, marks = batch["id"].to_pylist(), batch["mark"].to_pylist()
    for row in range(batch.num_rows):
        text = batch["text"][row]
        if text.is_valid:
            yield ids[row], marks[row], text.as_buffer().to_pybytes(), row


def _spans(at: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Ascending starts of windows as the stretches of words that they cover."""
    if len(at) == 0:
        return []
    breaks = np.flatnonzero(np.diff(at) > window)
    begins, ends = at[np.append(0, breaks + 1)], at[np.append(breaks, len(at) - 1)] + window
    return list(zip(begins.tolist(), ends.tolist()))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _tuples(window: int, size: int):
    """Each minimiser of each document, once, with its number of windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (own, mark, *_counted(minimisers(word_hashes(text), window, size)))
                for own, mark, text, _ in _texts(batch)
            ]
            sizes = [len(f[2]) for f in found]
            each = np.concatenate([f[2] for f in found] or [np.zeros(0, np.uint64)])
            windows = np.concatenate([f[3] for f in found] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_signed(each)),
                    pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)),
                    pa.array(np.repeat(np.array([f[1] for f in found], np.int64), sizes)),
                    pa.array(windows.astype(np.int64)),
                ],
                ["minimiser", "id", "mark", "windows"],
            )

    return emit


def _wanted_runs(
    text: bytes, wanted: list[int], window: int, size: int
) -> Iterator[tuple[int, int, int]]:
    """(minimiser, first window, windows) of each run whose minimiser is wanted."""
    least = minimisers(word_hashes(text), window, size)
    starts, lengths = runs_of(least)
    keys = _signed(least[starts])
    chosen = np.isin(keys, np.array(wanted, np.int64))
    return zip(keys[chosen].tolist(), starts[chosen].tolist(), lengths[chosen].tolist())


def _super_kmers(window: int, size: int):
    """Packed strings of the runs whose minimiser several documents share, hot ones aside."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, rows = batch["shared"].to_pylist(), []
            for own, mark, text, row in _texts(batch):
                wanted = [s["minimiser"] for s in shared[row] if not s["hot"]]
                words = text.split() if wanted else []
                for key, first, count in _wanted_runs(text, wanted, window, size) if wanted else ():
                    packed = b" ".join(words[first : first + count + window - 1])
                    rows.append((key, own, mark, first, packed))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield _columns(rows, ["minimiser", "id", "mark", "first", "packed"], kinds)

    return emit


def _repeats(table: pa.Table, window: int) -> pa.RecordBatch:
    """Stretches of words to drop, of the super-k-mers of whole buckets."""
    lists = pc.split_pattern(table["packed"].combine_chunks().cast(pa.string()), " ")
    words = lists.flatten().dictionary_encode().indices.to_numpy()
    ids, marks, first = (table[c].to_numpy() for c in ("id", "mark", "first"))
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - (np.cumsum(sizes) - sizes)[row]
    starts = np.flatnonzero(place <= sizes[row] - window)
    names, row, place = window_names(words, window)[starts], row[starts], place[starts]
    least = np.full(names.max() + 1, NO_ID)
    np.minimum.at(least, names, ids[row])
    repeated = ids[row] > least[names]
    row, begin = row[repeated], first[row[repeated]] + place[repeated]
    rows, bounds = [], np.flatnonzero(np.diff(row)) + 1
    for of, at in zip(np.split(row, bounds), np.split(begin, bounds)):
        rows.extend((ids[of[0]], marks[of[0]], *span) for span in _spans(at, window))
    return _columns(rows, _SPANS, [pa.int64()] * 4)


def _bucket_repeats(window: int):
    """Buckets in order of their minimiser; whole buckets are taken together up to a size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) < CHUNK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            keys = table["minimiser"].to_numpy()
            # The last bucket may go on in the next batch.
            earlier = np.flatnonzero(keys != keys[-1])
            whole = int(earlier[-1]) + 1 if len(earlier) else 0
            if whole:
                yield _repeats(table.slice(0, whole), window)
            held = table.slice(whole).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            if len(table):
                yield _repeats(table, window)

    return count


def _settled(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted by digest and id, and which of them repeat one with a smaller id."""
    windows = windows[np.lexsort((windows["id"], windows["low"], windows["high"]))]
    same = (windows["high"][1:] == windows["high"][:-1]) & (
        windows["low"][1:] == windows["low"][:-1]
    )
    starts = np.flatnonzero(np.append(True, ~same))[: len(windows)]
    least = np.repeat(windows["id"][starts], np.diff(np.append(starts, len(windows))))
    return windows, windows["id"] > least


def _span_rows(windows: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Stretches that the windows cover, document by document."""
    windows = windows[np.lexsort((windows["begin"], windows["mark"], windows["id"]))]
    new = (np.diff(windows["id"]) != 0) | (np.diff(windows["mark"]) != 0)
    rows = []
    for part in np.split(windows, np.flatnonzero(new) + 1) if len(windows) else []:
        own, mark = int(part["id"][0]), int(part["mark"][0])
        rows.extend((own, mark, *span) for span in _spans(part["begin"], window))
    return rows


def _hot_windows(window: int, size: int, slots: int):
    """Settle the windows of hot minimisers within a batch; the rest goes to slots, packed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_SPANS, "slot", "packed"]
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
        for batch in batches:
            shared, found = batch["shared"].to_pylist(), []
            for own, mark, text, row in _texts(batch):
                wanted = [s["minimiser"] for s in shared[row] if s["hot"]]
                words = text.split()
                for _, first, count in _wanted_runs(text, wanted, window, size):
                    for at in range(first, first + count):
                        joined = b" ".join(words[at : at + window])
                        digest = hashlib.blake2b(joined, digest_size=16).digest()
                        found.append((digest, own, mark, at))
            windows = np.zeros(len(found), _WINDOW)
            if found:
                digests = np.frombuffer(b"".join(f[0] for f in found), "<u8")
                windows["high"], windows["low"] = digests[::2], digests[1::2]
                for i, field in enumerate(("id", "mark", "begin"), 1):
                    windows[field] = [f[i] for f in found]
            windows, repeated = _settled(windows)
            rows = [(*span, None, None) for span in _span_rows(windows[repeated], window)]
            open_ones = windows[~repeated]
            slot = (open_ones["high"] % np.uint64(slots)).astype(np.int64)
            for number in np.unique(slot):
                packed = open_ones[slot == number].tobytes()
                rows.append((None, None, None, None, int(number), packed))
            yield _columns(rows, names, kinds)

    return emit


def _slot_repeats(window: int):
    def settle(group: pa.Table) -> pa.Table:
        packed = np.frombuffer(b"".join(group["packed"].to_pylist()), _WINDOW)
        windows, repeated = _settled(packed)
        rows = _span_rows(windows[repeated], window)
        return pa.Table.from_batches([_columns(rows, _SPANS, [pa.int64()] * 4)])

    return settle


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the stretches to drop."""
    names = ["id", "n_words", "n_removed", "kept_text", "spans"]
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
    for batch in batches:
        ids, spans, rows = batch["id"].to_pylist(), batch["spans"].to_pylist(), []
        for row in range(batch.num_rows):
            text = batch["text"][row]
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            merged: list[list[int]] = []
            for s in sorted(spans[row] or [], key=lambda s: s["begin"]):
                if merged and s["begin"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["end"])
                else:
                    merged.append([s["begin"], s["end"]])
            kept, last = [], 0
            for begin, end in merged:
                kept += words[last:begin]
                last = end
            kept += words[last:]
            own = ids[row] if batch["has_id"][row].as_py() else None
            joined = b" ".join(kept).decode("utf-8", "surrogatepass")
            found = [{"begin": begin, "end": end} for begin, end in merged]
            rows.append((own, len(words), len(words) - len(kept), joined, found))
        yield _columns(rows, names, kinds)


def drop_repeated_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW_WORDS,
    minimiser_words: int = MINIMISER_WORDS,
    hot_documents: int = HOT_DOCUMENTS,
    hot_windows: int = HOT_WINDOWS,
) -> DataFrame:
    """One row per document: id, `n_words`, `n_removed`, `kept_text` and the dropped `spans`.

    Words are cut at the six ASCII white space characters and kept unchanged. A word goes if a
    window that covers it also starts in a document with a smaller id; windows are judged on the
    input. Texts shorter than a window, empty and null texts lose nothing (null: no words, empty
    kept text). A row without an id counts as later than all others. Rows that repeat with one
    id do not take words from each other. Other columns are not read. An empty table gives an
    empty result.
    """
    size = min(minimiser_words, window)
    rows = named(docs, id=id_col, text=text_col).select(
        F.coalesce("id", F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("mark"),
        "text",
        F.col("id").isNotNull().alias("has_id"),
    )
    rows = rows.withColumn("key", F.xxhash64("id", "mark"))
    tuples = store(
        rows.select("id", "mark", "text").mapInArrow(
            _tuples(window, size), "minimiser long, id long, mark long, windows long"
        )
    )
    counted = tuples.groupBy("minimiser").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("windows").alias("all_windows")
    )
    is_hot = (F.col("documents") > hot_documents) | (F.col("all_windows") > hot_windows)
    shared = store(
        counted.where("documents > 1").select("minimiser", "all_windows", is_hot.alias("hot"))
    )
    wanted = store(
        tuples.select("minimiser", "id", "mark")
        .join(shared, "minimiser")
        .groupBy("id", "mark")
        .agg(F.collect_set(F.struct("minimiser", "hot")).alias("shared"))
    )

    def holding(keys: DataFrame) -> Column:
        """Whether a row's key may be among those of `keys`, which no other text has to meet."""
        marked = keys.select(F.xxhash64("id", "mark").alias("key")).distinct()
        return key_filter(marked).test(F.col("key"))

    holds_shared = holding(wanted)
    texts = rows.where(holds_shared).select("id", "mark", "text").join(wanted, ["id", "mark"])
    cold = (
        texts.mapInArrow(
            _super_kmers(window, size),
            "minimiser long, id long, mark long, first long, packed binary",
        )
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(_bucket_repeats(window), _SPAN_SCHEMA)
    )
    occurrences = shared.where("hot").agg(F.coalesce(F.sum("all_windows"), F.lit(0))).first()[0]
    found = cold
    if occurrences:
        slots = 1 + occurrences // SLOT_WINDOWS
        has_hot = wanted.where(F.exists("shared", lambda s: s["hot"]))
        settled = store(
            rows.where(holds_shared)
            .select("id", "mark", "text")
            .join(has_hot, ["id", "mark"])
            .mapInArrow(
                _hot_windows(window, size, slots), f"{_SPAN_SCHEMA}, slot int, packed binary"
            )
        )
        between = (
            settled.where("slot IS NOT NULL")
            .select("slot", "packed")
            .groupBy("slot")
            .applyInArrow(_slot_repeats(window), _SPAN_SCHEMA)
        )
        found = cold.union(settled.where("slot IS NULL").select(*_SPANS)).union(between)
    spans = store(
        found.groupBy("id", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    )
    # Texts that lose nothing are cut where they are read.
    loses = holding(spans)
    whole = rows.where(~loses).withColumn(
        "spans", F.lit(None).cast("array<struct<begin: long, end: long>>")
    )
    some = rows.where(loses).join(spans, ["id", "mark"], "left")
    columns = ["id", "has_id", "text", "spans"]
    cut = whole.select(columns).union(some.select(columns))
    return cut.mapInArrow(
        _cut,
        "id long, n_words long, n_removed long, kept_text string, "
        "spans array<struct<begin: long, end: long>>",
    ).withColumnRenamed("id", id_col)
