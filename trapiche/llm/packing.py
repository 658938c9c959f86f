"""Best-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trapiche.llm.common import named, row_count
from trapiche.sinks.writers import store

SEQUENCE_TOKENS = 4096
END_ID = 1
# Pieces packed together; blocks are dealt by hash, so their sizes are even.
BLOCK_PIECES = 20_000
# How much tokens, documents and attention cost left over count in the choice of a bin.
WEIGHTS = (1.0, 1.0, 1.0)
# Words, and parts of words, that a worker keeps with their ids (about 250 bytes each).
WORDS_KEPT = 500_000
# Bytes of text encoded at a time, which bounds the memory of a very long text.
SLICE_BYTES = 1 << 23
PIECE_SCHEMA = "id long, piece int, start long, length long, ids_crc32 long"


# Letters of the Latin blocks of Unicode, and those of them that are lower case and composed.
_LETTERS = "a-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
# Runs of letters, and runs of neither letters nor ASCII white space.
_RUNS = re.compile(f"[{_LETTERS}]+|[^{_LETTERS} \t-\r]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Other scripts and marks that may join a letter; punctuation marks are none of them.
_OTHER = re.compile("[^\0-ɏ‐-‧‰-⁞]")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}


class _WordEncoder:
    """Ids of distinct words, kept from batch to batch of a worker."""

    def __init__(self, path: str) -> None:
        # Threads of its own would only compete with the other tasks of the executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        described |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(described))
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian; words that are not known yet are learned together."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        if len(self.parts) > WORDS_KEPT:
            self.parts.clear()
        new = {word: word_parts(word) for word in set(words).difference(self.words)}
        self._learn({part for parts in new.values() for part in parts})
        for word, parts in new.items():
            self.words[word] = b"".join([self.parts[part] for part in parts])
        return list(map(self.words.__getitem__, words))

    def _learn(self, parts: set[str]) -> None:
        new = parts.difference(self.parts)
        plain = [part for part in new if _PLAIN.fullmatch(part)]
        # Such parts are one piece to the tokenizer and in its normal form already.
        spelled = [p.encode().decode("latin-1").translate(self.letters) for p in plain]
        other = list(new.difference(plain))
        for found, tokenizer, texts in (
            (plain, self.merges, spelled),
            (other, self.whole, other),
        ):
            encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for part, ids in zip(found, encoded):
                self.parts[part] = np.array(ids.ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str) -> _WordEncoder:
    return _WordEncoder(path)


def word_parts(word: str) -> list[str]:
    """Parts of a word that the tokenizer never joins: their ids in a row are the word's ids.

    A run of letters never shares a token with its neighbours. Words with contractions, special
    tokens or other scripts stay whole; in the others case is dropped before, as the tokenizer
    does, so that more parts are alike.
    """
    if "'" in word or "<|" in word or not (word.isascii() or _OTHER.search(word) is None):
        return [word]
    return _RUNS.findall(word.lower())


def _slices(text: bytes) -> Iterator[bytes]:
    """The text cut before white space into slices of bounded size; a longer word stays whole."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        space = _SPACE.search(text, start + SLICE_BYTES)
        if not space:
            break
        yield text[start : space.start()]
        start = space.start()
    yield text[start:]


def token_ids(texts: Iterable[str | None], path: str) -> Iterator[np.ndarray]:
    """Ids of each whole text, in order.

    The tokenizer never joins characters across white space, so each distinct word of some
    neighbouring texts is encoded once. Words are cut at the six ASCII white space characters;
    any other white space stays inside its word.
    """
    short: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode()
        if size + len(data) > SLICE_BYTES:
            yield from _ids_of(short, path)
            short, size = [], 0
        if len(data) > SLICE_BYTES:
            # One slice at a time; only the ids of a long text are held whole.
            yield np.concatenate([ids for part in _slices(data) for ids in _ids_of([part], path)])
        else:
            short.append(data)
            size += len(data)
    yield from _ids_of(short, path)


def _ids_of(texts: list[bytes], path: str) -> Iterator[np.ndarray]:
    """Ids of each text: distinct words are encoded, and their ids gathered in text order."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    words = lists.flatten().dictionary_encode()
    encoded = _encoder(path).encode(words.dictionary.to_pylist())
    flat = np.frombuffer(b"".join(encoded), dtype="<u4")
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    starts = np.cumsum(sizes) - sizes
    at = words.indices.to_numpy()
    lengths = sizes[at]
    ends = np.cumsum(lengths)
    place = np.repeat(starts[at] - ends + lengths, lengths) + np.arange(lengths.sum())
    gathered = flat[place]
    bounds = np.append(0, ends)[lists.offsets.to_numpy()]
    for begin, end in zip(bounds, bounds[1:]):
        yield gathered[begin:end]


def pieces_of(ids: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of each piece of a document's ids."""
    for piece, start in enumerate(range(0, len(ids), limit)):
        part = ids[start : start + limit]
        yield piece, start, len(part), zlib.crc32(part.tobytes())


def tokenised_pieces(
    docs: DataFrame, path: str, limit: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """`docs(id, text)` -> one row per piece of at most `limit` tokens, the end id included."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            texts = (text.as_py() for text in batch["text"])
            for own, ids in zip(batch["id"].to_pylist(), token_ids(texts, path)):
                rows.extend((own, *piece) for piece in pieces_of(np.append(ids, end), limit))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

    return docs.select("id", "text").mapInArrow(cut, PIECE_SCHEMA)


def best_fit(
    lengths: np.ndarray,
    limit: int = SEQUENCE_TOKENS,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    score: str = "dot",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; longest pieces first, each to the best bin that takes it.

    A bin has three capacities: tokens, documents, and attention cost (the sum of squared
    lengths). A piece goes only to a bin with room in all three. Of those the one is chosen
    whose capacities left over, as shares of a whole bin, are smallest: by the weighted
    dot-product with the piece's own shares ("dot"), or by their weighted norm ("norm").
    Ties go to the oldest bin. A limit of None never binds: no bin can exceed it.
    """
    whole = np.array([limit, max_documents or limit, max_attention or limit * limit], float)
    w = np.array(weights, float)
    if score not in ("dot", "norm"):
        raise ValueError("score is 'dot' or 'norm'")
    room = np.empty((3, len(lengths)), float)
    opened = np.zeros(len(lengths), np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    # Positions below `live` are bins that may still take a piece.
    live = made = 0
    order = np.argsort(-lengths, kind="stable")
    shortest = lengths.min() if len(lengths) else 0
    for i in order:
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        if np.any(need > whole):
            raise ValueError(f"a piece of {lengths[i]} tokens exceeds the capacities of a bin")
        at = -1
        if live:
            left = room[:, :live] - need[:, None]
            fits = np.flatnonzero((left >= 0).all(axis=0))
            if len(fits):
                share = left[:, fits] / whole[:, None]
                cost = (w * need / whole) @ share if score == "dot" else w @ share**2
                at = fits[np.argmin(cost)]
        if at < 0:
            at, opened[live], room[:, live] = live, made, whole
            live, made = live + 1, made + 1
        bins[i], offsets[i] = opened[at], limit - room[0, at]
        room[:, at] -= need
        if room[0, at] < shortest or room[1, at] < 1:
            # A full bin leaves: the others keep their order.
            room[:, at : live - 1] = room[:, at + 1 : live]
            opened[at : live - 1] = opened[at + 1 : live]
            live -= 1
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    score: str = "dot",
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """One row per piece: its document, place in the document, checksum, sequence and offset.

    A null text counts as empty and still gives the end id. Rows that repeat are packed like
    any other. A null id stays null. An empty table gives no pieces. The table's other columns
    are not read, so their names cannot clash. Pieces are dealt to blocks of about
    `block_pieces` by a hash of the number each is stored with, so pieces that are alike spread
    as others do; one task packs a block, and only (length) columns travel. Each block ends with
    at most one badly filled sequence, a share of 1 in thousands. Where documents and attention
    are not limited, a bin's tokens bound them, and they count in the choice by `weights`.
    """
    pieces = tokenised_pieces(named(docs, id=id_col, text=text_col), tokenizer_path, limit, end_id)
    # Stored, so that a piece keeps its number when a task runs again.
    pieces = store(pieces.withColumn("number", F.monotonically_increasing_id()))
    blocks = max(1, round(row_count(pieces) / block_pieces))

    def pack(block: pa.Table) -> pa.Table:
        # The order of the rows of a shuffle is not fixed; the packing should be.
        block = block.sort_by([(c, "ascending") for c in ("id", "piece", "ids_crc32", "number")])
        bins, offsets = best_fit(
            block["length"].to_numpy(), limit, max_documents, max_attention, weights, score
        )
        number = block["block"].to_numpy().astype(np.int64)
        block = block.drop_columns(["block", "number"])
        block = block.append_column("sequence_id", pa.array((number << 32) + bins))
        return block.append_column("offset", pa.array(offsets))

    block = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")
    packed = (
        pieces.withColumn("block", block)
        .groupBy("block")
        .applyInArrow(pack, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    )
    return packed.withColumnRenamed("id", id_col)
