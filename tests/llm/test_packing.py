import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trapiche.llm.packing import WEIGHTS, best_fit, pack_documents, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (1, "Hello, world! It's 2024."),
    (2, None),
    (3, ""),
    (4, " \n"),
    (5, "word " * 9_000),
    (6, "<|endoftext|> x <|ENDOFTEXT|>, y"),
    (7, "Straße!! É́ H̱ Σας ΟΔΟΣ… o'clock, 'TIS"),
    (8, "x\x1cy\x85z w\xa0v"),
    (9, "é. a,́ b"),
]
LATIN = [
    "Cœur ªº µ ÀÉ×÷ Ǆ ǅ İstanbul ɏ",
    "a1b2 !!x!! (y) – “z” … 3.14",
    "x\x1cy z\x85w a\xa0b",
    "ça%%% réeux*** d&&& STRASSE ẞ",
    "<tag> < | a|b",
]


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("text", [t for _, t in ROWS] + LATIN)
def test_ids_word_by_word_equal_ids_of_the_whole_text(text):
    (found,) = token_ids([text], PATH)
    assert list(found) == plain_ids(text)[:-1]


def test_ids_of_many_texts_in_order(monkeypatch):
    monkeypatch.setattr("trapiche.llm.packing.SLICE_BYTES", 20)
    monkeypatch.setattr("trapiche.llm.packing.WORDS_KEPT", 10)
    texts = [text for _, text in ROWS] + LATIN
    found = [list(ids) for ids in token_ids(texts, PATH)]
    assert found == [plain_ids(text)[:-1] for text in texts]


@pytest.mark.parametrize("limit", [16, 4096])
def test_round_trip(documents, limit):
    found = pack_documents(documents(ROWS), PATH, limit=limit).collect()
    ids = {own: plain_ids(text) for own, text in ROWS}
    by_document, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        by_document[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert set(by_document) == set(ids)
    for own, rows in by_document.items():
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == [i * limit for i in range(len(rows))]
        assert sum(r["length"] for r in rows) == len(ids[own])
        assert all(r["length"] == limit for r in rows[:-1])
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= limit


def test_best_fit_is_near_the_lower_bound():
    lengths = np.random.default_rng(3).integers(1, 2_000, 3_000)
    bins, offsets = best_fit(lengths, 4_096)
    assert bins.max() + 1 <= np.ceil(lengths.sum() / 4_096) + 2
    assert np.bincount(bins, lengths).max() <= 4_096


@pytest.mark.parametrize("score", ["dot", "norm"])
def test_every_capacity_binds(score):
    lengths = np.random.default_rng(4).integers(1, 60, 400)
    bins, _ = best_fit(
        lengths, 100, max_documents=4, max_attention=3_600, weights=(1.0, 0.5, 0.5), score=score
    )
    assert np.bincount(bins).max() <= 4
    assert np.bincount(bins, lengths).max() <= 100
    assert np.bincount(bins, lengths**2.0).max() <= 3_600


def test_best_fit_takes_the_fullest_bin_and_refuses_what_fits_nowhere():
    bins, offsets = best_fit(np.array([60, 70, 30, 40]), 100)
    assert bins.tolist() == [1, 0, 0, 1] and offsets.tolist() == [0, 0, 70, 60]
    with pytest.raises(ValueError):
        best_fit(np.array([5]), 4)


def test_blocks_repeats_nulls_and_empty_table(documents):
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    clash = documents(rows).withColumn("id", F.lit("own")).withColumn("piece", F.lit(0))
    found = pack_documents(clash, PATH, block_pieces=1).collect()
    assert sorted(r["length"] for r in found) == [2, 3, 3]
    assert sum(r["doc_id"] is None for r in found) == 1
    assert pack_documents(documents([]), PATH).collect() == []


def test_rows_that_are_alike_spread_over_the_blocks(documents):
    rows = [(None, None)] * 600 + [(i, "a b") for i in range(1_200)]
    found = pack_documents(documents(rows), PATH, block_pieces=100).collect()
    assert len(found) == 1_800
    sizes = Counter(r["sequence_id"] >> 32 for r in found)
    assert len(sizes) == 18 and max(sizes.values()) < 200


def test_the_default_weights_cost_no_sequences():
    lengths = np.random.default_rng(5).lognormal(6, 1.2, 5_000).astype(int).clip(1, 4_096)
    tokens_alone, _ = best_fit(lengths, 4_096)
    all_three, _ = best_fit(lengths, 4_096, weights=WEIGHTS)
    assert all_three.max() <= tokens_alone.max()
