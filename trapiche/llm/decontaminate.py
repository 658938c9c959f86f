"""Benchmark items found in documents within an edit budget."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import named

ERROR_RATE = 0.1
# Shorter items are searched for exactly: a few edits would turn them into something else.
LEAST_FUZZY_CHARS = 40
# Characters of items that a task searches for at a time; more items go in further passes.
BLOCK_CHARS = 4_000_000
MATCH_SCHEMA = "id long, item_id long, distance int, match_end long"

_OTHER = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """Lower case, everything but letters and digits as one space, trimmed."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def error_budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(rate * length) if length >= LEAST_FUZZY_CHARS else 0


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 parts of even length: `budget` edits spare one of them."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of `item` in `text` within the budget, first of ties.

    One column of the edit matrix is held in two bit vectors, of vertical steps up and down.
    """
    size = len(item)
    where: dict[str, int] = defaultdict(int)
    for i, char in enumerate(item):
        where[char] |= 1 << i
    every, last = (1 << size) - 1, 1 << (size - 1)
    up, down, score = every, 0, size
    best = None
    for end, char in enumerate(text, 1):
        match = where.get(char, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right_up = down | ~(diagonal | up) & every
        right_down = up & diagonal
        if right_up & last:
            score += 1
        elif right_down & last:
            score -= 1
        right_up = right_up << 1 & every
        right_down = right_down << 1 & every
        vertical = match | down
        up = right_down | ~(vertical | right_up) & every
        down = right_up & vertical
        if score <= budget and (best is None or score < best[0]):
            best = (score, end)
    return best


def _partner(parts: list[tuple[int, str]], number: int) -> tuple[int, str, str] | None:
    """(side, inner half, outer half) of the other piece of a pair, None for one without."""
    other = number ^ 1
    if other >= len(parts):
        return None
    text = parts[other][1]
    half = len(text) // 2
    if other > number:
        return 1, text[:half], text[half:]
    return -1, text[half:], text[:half]


def _beside(text: str, begin: int, end: int, partner: tuple[int, str, str]) -> bool:
    """Whether one half of the partner stands where one edit at most would leave it."""
    side, inner, outer = partner
    if side > 0:
        near = end + len(inner)
        return text.startswith(inner, end) or outer in text[near - 1 : near + len(outer) + 1]
    near = begin - len(inner)
    if near >= 0 and text.startswith(inner, near):
        return True
    return outer in text[max(0, near - len(outer) - 1) : max(0, near + 1)]


class Searcher:
    """All pieces of a set of items in one automaton.

    Pieces go in pairs. Of budget + 1 pieces with at most `budget` edits, some pair has one edit
    at most (or the odd last piece has none), so a piece that hits is followed up only if a half
    of its partner stands beside it.
    """

    def __init__(self, items: Iterable[tuple[int, str]], rate: float) -> None:
        self.items: list[tuple[int, str, int]] = []
        places: dict[str, list[tuple]] = defaultdict(list)
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            budget = error_budget(len(text), rate)
            parts = pieces(text, budget)
            for number, (start, piece) in enumerate(parts):
                places[piece].append((len(self.items), start, _partner(parts, number)))
            self.items.append((item_id, text, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item id, distance, end) of each item that the plain text holds, at its best place."""
        if not self.items:
            return
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for last, (size, found) in self.automaton.iter(text):
            for index, start, partner in found:
                if partner and not _beside(text, last + 1 - size, last + 1, partner):
                    continue
                _, item, budget = self.items[index]
                begin = last + 1 - size - start
                low, high = max(0, begin - budget), min(len(text), begin + len(item) + budget)
                spans = windows[index]
                if spans and low <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], low)
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
        for index, spans in windows.items():
            item_id, item, budget = self.items[index]
            exact = text.find(item)
            if exact >= 0:
                yield item_id, 0, exact + len(item)
                continue
            best = None
            for low, high in spans:
                near = myers(item, text[low:high], budget)
                if near and (best is None or near[0] < best[0]):
                    best = (near[0], low + near[1])
            if best:
                yield item_id, *best


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item found in it: id, item_id, distance, match_end.

    Both texts are compared as plain words; the budget is `rate` of an item's characters, and
    nothing for short items. Where the item stands more than once the best place counts, the
    first of ties; `match_end` is its end in the plain text. Null and empty texts, and items
    without letters or digits, match nothing. Rows that repeat give rows that repeat; an item
    that repeats counts once. Documents never move: the items go to every task, in as many
    passes as keep their characters within `block_chars`.
    """
    base = named(docs, id=id_col, text=text_col)
    found = None
    for part in _item_blocks(benchmark, item_id_col, item_text_col, block_chars):
        matches = base.mapInArrow(_search(part, rate), MATCH_SCHEMA)
        found = matches if found is None else found.union(matches)
    return found


def flag_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    flag: str,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every row of `docs` with `flag`: whether its own text holds an item, as in `find_leaks`.

    `flag` is a name that `docs` does not have. Ids play no part, so null or repeated ones are
    judged row by row, and nothing is shuffled.
    """
    found = docs.withColumn(flag, F.lit(False))
    at = docs.columns.index(text_col)
    for part in _item_blocks(benchmark, item_id_col, item_text_col, block_chars):
        found = found.mapInArrow(_flag(part, rate, at), found.schema)
    return found


def _item_blocks(
    benchmark: DataFrame, id_col: str, text_col: str, block_chars: int
) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in parts of about `block_chars` characters; one part at least."""
    items = named(benchmark, id=id_col, text=text_col).where("text <> ''")
    items = items.groupBy("id", "text").count().drop("count")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for number in range(blocks):
        yield [(row[0], row[1]) for row in items.where(block == number).collect()]


def _flag(items: list[tuple[int, str]], rate: float, at: int):
    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, rate)
        for batch in batches:
            held = [
                done.as_py() or any(True for _ in searcher.find(plain(text.as_py())))
                for text, done in zip(batch.column(at), batch.column(batch.num_columns - 1))
            ]
            columns = [*batch.columns[:-1], pa.array(held, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return flag


def _search(items: list[tuple[int, str]], rate: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, rate)
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = plain(batch["text"][i].as_py())
                own = batch["id"][i].as_py()
                rows.extend((own, *found) for found in searcher.find(text))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["id", "item_id", "distance", "match_end"],
            )

    return search
