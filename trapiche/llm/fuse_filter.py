"""Static binary fuse filters: nine bits a key, no false negatives.

Three hashed places per key in neighbouring segments; the xor of the three cells is the key's
fingerprint. Built once for an immutable set by peeling cells that one key alone uses.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

ARITY = 3
ATTEMPTS = 100


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Finaliser of a public 64-bit mixing hash."""
    x = keys + np.uint64(seed)
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(multiplier)
    return x ^ (x >> np.uint64(33))


@dataclass(frozen=True)
class FuseFilter:
    seed: int
    segment: int
    cells: np.ndarray

    def _places(self, mixed: np.ndarray) -> np.ndarray:
        """Cells of each key, one row per hash function."""
        span = np.uint64(len(self.cells) - (ARITY - 1) * self.segment)
        first = ((mixed >> np.uint64(32)) * span) >> np.uint64(32)
        mask = np.uint64(self.segment - 1)
        second = (first + np.uint64(self.segment)) ^ ((mixed >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * self.segment)) ^ (mixed & mask)
        return np.stack([first, second, third]).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mixed = _mixed(keys, self.seed)
        a, b, c = self.cells[self._places(mixed)]
        return (a ^ b ^ c) == _prints(mixed)


def _prints(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> FuseFilter:
    """A filter over the distinct 64-bit keys."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    segment = 2 ** int(math.log(n) / math.log(3.33) + 2.25)
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(room / segment) - ARITY + 1) + ARITY - 1
    for seed in range(1, ATTEMPTS):
        empty = FuseFilter(seed, segment, np.zeros(segments * segment, np.uint8))
        mixed = _mixed(keys, seed)
        places = empty._places(mixed)
        rounds = _peel(places, len(empty.cells))
        if rounds is None:
            continue
        prints = _prints(mixed)
        for index, place in reversed(rounds):
            # The cell of its own is still zero, so all three may be taken together.
            a, b, c = empty.cells[places[:, index]]
            empty.cells[place] = prints[index] ^ a ^ b ^ c
        return empty
    raise ValueError("no seed gives a filter; are the keys 64-bit hashes?")


def _peel(places: np.ndarray, cells: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, cell of each that no key left uses); None where a core stays."""
    n = places.shape[1]
    users = np.bincount(places.ravel(), minlength=cells)
    # Where one key is left in a cell, the sum of its users is that key.
    total = np.zeros(cells, np.int64)
    np.add.at(total, places.ravel(), np.tile(np.arange(n), ARITY))
    rounds, left = [], n
    candidates = np.flatnonzero(users == 1)
    while len(candidates):
        index, at = np.unique(total[candidates], return_index=True)
        rounds.append((index, candidates[at]))
        left -= len(index)
        touched = places[:, index].ravel()
        np.subtract.at(users, touched, 1)
        np.subtract.at(total, touched, np.tile(index, ARITY))
        touched = np.unique(touched)
        candidates = touched[users[touched] == 1]
    return rounds if left == 0 else None
