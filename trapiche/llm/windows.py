"""Word windows of texts as numpy arrays: hashes, minimisers, exact names."""

from __future__ import annotations

import numpy as np

# Bytes hashed at a time, which bounds the memory of a very long text.
BLOCK_BYTES = 1 << 22

# The six white space bytes.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word. Equal words have equal hashes; the hash only deals out."""
    found, start = [], 0
    while start < len(text):
        end = start + BLOCK_BYTES
        if end < len(text):
            # A block ends before a white space byte; a word longer than a block extends it.
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
        found.append(_block_hashes(np.frombuffer(text[start:end], np.uint8)))
        start = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _block_hashes(data: np.ndarray) -> np.ndarray:
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    # Differences of prefix sums of byte * base^position, taken back to position zero.
    terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    plain = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts]
    return mixed(plain + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a public 64-bit mixing hash."""
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(multiplier)
    return x ^ (x >> np.uint64(33))


def minimisers(hashes: np.ndarray, window: int, size: int) -> np.ndarray:
    """For each window of words, the least hash among its runs of `size` words."""
    count = len(hashes) - window + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    runs = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        runs = runs * np.uint64(_BASE) + hashes[i : len(hashes) - size + 1 + i]
    least, reach, wanted = mixed(runs), 1, window - size + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    return least


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal neighbours."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))[: len(values)]
    return starts, np.diff(np.append(starts, len(values)))


def window_names(words: np.ndarray, window: int) -> np.ndarray:
    """A number for the `window` words from each position; equal sequences, equal numbers.

    Exact naming by sorting: names of 2, 4, 8... words are ranks of pairs of shorter names.
    """
    names, reach = words.astype(np.int64), 1
    while reach < window:
        step = min(reach, window - reach)
        pairs = (names[: len(names) - step] << 32) | names[step:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        reach += step
    return names
