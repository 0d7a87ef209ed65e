"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than ASCII white space. The hash of a word is a polynomial of its
bytes modulo 2^64, mixed; different words share a hash with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """ODD^0 .. ODD^(n-1) modulo 2^64."""
    global _powers
    while len(_powers) < n:
        step = np.uint64(int(_powers[-1]) * int(ODD) % 2**64)
        _powers = np.concatenate([_powers, _powers * step])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in text order, and how many words each text has."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    solid = ~SPACES[data]
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    value = (data[starts[0] :].astype(np.uint64) + np.uint64(1)) * solid[starts[0] :]
    value *= powers(int(spans.max()))[place]
    sums = np.add.reduceat(value, starts - starts[0])
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(sums), counts


def runs(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``width`` items start in the joined items, and how many each text has.

    A text with fewer items, but some, has one window of what it has.
    """
    ends = np.cumsum(counts)
    firsts = ends - counts
    n = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(firsts, n) + inner, n


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, text by text, and how many each text has.

    A text of fewer words is one shingle of all its words; an empty one has none.
    """
    at, n = runs(counts, width)
    if not len(at):
        return np.zeros(0, np.uint64), n
    last = np.repeat(np.cumsum(counts), n)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        place = at + k
        inside = place < last
        out = out * ODD + np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
    return mix(out), n


def sequence_keys(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's sequence of words."""
    n, ends = len(counts), np.cumsum(counts)
    if not len(hashes):
        return np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    place = np.arange(len(hashes)) - np.repeat(ends - counts, counts)
    power = powers(int(counts.max()))[place]
    full = np.flatnonzero(counts)
    out = []
    for salt in (np.uint64(0), np.uint64(0xD6E8FEB86659FD93)):
        sums = np.zeros(n, np.uint64)
        sums[full] = np.add.reduceat(mix(hashes + salt) * power, (ends - counts)[full])
        out.append(mix(sums + counts.astype(np.uint64)))
    return out[0], out[1]


@dataclass
class HashArray:
    """Rows of values by 64-bit hash: sorted hashes, with a directory over their leading bits."""

    keys: np.ndarray
    values: np.ndarray
    shift: np.uint64 = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        bits = max(1, int(len(self.keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        heads = np.arange(2**bits + 1, dtype=np.float64)
        edges = (self.keys >> self.shift).astype(np.int64)
        self.starts = np.searchsorted(edges, heads[:-1].astype(np.int64)).astype(np.int32)
        self.starts = np.append(self.starts, np.int32(len(self.keys)))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        head = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts[head], self.starts[head + 1]
        found = np.full(len(wanted), -1, np.int32)
        open_ = np.flatnonzero(at < end)
        at, end, left = at[open_], end[open_], wanted[open_]
        while len(open_):
            hit = self.keys[at] == left
            found[open_[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            open_, at, end, left = open_[more], at[more] + 1, end[more], left[more]
        return found
