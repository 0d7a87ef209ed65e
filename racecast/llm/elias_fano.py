"""Elias-Fano sequences and a trie of n-grams in memory-mapped levels, for many queries at once."""

from __future__ import annotations

from pathlib import Path

import numpy as np

# Log probabilities are kept as steps of 1 / STEPS below 0, in 16 bits.
STEPS = 2048
_COUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# Place of the k-th one of a byte.
_PLACE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _ones = [k for k in range(8) if _b >> k & 1]
    _PLACE[_b, : len(_ones)] = _ones


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value, one after another, and room to read 8 bytes from any place."""
    if not bits or not len(values):
        return np.zeros(8, np.uint8)
    shifts, out = np.arange(bits, dtype=np.uint64), []
    for first in range(0, len(values), 65_536):  # a multiple of 8 values, so of whole bytes
        spread = (values[first : first + 65_536, None] >> shifts).astype(np.uint8) & 1
        out.append(np.packbits(spread.ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


class EliasFano:
    """A rising sequence of whole numbers: low bits packed, high bits as a unary bit vector."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        upper = (values >> bits).astype(np.int64)
        size = n + (top >> bits) + 2
        vector = np.zeros(-(-size // 64) * 64, bool)
        vector[upper + np.arange(n)] = True
        high = np.packbits(vector, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(_COUNT[high].reshape(-1, 8).sum(axis=1, dtype=np.int64))])
        return cls(n, bits, _packed(values.astype(np.uint64), bits), high, ones)

    def parts(self) -> dict[str, np.ndarray]:
        return {"meta": np.array([self.n, self.bits]), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def of(cls, parts: dict[str, np.ndarray]) -> EliasFano:
        return cls(int(parts["meta"][0]), int(parts["meta"][1]), parts["low"], parts["high"], parts["ones"])

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one or zero of the high bits, counted from 0."""
        before = self.ones if ones else np.arange(len(self.ones)) * 64 - self.ones
        word = np.searchsorted(before, k, "right") - 1
        left = k - before[word]
        at, open_ = word * 8, np.arange(len(k))
        done = at.copy()
        for _ in range(8):
            byte = self.high[at[open_]]
            have = _COUNT[byte] if ones else 8 - _COUNT[byte]
            more = left[open_] >= have
            done[open_] = at[open_]
            left[open_[more]] -= have[more]
            at[open_[more]] += 1
            open_ = open_[more]
            if not len(open_):
                break
        byte = self.high[done]
        return done * 8 + _PLACE[byte if ones else 255 - byte, left]

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.bits
        words = np.ndarray(len(self.low) - 7, "<u8", self.low, strides=(1,))
        return words[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self._select(at, True) - at) << self.bits) | self._low(at).astype(np.int64)

    def _begin(self, upper: np.ndarray) -> np.ndarray:
        """How many numbers have high bits below ``upper``."""
        zeros = len(self.high) * 8 - self.n
        some = np.clip(upper - 1, 0, zeros - 1)
        return np.where(upper <= 0, 0, np.minimum(self._select(some, False) - some, self.n))

    def find(self, begin: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Place of ``wanted`` among the numbers from ``begin`` to ``end``, or -1: its successor, if equal."""
        out = np.full(len(wanted), -1, np.int64)
        if not self.n:
            return out
        open_ = np.flatnonzero((begin < end) & (wanted >= 0))
        upper = wanted[open_] >> self.bits
        lower = (wanted[open_] & ((1 << self.bits) - 1)).astype(np.uint64)
        at = np.maximum(self._begin(upper), begin[open_])
        stop = np.minimum(self._begin(upper + 1), end[open_])
        place, last = at, stop
        while len(open_):  # halve what is left between numbers with the same high bits
            half = (at + stop) >> 1
            inside = at < stop
            below = inside & (self._low(np.where(inside, half, 0)) < lower)
            at, stop = np.where(below, half + 1, at), np.where(inside & ~below, half, stop)
            if not (at < stop).any():
                break
        hit = (at < last) & (place <= at)
        hit[hit] = self._low(at[hit]) == lower[hit]
        out[open_[hit]] = at[hit]
        return out


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-logs * STEPS), 0, 65535).astype(np.uint16)


class Trie:
    """n-grams by level. An entry's successors are a range of the next level, given by rising pointers.

    Word numbers within a range are kept relative to where the range before ended, so a whole level
    is one rising sequence. Levels are files that are mapped, not read.
    """

    def __init__(self, folder: Path):
        self.levels = []
        for level in sorted(folder.iterdir()):
            parts = {f.stem: np.load(f, mmap_mode="r") for f in level.iterdir()}
            sequences = {
                name: EliasFano.of({k.split("-")[1]: v for k, v in parts.items() if k.startswith(f"{name}-")})
                for name in ("ids", "pointers")
                if f"{name}-meta" in parts
            }
            self.levels.append((sequences, parts["logs"], parts["weights"]))

    @staticmethod
    def build(folder: Path, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], words: int) -> Trie:
        """Write levels of (parent entry, word, log10 probability, log10 weight left to shorter n-grams).

        Entries are sorted by parent, then word. On the first level word w is entry w.
        """
        for k, (parent, word, logs, weights) in enumerate(levels):
            place = folder / f"{k}"
            place.mkdir()
            parts = {"logs": quantised(logs), "weights": quantised(weights)}
            if k:
                above = len(levels[k - 1][0])
                pointers = np.searchsorted(parent, np.arange(above + 1))
                last = np.zeros(above + 1, np.int64)  # where the sequence stands before each range
                full = np.flatnonzero(np.diff(pointers))
                last[1:][full] = word[pointers[1:][full] - 1] + 1
                ids = word + np.cumsum(last)[parent]
                for name, values in (("ids", ids), ("pointers", pointers)):
                    parts |= {f"{name}-{x}": v for x, v in EliasFano.build(values).parts().items()}
            for name, values in parts.items():
                np.save(place / f"{name}.npy", values)
        return Trie(folder)

    def next(self, level: int, entry: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Entries of ``level`` that follow ``entry`` (of the level above, -1 for none) with ``word``, or -1."""
        sequences = self.levels[level][0]
        ids, pointers = sequences["ids"], sequences["pointers"]
        known = np.maximum(entry, 0)
        begin, end = pointers.get(known), pointers.get(known + 1)
        end = np.where((entry < 0) | (word < 0), begin, end)
        if not ids.n:
            return np.full(len(entry), -1, np.int64)
        # Where the range begins: its numbers are relative to the last number before it.
        base = np.where(begin > 0, ids.get(np.maximum(begin - 1, 0)) + 1, 0)
        return ids.find(begin, end, base + np.maximum(word, 0))

    def logs(self, level: int, entry: np.ndarray) -> np.ndarray:
        return self.levels[level][1][entry] / -STEPS

    def weights(self, level: int, entry: np.ndarray) -> np.ndarray:
        """Weight of the shorter n-gram after ``entry``; 1 where there is none."""
        return np.where(entry < 0, 0.0, self.levels[level][2][np.maximum(entry, 0)] / -STEPS)
