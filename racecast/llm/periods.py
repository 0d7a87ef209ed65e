"""Periodic runs of words, found online by dyadic square catching.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of a length of at
least ``LEAST`` and at least 2q, that no neighbouring word extends keeping period q.

``Catchers`` takes words as they come. For every level, a power of two L, each completed block of L words at a
multiple of L has a catcher for the periods 2L - 1 to 4L - 2: it watches whether the last L words repeat its
block at such a distance. An appended word so meets two blocks of each level, by comparing the hash of the suffix
that it ends with the hash of the block. The first half of any square of period q holds, at the level of q, a
whole block, which the second half repeats: so no square is missed. Hits of one period on neighbouring blocks are
one stretch; it is grown at both ends, by less than a block, and stretches of two periods and more are runs.
A stretch with a period that is not its smallest has the same ends as the one with the smallest.

Every word is handled once for each level, so n words cost O(n log n) whatever they repeat. Texts are joined by
words that no text holds, so many short texts cost no more than one long one. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from racecast.llm.common import slices, string_bytes
from racecast.llm.words import ODD, mix, word_hashes

LEAST = 12
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _joined(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one period of which one ends where the next starts, as one."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] != end[:-1])
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start))[: len(at)] - 1], period[at]


class Catchers:
    """Runs of a growing sequence of words, given as 64-bit hashes.

    ``append`` takes the next words, one or many: the state after it does not depend on how the words were cut.
    ``bound`` is the most words that a run can hold (a text's length): levels beyond it are not kept.
    """

    def __init__(self, least: int = LEAST, bound: int | None = None):
        self.least, self.bound = least, bound
        self.sums = [np.zeros(0, np.uint64)]  # per level, the hash of the L words from each place
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @property
    def words(self) -> np.ndarray:
        return self.sums[0]

    def append(self, words: np.ndarray) -> None:
        self.sums[0] = np.concatenate([self.sums[0], words])
        n = len(self.words)
        most = n if self.bound is None else min(n, self.bound)
        level = 0
        while 2 * (2 ** (level + 1) - 1) <= most:  # the shortest square of the level
            size = 2**level
            if len(self.sums) == level:
                self.sums.append(np.zeros(0, np.uint64))
            known = len(self.sums[level]) if level else n - len(words)
            if level:
                lower, half = self.sums[level - 1], size // 2
                fresh = lower[known : n - size + 1] * ODD + lower[known + half : n - size + 1 + half]
                self.sums[level] = np.concatenate([self.sums[level], mix(fresh)])
            self._catch(level, known)
            level += 1

    def _catch(self, level: int, first: int) -> None:
        """Compare the suffixes that start at ``first`` and later with the two blocks that watch each of them."""
        sums, size = self.sums[level], 2**level
        ends = np.arange(first, len(sums))
        nearest = (ends - (2 * size - 1)) // size * size
        for block in (nearest, nearest - size):
            inside = block >= 0
            inside &= sums[np.maximum(block, 0)] == sums[ends]
            hits = np.flatnonzero(inside)
            start, period = block[hits], ends[hits] - block[hits]
            self.found.append(_joined(start, start + size, period))

    def runs(self) -> np.ndarray:
        """Rows (start, length, period) of the runs of the words so far, by start, then period."""
        none = np.zeros((0, 3), np.int64)
        if not self.found:
            return none
        start, end, period = _joined(*(np.concatenate(x) for x in zip(*self.found)))
        self.found = [(start, end, period)]
        # A stretch grows by less than a block at either end.
        size = 2 ** (np.frexp((period + 1) // 2)[1].astype(np.int64) - 1)
        near = end - start + 2 * (size - 1) + period >= np.maximum(self.least, 2 * period)
        start, end, period = start[near], end[near], period[near]
        words, n = self.words, len(self.words)
        for step in (-1, 1):  # words [start, end) equal those a period later; grow while that holds
            edge = start if step < 0 else end
            open_ = np.arange(len(edge))
            while len(open_):
                near = edge[open_] - 1 if step < 0 else edge[open_]
                held = (near >= 0) & (near + period[open_] < n)
                held[held] = words[near[held]] == words[near[held] + period[open_][held]]
                open_ = open_[held]
                edge[open_] += step
        length = end - start + period
        whole = length >= np.maximum(self.least, 2 * period)
        rows = np.stack([start, length, period], 1)[whole]
        if not len(rows):
            return none
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), bool)  # of equal stretches that with the smallest period
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        rows = rows[first]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def text_runs(hashes: np.ndarray, counts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of many texts, whose words follow each other: rows (start in its text, length, period), and the text of each."""
    starts = np.cumsum(counts + 1) - counts - 1  # a word between two texts that neither holds
    joined = mix(np.arange(len(hashes) + len(counts), dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    owner = np.repeat(np.arange(len(counts)), counts)
    joined[np.arange(len(hashes)) + owner] = hashes
    catchers = Catchers(least, int(counts.max(initial=0)))
    catchers.append(joined)
    rows = catchers.runs()
    text = np.searchsorted(starts, rows[:, 0], "right") - 1
    rows[:, 0] -= starts[text]
    return rows, text


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when each run is cut to its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) == 0


def _found(text: pa.Array, least: int) -> list[pa.Array]:
    """The number of words of each text, its runs, and the text without repeats."""
    data, offsets = string_bytes(text)
    lists: list[list[dict[str, int]]] = []
    short: list[str] = []
    sizes: list[int] = []
    for first, last in slices(offsets):
        part = data[offsets[first] : offsets[last]]
        hashes, counts = word_hashes(part, offsets[first : last + 1] - offsets[first])
        rows, owner = text_runs(hashes, counts, least)
        cuts = np.searchsorted(owner, np.arange(last - first + 1))
        for i in range(last - first):
            words = bytes(data[offsets[first + i] : offsets[first + i + 1]]).split()
            sizes.append(len(words))
            mine = rows[cuts[i] : cuts[i + 1]]
            if len(mine):
                words = [words[k] for k in np.flatnonzero(kept_words(len(words), mine))]
            lists.append([{"start": a, "length": b, "period": c} for a, b, c in mine.tolist()])
            short.append(b" ".join(words).decode())
    return [pa.array(sizes, pa.int64()), pa.array(lists, RUNS_ARROW), pa.array(short, pa.string())]


def find(docs: DataFrame, text: str = "text", keep: Sequence[str] = (), least: int = LEAST) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``runs`` and ``collapsed`` of every whole text.

    ``runs`` is an array of (start, length, period), in words from 0, by start, then period; ``collapsed`` is
    the words joined by one space, without those that repeat an earlier period: a word that any run holds after
    its first period goes. A word is a stretch of characters other than ASCII white space.

    A NULL or empty text has no words and no runs, and an empty ``collapsed``. Repeated rows are treated row by row;
    an empty table gives an empty table. Columns other than ``keep`` do not pass through, so no name can clash;
    columns of ``keep`` named ``n_words``, ``runs`` or ``collapsed`` are replaced. Each text is held by one task,
    with some 100 bytes for each of its words.
    """
    made = ("n_words", "runs", "collapsed")
    keep = [c for c in keep if c.lower() not in made]
    quoted = ["`" + c.replace("`", "``") + "`" for c in keep]
    rows = docs.select(*quoted, docs[text].alias("collapsed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*(batch.column(i) for i in range(len(keep))), *_found(batch.column("collapsed"), least)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *made])

    fields = [f"{name} {rows.schema[i].dataType.simpleString()}" for i, name in enumerate(quoted)]
    return rows.mapInArrow(run, ", ".join([*fields, "n_words bigint", f"runs {RUNS}", "collapsed string"]))
