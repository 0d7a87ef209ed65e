"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one valid encoding, so it is enough to store, for each prefix, the
last token of that encoding: token t can end a prefix if the shorter prefix before it ends in a token
that t can follow, and exactly one token passes. Appending bytes only adds entries; after an edit the
entries are computed anew until they agree with the old ones for a longest token's length.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import text_column
from racecast.llm.words import ODD, HashArray, mix, powers

NEVER = 1 << 60
PAIRS_KEPT = 1_000_000
PIECES_KEPT = 300_000
# Longer pieces are encoded one by one.
SHORT = 32
# Lengths of a last token in the order in which they are tried; only one can pass.
TRIED = (2, 3, 1, *range(4, SHORT + 1))


BACK = np.array([pow(pow(int(ODD), -1, 2**64), k, 2**64) for k in range(SHORT)], np.uint64)


def _key(data: bytes) -> int:
    """Hash of a string, as ``Vocabulary.encode_all`` has it of a substring."""
    sums = sum((b + 1) * pow(int(ODD), k, 2**64) for k, b in enumerate(data)) + len(data)
    return int(mix(np.array([sums % 2**64], np.uint64))[0])


class Vocabulary:
    """Ranks of byte strings: a token's rank is its id and the priority of the merge that makes it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self._table: HashArray | None = None
        self._codes: dict[int, bool] = {}
        self.sizes = {i: len(b) for b, i in ranks.items()}
        self._sizes_of = np.zeros(max(self.bytes, default=0) + 2, np.int64)  # the last entry is for -1
        self._sizes_of[list(self.sizes)] = list(self.sizes.values())
        self.longest = max(self.sizes.values(), default=0)
        self.pairs: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._spines: dict[tuple[int, int], list[int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Encoding of a short byte string by its definition: the lowest merge first, then the leftmost.

        The tokens that this makes give each token's halves.
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        ids = [self.ranks[p] for p in parts]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            self._halves.setdefault(rank, (ids[at], ids[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ids[at : at + 2] = [rank]
        return ids

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, or None for a byte or a token no merge makes."""
        if token not in self._halves:
            data = self.bytes[token]
            made = self.merged(data) == [token]
            if not made or len(data) == 1:
                self._halves[token] = None
        return self._halves[token]

    def made(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.halves(token) is not None

    def spine(self, token: int, side: int) -> list[int]:
        """Tokens at the left (0) or right (1) edge of ``token`` while it is merged, from a byte on."""
        key = token, side
        if key not in self._spines:
            out = [token]
            while (parts := self.halves(out[-1])) is not None:
                out.append(parts[side])
            self._spines[key] = out[::-1]
        return self._spines[key]

    def follows(self, first: int, second: int) -> bool:
        """Whether ``second`` can stand after ``first``, or begin a string where ``first`` is -1."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        good = self.pairs[first, second] = self.made(second) and (first < 0 or self._stay_apart(first, second))
        return good

    def extend(self, data: bytes, last: list[int]) -> None:
        """Add to ``last`` the last tokens of the prefixes of ``data`` that it lacks."""
        find, known, follows, longest = self.ranks.get, self.pairs.get, self.follows, self.longest
        for end in range(len(last), len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = find(data[start:end])
                if token is not None:
                    before = last[start]
                    good = known((before, token))
                    if good or good is None and follows(before, token):
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def read(self, last: list[int]) -> list[int]:
        """The encoding that the last tokens of all prefixes spell, from the end backwards."""
        out, at, sizes = [], len(last) - 1, self.sizes
        while at:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        return out[::-1]

    def encode_all(self, strings: list[bytes]) -> list[tuple[int, ...]]:
        """Encodings of many short strings, longest first: all their prefixes of a length at a time.

        Substrings are looked up by hash, and what comes out is held against the string.
        """
        if not strings:
            return []
        if self._table is None:
            tokens = np.array(list(self.ranks.values()), np.int32)
            keys = np.array([_key(b) for b in self.ranks], np.uint64)
            order = np.argsort(keys)
            self._table = HashArray(keys[order], tokens[order])
        table, width = self._table, len(strings[0])
        sizes = np.array([-len(s) for s in strings])
        data = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width).T
        sums = np.zeros((width + 1, len(strings)), np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(width)[:width, None], axis=0, out=sums[1:])
        last = np.full((width + 1, len(strings)), -1, np.int64)
        for end in range(1, width + 1):
            left = np.arange(np.searchsorted(sizes, -end, "right"))
            for size in TRIED:
                if (start := end - size) < 0:
                    continue
                part = (sums[end, left] - sums[start, left]) * BACK[start]
                found = table.find(mix(part + np.uint64(size)))
                hit = np.flatnonzero(found >= 0)
                if len(hit):
                    token, before = table.values[found[hit]], last[start, left[hit]]
                    pairs, each = np.unique((before + 1) << 32 | token, return_inverse=True)
                    good = self._good(pairs.tolist())[each]
                    last[end, left[hit[good]]] = token[good]
                    left = np.delete(left, hit[good])
                    if not len(left):
                        break
        at, column = -sizes, np.arange(len(strings))
        steps, sizes_of = [], self._sizes_of
        while at.any():
            token = last[at, column]
            steps.append(token)
            # Places before the beginning, and strings that hold no encoding, read -1: size 0.
            at = np.where(token < 0, 0, at - sizes_of[token])
        many = (np.array(steps) >= 0).sum(axis=0).tolist()
        rows = np.array(steps).T.tolist()
        out = [tuple(row[n - 1 :: -1]) if n else () for row, n in zip(rows, many)]
        text = self.bytes.__getitem__
        if b"".join([text(i) for ids in out for i in ids]) != b"".join(strings):
            # Somewhere two substrings share a hash.
            out = [ids if b"".join(map(text, ids)) == x else tuple(Prefixes(self, x).ids()) for ids, x in zip(out, strings)]
        return out

    def _good(self, pairs: list[int]) -> np.ndarray:
        """Whether tokens can follow, for pairs of numbers: first token and one, then the second."""
        known, codes = list(map(self._codes.get, pairs)), self._codes
        if None in known:
            if len(codes) >= PAIRS_KEPT:
                codes.clear()
            for k, (pair, good) in enumerate(zip(pairs, known)):
                if good is None:
                    known[k] = codes[pair] = self.follows((pair >> 32) - 1, pair & 0xFFFFFFFF)
        return np.array(known)

    def _stay_apart(self, first: int, second: int) -> bool:
        """Whether the two tokens, made side by side, are never merged across their border.

        Walks through the moments at which the tokens at the border change: they merge if their merge
        has its turn before both grow. Of equal merges the leftmost has its turn first.
        """
        left, right = self.spine(first, 1), self.spine(second, 0)
        a = b = 0
        while True:
            grows = left[a + 1] if a + 1 < len(left) else NEVER
            other = right[b + 1] if b + 1 < len(right) else NEVER
            merge = self.ranks.get(self.bytes[left[a]] + self.bytes[right[b]], NEVER)
            if merge < grows and merge <= other:
                return False
            if grows == other == NEVER:
                return True
            if grows <= other:
                a += 1
            else:
                b += 1


class Prefixes:
    """The last token of each prefix of a byte string, kept under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end. Entries of the old prefixes stay as they are."""
        self.data += data
        self.vocabulary.extend(self.data, self.last)

    def edit(self, start: int, end: int, data: bytes) -> int:
        """Replace bytes ``start`` to ``end``; returns how many entries were computed anew."""
        old, shift = self.last, len(data) - (end - start)
        whole = self.data[:start] + data + self.data[end:]
        self.last = old[: start + 1]
        done, same = start, 0
        while done < len(whole) and same < self.vocabulary.longest:
            done += 1
            self.vocabulary.extend(whole[:done], self.last)
            before = done - shift
            same = same + 1 if done >= start + len(data) and self.last[done] == old[before] else 0
        self.last += old[done - shift + 1 :]
        self.data = whole
        return done - start

    def ids(self) -> list[int]:
        """The encoding of the whole string."""
        return self.vocabulary.read(self.last)


class Coder:
    """Encodes and decodes texts; pieces that the pattern splits off are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces not known yet."""
        vocabulary = self.vocabulary
        short: list[tuple[bytes, str]] = []
        for piece in pieces:
            if piece in self.known:
                continue
            data = piece.encode()
            token = vocabulary.ranks.get(data)
            if token is not None:  # a whole token is itself, even one that no merge makes
                self.known[piece] = (token,)
            elif len(data) > SHORT:
                self.known[piece] = tuple(Prefixes(vocabulary, data).ids())
            else:
                short.append((data, piece))
        short.sort(key=lambda x: -len(x[0]))
        self.known.update(zip([p for _, p in short], vocabulary.encode_all([d for d, _ in short])))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text. Pieces stay known for later texts up to a bound."""
        if len(self.known) > PIECES_KEPT:
            self.known.clear()
        pieces = [self.split(t) for t in texts]
        self.learn({p for own in pieces for p in own})
        known = self.known
        for own in pieces:
            yield [i for p in own for i in known[p]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(load_ranks(path), pattern)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            with_ids: bool = False) -> DataFrame:
    """``keep`` columns of every row with digests of its ids and of the bytes they decode to.

    Whole texts are encoded; a NULL text is empty and has no ids. Repeated rows give the same
    digests, an empty table an empty one. Other columns are not read. ``with_ids`` adds the ids.
    """
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here has cycles, and the known pieces make collections long
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            texts = text_column(batch, "_text")
            for first, last in _groups(texts):
                count, of_ids, of_bytes, all_ids = [], [], [], []
                for ids in own.encode(texts[first:last]):
                    count.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                part = batch.slice(first, last - first)
                columns = [part.column(c) for c in names] + [pa.array(count, pa.int64())]
                columns += [pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
                columns += [pa.array(all_ids, pa.list_(pa.int32()))] if with_ids else []
                out = [*names, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
                yield pa.RecordBatch.from_arrays(columns, out[: len(columns)])

    chosen = docs.select(*(F.col(c) for c in names), F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text")
    more = ", ids array<int>" if with_ids else ""
    return chosen.mapInArrow(run, f"{schema}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")


def _groups(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``chars`` characters each, or one longer text."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield first, k
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)
