"""Best-fit packing of tokenised documents into sequences of a fixed length: minimum bin slack.

Documents are cut into pieces of at most one sequence. What matters for packing is only how many
pieces there are of each length, so the search runs on that histogram, which has at most one entry
for each length whatever the corpus holds. It gives a plan of bin patterns with repeat counts; pieces
are then dealt to the places of their length by rank, which needs no task to hold a whole length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racecast.llm.common import Scratch, text_column

END = 0
WIDTH = 2048

PIECES = "piece int, start long, length int, ids_crc32 long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and an encoder with the same vocabulary that is faster on Latin text."""
    import json

    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    spec = json.loads(slow.to_str())
    plain = spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
    if not (plain and spec["normalizer"] is None and spec["model"]["type"] == "BPE"):
        return slow, None
    # The alphabet writes each byte as a printable character: those that print stand for themselves,
    # the others follow from 256 on in byte order.
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    byte_of = {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(others)}
    if set(byte_of) != set(ByteLevel.alphabet()):
        return slow, None
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
    import public_tokenizers

    return slow, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(texts: list[str], path: str) -> list[list[int]]:
    """Ids of each text without special tokens.

    Texts of Latin-1 characters take the faster encoder, which gives the same ids there (the tests
    hold them against each other); all others the tokenizer itself.
    """
    slow, fast = _tokenizer(path)
    out: list[list[int] | None] = [None] * len(texts)
    rest = []
    for k, text in enumerate(texts):
        try:
            if fast is None:
                raise ValueError
            text.encode("latin-1")
            out[k] = fast.encode_ordinary(text)
        except ValueError:
            rest.append(k)
    for k, found in zip(rest, slow.encode_batch([texts[k] for k in rest], add_special_tokens=False)):
        out[k] = found.ids
    return out


def cut(n: int, width: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole if they fit, else the first may be shorter."""
    first = n if n <= width else n % width
    whole = [(s, width) for s in range(first, n, width)]
    return ([(0, first)] if first else []) + whole


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", width: int = WIDTH,
           with_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids and an end id, cut into at most ``width``; NULL is empty.

    Rows that repeat a key are documents of their own. ``with_ids`` adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            keys, texts = batch.column("_key").to_pylist(), text_column(batch, "_text")
            for first in range(0, len(keys), 256):
                rows: dict[str, list] = {c: [] for c in ("key", "piece", "start", "length", "crc", "ids")}
                for k, ids in zip(keys[first : first + 256], encode(texts[first : first + 256], path)):
                    numbers = np.array([*ids, END], "<u4")
                    for piece, (start, length) in enumerate(cut(len(numbers), width)):
                        own = numbers[start : start + length].tobytes()
                        for name, value in zip(rows, (k, piece, start, length, zlib.crc32(own), own)):
                            rows[name].append(value)
                columns = [
                    pa.array(rows["key"], batch.column("_key").type),
                    pa.array(rows["piece"], pa.int32()),
                    pa.array(rows["start"], pa.int64()),
                    pa.array(rows["length"], pa.int32()),
                    pa.array(rows["crc"], pa.int64()),
                ]
                columns += [pa.array(rows["ids"], pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = [key, "piece", "start", "length", "ids_crc32", "ids"]
    kind = docs.schema[key].dataType.simpleString()
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return chosen.mapInArrow(run, f"`{key}` {kind}, {PIECES}" + (", ids binary" if with_ids else ""))


def fullest(available: dict[int, int], room: int) -> list[int]:
    """Lengths, at most as many of each as ``available`` has, whose sum is the largest up to ``room``.

    Bit s of a set says that some choice has the sum s. Lengths come in descending order and copies
    in powers of two, and the set before each is kept, so that the choice can be read back.
    """
    limit = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in available if x <= room), reverse=True):
        copies, batch = min(available[length], room // length), 1
        while copies:
            batch = min(batch, copies)
            steps.append((length, batch, reach))
            reach |= (reach << (length * batch)) & limit
            copies -= batch
            batch *= 2
            if reach >> room:
                break
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, batch, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * batch
            total -= length * batch
    return chosen


def plan(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[list[int], int]]:
    """Bin patterns (lengths, how many bins), each the fullest that holds the longest piece left.

    A pattern is used as often as its pieces last, so the number of patterns depends on the number
    of different lengths, not on the number of pieces.
    """
    left = {x: n for x, n in histogram.items() if n}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = [longest, *fullest({x: n for x, n in left.items() if n}, width - longest)]
        left[longest] += 1
        need = Counter(chosen)
        times = min(left[x] // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((chosen, times))
    return out


def places(patterns: list[tuple[list[int], int]]) -> pd.DataFrame:
    """Ranks from ``first`` of the pieces of each length: bins from ``bin``, ``each`` of them in a bin.

    ``offset`` is where the first of a bin's pieces of that length stands; the others follow.
    """
    seen: Counter[int] = Counter()
    rows, at = [], 0
    for chosen, times in patterns:
        offset = 0
        for length, each in sorted(Counter(chosen).items(), reverse=True):
            rows.append((length, seen[length], seen[length] + each * times, at, each, offset))
            seen[length] += each * times
            offset += each * length
        at += times
    return pd.DataFrame(rows, columns=["length", "first", "last", "bin", "each", "offset"])


def assign(cut_pieces: DataFrame, key: str = "doc_id", width: int = WIDTH, parts: int = 64) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset``.

    ``cut_pieces`` is read three times and must be a table that reads alike each time. Pieces of one
    length are ranked in ``parts`` or more shares by hash, a count of each share giving where its
    ranks begin, so a length that a third of all pieces have is never in one task. Repeated rows get
    places of their own; an empty table gives an empty one.
    """
    spark = cut_pieces.sparkSession
    total = cut_pieces.count()
    shares = max(parts, total // 200_000)
    tagged = cut_pieces.withColumn("_share", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(shares)).cast("int"))
    counts = tagged.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    # At most one row for each length and share, so each window holds `shares` rows.
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    sizes = cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    where = places(plan({r["length"]: r["n"] for r in sizes}, width))
    own = Window.partitionBy("length", "_share").orderBy(key, "piece")
    ranked = tagged.withColumn("_rank", F.row_number().over(own) - 1).join(begins, ["length", "_share"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_begin")).drop("_begin", "_share")

    # The plan has at most a few patterns for each length, so it goes to every task.
    tables = {int(x): t.to_dict("list") for x, t in where.groupby("length")}
    tables = {x: {c: np.array(v, np.int64) for c, v in t.items()} for x, t in tables.items()}
    names = [c for c in ranked.columns if c != "_rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            bins, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own, t = np.flatnonzero(length == x), tables[int(x)]
                row = np.searchsorted(t["first"], rank[own], "right") - 1
                inner = rank[own] - t["first"][row]
                bins[own] = t["bin"][row] + inner // t["each"][row]
                offset[own] = t["offset"][row] + inner % t["each"][row] * x
            columns = [batch.column(c) for c in names] + [pa.array(bins), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    if not total:
        return spark.createDataFrame([], f"{schema}, sequence_id long, offset long")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, scratch: Scratch, text: str = "text", key: str = "doc_id", width: int = WIDTH,
         with_ids: bool = False) -> DataFrame:
    """All documents in as few sequences as minimum bin slack finds: one row for each piece."""
    return assign(scratch.keep(pieces(docs, path, text, key, width, with_ids)), key, width)
