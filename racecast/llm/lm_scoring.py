"""Scores of documents by an n-gram language model in Elias-Fano tries, learnt from the corpus.

Documents are dealt out in blocks of bounded size. Each block asks for the n-grams that its texts
hold, once each: requests are sorted hashes, cut by range into shards, and carry the block's own
training counts. A shard adds up what all blocks ask and answers each of them with the totals. A
block then has the slice of the model that its texts need, whatever the size of the whole, builds
its trie of smoothed probabilities in memory-mapped files and scores its documents.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import Scratch, string_bytes, slices
from racecast.llm.elias_fano import Trie
from racecast.llm.words import LOWER, ODD, mix, word_hashes

ORDER = 2
BLOCK_BYTES = 5_000_000
SHARD_BYTES = 6_000_000
# How many observations the shorter n-gram's probability counts for.
STRENGTH = 20.0
# Bytes of text hashed, and n-grams looked up, at a time: what a worker holds beside its block.
HASHED_BYTES = 400_000
LOOKED_UP = 65_536
END, START = np.uint64(0x454E44), np.uint64(0x5354415254)


def _pack(blocks: int):
    """Documents of a batch by block, each block's as one compressed Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            of = batch.column("block").to_numpy()
            order = np.argsort(of, kind="stable")
            numbers, starts = np.unique(of[order], return_index=True)
            data = []
            for first, last in zip(starts, [*starts[1:], len(of)]):
                part = batch.take(pa.array(order[first:last])).drop_columns(["block"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                data.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(data, pa.binary())], ["block", "data"])

    return run


class Tokens:
    """Token hashes of the documents of a block, with an end after each; which are for training."""

    def __init__(self, packed: pa.Table):
        streams = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in packed.column("data").combine_chunks()]
        docs = pa.concat_tables(streams)
        self.keys, self.train = docs.column("key").combine_chunks(), docs.column("train").to_numpy()
        data, offsets = string_bytes(docs.column("text"))
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, last in slices(offsets, HASHED_BYTES):
            own = LOWER[data[offsets[first] : offsets[last]]]
            h, c = word_hashes(own, offsets[first : last + 1] - offsets[first])
            hashes.append(h)
            counts.append(c)
        words, n = np.concatenate(hashes), np.concatenate(counts)
        self.n = n + 1
        self.ends = np.cumsum(self.n) - 1
        self.hashes = np.empty(len(words) + len(n), np.uint64)
        inner = np.ones(len(self.hashes), bool)
        inner[self.ends] = False
        self.hashes[inner] = words
        self.hashes[self.ends] = END
        self.learnt = np.repeat(self.train, self.n)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.ends - self.n + 1, self.n)

    def before(self, back: int) -> np.ndarray:
        """The token ``back`` places before each; the start where the text has none there."""
        out = np.full(len(self.hashes), START)
        if back < len(out):
            out[back:] = np.where(self.place[back:] >= back, self.hashes[:-back], START)
        return out

    def grams(self, order: int) -> np.ndarray:
        """Hash of the last ``order`` tokens at each place; ``order`` 1 gives the tokens."""
        out = self.hashes if order == 1 else np.zeros(len(self.hashes), np.uint64)
        if order > 1:
            for back in range(order - 1, -1, -1):
                out = out * ODD + (self.before(back) if back else self.hashes)
            out = mix(out + np.uint64(order))
        return out


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key among the distinct ones, and the first place of each distinct key, in key order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    del ordered
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return rank, order[new].astype(np.int32)


def counted(keys: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each is learnt."""
    ordered = np.sort(keys)
    distinct = ordered[np.r_[True, ordered[1:] != ordered[:-1]]] if len(ordered) else ordered
    known = np.sort(keys[learnt])
    new = np.flatnonzero(np.r_[True, known[1:] != known[:-1]]) if len(known) else np.zeros(0, int)
    counts = np.zeros(len(distinct), np.int64)
    counts[np.searchsorted(distinct, known[new])] = np.diff(np.append(new, len(known)))
    return distinct, counts


def squeezed(keys: np.ndarray) -> bytes:
    """Rising numbers as their differences, in the bytes that the largest one needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, -(-int(steps[1:].max(initial=0)).bit_length() // 8))
    rest = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + steps[:1].astype("<u8").tobytes() + rest.tobytes()


def widened(data: bytes) -> np.ndarray:
    data = np.frombuffer(data, np.uint8)
    rest = data[9:].reshape(-1, int(data[0]))
    steps = np.zeros((len(rest) + 1, 8), np.uint8)
    steps[0] = data[1:9]
    steps[1:, : rest.shape[1]] = rest
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


REQUEST = "order int, shard int, block long, keys binary, counts binary"


def _ask(order: int, bits: int):
    def requests(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        tokens = Tokens(table)
        rows: list[tuple] = []
        for k in range(1, order + 1):
            keys, counts = counted(tokens.grams(k), tokens.learnt)
            cuts = np.searchsorted(keys >> np.uint64(63 - bits) >> np.uint64(1), np.arange(2**bits + 1, dtype=np.uint64))
            for shard in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[shard], cuts[shard + 1])
                rows.append((k, int(shard), block, squeezed(keys[own]), counts[own].astype("<u4").tobytes()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        names = ("order", "shard", "block", "keys", "counts")
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, kinds))})

    return requests


def _answer(table: pa.Table) -> pa.Table:
    """Totals of a shard's n-grams for each block that asked, in the order in which it asked.

    A row for block -1 has the sum of all totals and how many are not 0.
    """
    order, shard = table.column("order")[0].as_py(), table.column("shard")[0].as_py()
    keys = [widened(x.as_buffer()) for x in table.column("keys").combine_chunks()]
    counts = [np.frombuffer(x.as_buffer(), "<u4") for x in table.column("counts").combine_chunks()]
    together = np.concatenate(keys)
    by = np.argsort(together, kind="stable")
    ordered = together[by]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    sums = np.add.reduceat(np.concatenate(counts)[by].astype(np.int64), np.flatnonzero(new))
    total = np.empty(len(by), np.int64)
    total[by] = sums[np.cumsum(new) - 1]
    parts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
    blocks = table.column("block").to_pylist() + [-1]
    own = np.array([sums.sum(), (sums > 0).sum()], np.int64)
    return pa.table(
        {
            "order": pa.array([order] * len(blocks), pa.int32()),
            "shard": pa.array([shard] * len(blocks), pa.int32()),
            "block": pa.array(blocks, pa.int64()),
            "totals": pa.array([p.astype("<i8").tobytes() for p in [*parts, own]], pa.binary()),
        }
    )


def model_slice(
    tokens: Tokens, totals: dict[int, np.ndarray], order: int, n: int, v: int, strength: float, folder: Path
) -> tuple[np.ndarray, np.ndarray]:
    """Count in training of each token, and log10 of its probability by the trie of the block's n-grams.

    An n-gram's probability is its count plus ``strength`` times the probability of the shorter one,
    over the count of its context plus ``strength``; single tokens have theirs with one added to
    each count, unseen ones being one more token.
    """
    # Words by number: the block's tokens in hash order; the start, as context only, is the last.
    at, first = {}, {}  # rank of the n-gram at each place, and a place where each distinct one stands
    for k in range(1, order + 1):
        at[k], first[k] = ranked(tokens.grams(k))
    word, start = at[1], len(first[1])
    count = {1: np.append(totals[1], 0)}
    ends = np.flatnonzero(tokens.hashes[first[1]] == END)
    count[1][start] = count[1][ends[0]] if len(ends) else 0
    single = np.log10((count[1] + 1) / (n + v + 1))
    single[start] = 0.0

    def left(c: np.ndarray) -> np.ndarray:
        return np.log10(strength / (c + strength))

    levels = [(np.zeros(start + 1, np.int64), np.arange(start + 1), single, left(count[1]))]
    entry_of = {1: np.arange(start + 1)}  # entry of each distinct n-gram, -1 where it was never learnt
    exact = {1: 10.0 ** single[:start]}
    for k in range(2, order + 1):
        place = first[k]
        prefix = place - 1  # the context ends one token earlier, if the text has begun
        inside = tokens.place[place] > 0
        if k == 2:
            context = np.where(inside, word[prefix], start)
            seen = count[1][context]
            parent = context
        else:
            context = np.where(inside, at[k - 1][prefix], -1)
            seen = np.where(context >= 0, totals[k - 1][context], 0)
            parent = np.where(context >= 0, entry_of[k - 1][context], -1)
        shorter = exact[k - 1][at[k - 1][place]]
        exact[k] = (totals[k] + strength * shorter) / (seen + strength)
        known = np.flatnonzero((totals[k] > 0) & (parent >= 0))
        order_ = known[np.lexsort((word[place[known]], parent[known]))]
        entry_of[k] = np.full(len(place), -1, np.int64)
        entry_of[k][order_] = np.arange(len(order_))
        levels.append((parent[order_], word[place[order_]], np.log10(exact[k][order_]), left(totals[k][order_])))
    trie = Trie.build(folder, levels, start + 1)

    del levels, exact, entry_of
    place = first[order]
    # Query each distinct longest n-gram, in the order of the trie, so that neighbours read the same places.
    numbers = {
        back: np.where(tokens.place[place] >= back, word[np.maximum(place - back, 0)], start).astype(np.int64)
        for back in range(order)
    }
    by = np.argsort(numbers[order - 1] << 32 | numbers[max(order - 2, 0)])
    result = np.zeros(len(place))
    for begin in range(0, len(by), LOOKED_UP):
        own = by[begin : begin + LOOKED_UP]
        result[own] = looked_up(trie, [numbers[back][own] for back in range(order)])
    return count[1][word], result[at[order]]


def looked_up(trie: Trie, numbers: list[np.ndarray]) -> np.ndarray:
    """log10 probability of n-grams whose word ``back`` places before the last is ``numbers[back]``.

    From the longest context down until a level has the n-gram.
    """
    order = len(numbers)
    result, open_ = np.zeros(len(numbers[0])), np.arange(len(numbers[0]))
    for k in range(order, 0, -1):
        entry = numbers[k - 1][open_]
        for level in range(1, k):
            context = entry
            entry = trie.next(level, entry, numbers[k - 1 - level][open_])
        hit = entry >= 0
        result[open_[hit]] += trie.logs(k - 1, entry[hit])
        if k > 1:
            result[open_[~hit]] += trie.weights(k - 2, context[~hit])
        open_ = open_[~hit]
        if not len(open_):
            break
    return result


def _score(order: int, n: int, v: int, strength: float):
    def scores(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(docs)
        answers = answers.sort_by([("order", "ascending"), ("shard", "ascending")])
        of, parts = answers.column("order").to_numpy(), answers.column("totals").combine_chunks()
        empty = [np.zeros(0, np.int64)]
        totals = {
            k: np.concatenate(empty + [np.frombuffer(parts[int(i)].as_buffer(), "<i8") for i in np.flatnonzero(of == k)])
            for k in range(1, order + 1)
        }
        with tempfile.TemporaryDirectory() as folder:
            count, logs = model_slice(tokens, totals, order, n, v, strength, Path(folder))
        begin = tokens.ends - tokens.n + 1
        base = np.add.reduceat(np.log10((count + 1) / (n + v + 1)), begin)
        return pa.table(
            {
                "key": tokens.keys,
                "held_out": pa.array(~tokens.train),
                "n_tokens": pa.array(tokens.n),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
                "train_tokens": pa.array(np.full(len(begin), n, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(np.add.reduceat(logs, begin)),
            }
        )

    return scores


def score(
    docs: DataFrame, held_out: Column, scratch: Scratch, text: str = "text", key: str = "doc_id", order: int = ORDER,
    strength: float = STRENGTH, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    The model is learnt from all rows where ``held_out``, a condition on the key, is False. Tokens are
    runs of other bytes than ASCII white space, A-Z lower-cased, and an end; NULL is an empty text. An
    end is all that such a text has. Repeated rows are learnt and scored each; an empty table gives
    an empty one. With nothing to learn from, every token has the probability of an unseen one. Other
    columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length(text) + 1).alias("bytes")).first()
    if not size["rows"]:
        return spark.createDataFrame([], schema)
    total = size["bytes"] or 1
    blocks = -(-total // block_bytes)
    bits = max(0, (total // shard_bytes).bit_length())
    chosen = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (~F.coalesce(held_out, F.lit(False))).alias("train"),
        F.pmod(F.xxhash64(key, text), F.lit(blocks)).alias("block"),
    )
    packed = chosen.mapInArrow(_pack(blocks), "block long, data binary")
    asked = packed.groupBy("block").applyInArrow(_ask(order, bits), REQUEST)
    answers = scratch.keep(
        asked.groupBy("order", "shard").applyInArrow(_answer, "order int, shard int, block long, totals binary")
    )
    # Of each shard of single tokens two numbers: how many tokens were learnt, and how many different.
    sums = answers.filter("block = -1 and `order` = 1").select("totals").collect()
    n, v = np.sum([np.frombuffer(bytes(r["totals"]), "<i8") for r in sums], axis=0).tolist()
    scored = (
        packed.groupBy("block")
        .cogroup(answers.filter("block >= 0").groupBy("block"))
        .applyInArrow(_score(order, n, v, strength), schema.replace(f"`{key}`", "key", 1))
    )
    return scored.withColumnRenamed("key", key)
