"""N-gram Jaccard join of documents by MinHash banding, verified exactly.

Every text has a key for each of a number of trees: a hash of its first minima there, as many as still
find a pair at the threshold with the wanted probability. That depth is fixed before any data is read,
since threshold and recall alone decide it; so this is banding, which took the place of an LSH forest with
prefixes shortened step by step. Texts with an equal key in some tree are candidates. All
pairs within a group of candidates are then verified on the shingles themselves, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import Scratch, packed, slices, string_bytes, unpack
from racecast.llm.groups import connected_groups, in_blocks
from racecast.llm.line_dedup import forest
from racecast.llm.words import ODD, mix, sequence_keys, shingles, word_hashes

WORDS = 5
# Similarity as a fraction of whole numbers, so that the comparison is exact.
THRESHOLD = (4, 5)
TREES, DEPTH, RECALL = 20, 8, 0.999
BLOCK = 512
COLUMNS = 8_192


def matched_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which some tree joins a pair at the threshold with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def prefix_keys(grams: np.ndarray, counts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """(texts, trees) hashes of each text's signature prefix of ``depth`` minima in every tree."""
    out = np.zeros((len(counts), trees), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    starts = (np.cumsum(counts) - counts)[full]
    low = (grams >> np.uint64(32)).astype(np.uint32)
    seeds = mix(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64)).astype(np.uint32).reshape(-1, 2)
    value = np.empty_like(low)
    for tree in range(trees):
        key = np.zeros(len(full), np.uint64)
        for a, b in seeds[tree * depth : (tree + 1) * depth]:
            np.multiply(low, a | np.uint32(1), out=value)
            value += b
            key = key * ODD + np.minimum.reduceat(value, starts)
        out[full, tree] = mix(key)
    return out


def _sketch(trees: int, depth: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(batch.column("text"))
            for first, last in slices(offsets):
                own = data[offsets[first] : offsets[last]]
                hashes, counts = word_hashes(own, offsets[first : last + 1] - offsets[first])
                one, two = sequence_keys(hashes, counts)
                grams, n = shingles(hashes, counts, words)
                keys = prefix_keys(grams, n, trees, depth)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), trees)
                columns = [batch.column("doc_id").slice(first, last - first), pa.array(one.view(np.int64))]
                columns += [pa.array(two.view(np.int64)), pa.array(n > 0), lists.cast(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "check", "some", "keys"])

    return run


def _sets(words: int):
    """Shingles of each text, once each and sorted, as bytes; texts that are not the class's are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(pa.array(unpack(batch.column("_packed")), pa.string()))
            nodes = batch.column("node").to_numpy()
            for first, last in slices(offsets):
                own = data[offsets[first] : offsets[last]]
                hashes, counts = word_hashes(own, offsets[first : last + 1] - offsets[first])
                one, _ = sequence_keys(hashes, counts)
                grams, n = shingles(hashes, counts, words)
                parts = np.split(grams, np.cumsum(n)[:-1])
                same = np.flatnonzero(one.view(np.int64) == nodes[first:last])
                rows = batch.take(pa.array(same + first)).drop_columns(["_packed"])
                sets = [np.unique(parts[k]).tobytes() for k in same]
                yield rows.append_column("grams", pa.array(sets, pa.binary()))

    return run


def shared(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many items each pair of sets shares: of ``left`` with ``right``, or with itself.

    Sets become rows of 0 and 1 over the items that two or more of them have, and products of such
    rows over a bounded number of columns at a time are summed.
    """
    both = left if right is None else left + right
    rows = np.repeat(np.arange(len(both)), [len(s) for s in both])
    _, column, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    kept = often[column]
    rows, column = rows[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    n, out = len(left), np.zeros((len(left), len(both) if right is None else len(right)), np.float32)
    for first in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        x = np.zeros((len(both), COLUMNS), np.float32)
        x[rows[a:b], column[a:b] - first] = 1
        out += x @ x.T if right is None else x[:n] @ x[n:].T
    return out.astype(np.int64)


def _verify(threshold: tuple[int, int]):
    above, below = threshold

    def links(table: pa.Table) -> pa.Table:
        """Per text of a task its number of linked documents and the least text of its connected group here."""
        table = table.sort_by("root")
        root, node = table.column("root").to_numpy(), table.column("node").to_numpy()
        copies, side = table.column("copies").to_numpy(), table.column("side").to_numpy()
        other = table.column("other").to_numpy()
        grams = table.column("grams").combine_chunks()
        starts = np.flatnonzero(np.r_[True, root[1:] != root[:-1]]) if len(root) else np.zeros(0, int)
        out: list[tuple[np.ndarray, ...]] = []
        for first, last in zip(starts, [*starts[1:], len(root)]):
            _, at = np.unique(np.stack([node[first:last], side[first:last]]), axis=1, return_index=True)
            at = at + first
            sets = [np.frombuffer(grams[int(k)].as_buffer(), np.uint64) for k in at]
            size = np.array([len(s) for s in sets])
            own = side[at] if (side[at] != other[at]).any() else None
            a, b = (np.arange(len(at)),) * 2 if own is None else (np.flatnonzero(own == s) for s in (own.min(), own.max()))
            if not len(a) or not len(b) or own is not None and own.min() == own.max():
                continue
            right = None if own is None else [sets[k] for k in b]
            common = shared([sets[k] for k in a], right)
            linked = common * (above + below) >= above * (size[a][:, None] + size[b][None, :])
            if own is None:
                np.fill_diagonal(linked, False)
            # ``at`` is in the order of nodes, so the least number of a group is its least node.
            x, y = np.nonzero(linked)
            under, over = forest(len(at), a[x], b[y])
            least = np.arange(len(at))
            least[under] = over
            for x, y, m in ((a, b, linked),) if own is None else ((a, b, linked), (b, a, linked.T)):
                has = m.any(axis=1)
                out.append((node[at[x]][has], (m @ copies[at[y]])[has], node[at[least[x]]][has]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("node", "links", "least"), columns)})

    return links


def near_duplicates(
    docs: DataFrame, scratch: Scratch, text: str = "text", key: str = "doc_id", words: int = WORDS,
    threshold: tuple[int, int] = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row for every row of ``docs``: key, class_id, copy_of and n_links.

    Two documents are linked if the Jaccard similarity of their sets of ``words`` successive words,
    lower-cased, is at least the threshold; a shorter text is one shingle of all its words. ``n_links``
    counts all linked documents, copies included; ``class_id`` is the smallest key of the connected
    group, ``copy_of`` the smallest key with the same words. Texts without words, NULL included, are
    linked to nothing. Rows with a NULL key take no part and have NULL classes and no links; rows that
    repeat a key count as copies. Links found are exact; a link at the threshold is missed with a
    chance of 1 - ``recall``, a closer one with less. An empty table gives an empty one.
    """
    share = threshold[0] / threshold[1]
    level = matched_depth(share, trees, depth, recall)
    rows = docs.select(F.col(key).alias("doc_id"), F.lower(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketches = scratch.keep(
        rows.mapInArrow(
            _sketch(trees, level, words), f"doc_id {kind}, node long, check long, some boolean, keys array<long>"
        )
    )
    known = sketches.filter("some and doc_id is not null")
    classes = known.groupBy("node", "check").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    # Copies have equal signatures: their keys are the same, so one row for each class and tree is left.
    keys = known.select("node", F.posexplode("keys").alias("tree", "prefix")).distinct()
    least = keys.groupBy("tree", "prefix").agg(F.min("node").alias("v"), F.count("*").alias("n")).filter("n > 1")
    candidates = keys.join(least.drop("n"), ["tree", "prefix"]).select(F.col("node").alias("u"), "v").filter("u <> v")
    members = scratch.keep(connected_groups(candidates, scratch).join(classes.drop("check"), "node"))

    tasks = max(1, members.count() // (2 * block))
    dealt = in_blocks(members, "node", "root", block, tasks).withColumnRenamed("rep", "doc_id")
    # A hint, so that the plan is the same whatever the number of candidates.
    texts = packed(rows).join(dealt.hint("merge"), "doc_id")
    texts = texts.select("node", "root", "copies", "side", "other", "task", "_packed")
    sets = texts.mapInArrow(
        _sets(words), "node long, root long, copies long, side int, other int, task long, grams binary"
    )
    found = scratch.keep(
        sets.groupBy("task").applyInArrow(_verify(threshold), "node long, links long, least long")
    )
    groups = connected_groups(found.select(F.col("node").alias("u"), F.col("least").alias("v")), scratch)
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = groups.join(classes, "node")
    ids = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    linked = groups.join(ids, "root").join(counted, "node").select("node", "class_id", "links")
    by_class = classes.join(linked, "node", "left").select(
        "node",
        "check",
        F.coalesce("class_id", "rep").alias("_class"),
        F.col("rep").alias("_rep"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
    )
    joined = sketches.drop("keys").join(by_class, ["node", "check"], "left")
    part = F.col("some") & F.col("doc_id").isNotNull()
    return joined.select(
        F.col("doc_id").alias(key),
        F.when(part, F.col("_class")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(part, F.col("_rep")).otherwise(F.col("doc_id")).alias("copy_of"),
        F.when(part, F.col("_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, scratch: Scratch, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with only the first document, by key, of each connected group of near-duplicates.

    Of rows that repeat a key one stays; rows with a NULL key stay.
    """
    found = near_duplicates(docs, scratch, text, key, **options)
    keep = found.filter(F.col(key) == F.col("class_id")).select(key).distinct()
    columns = docs.columns
    kept = docs.join(keep, key, "left_semi").dropDuplicates([key]).select(*(F.col(c) for c in columns))
    return kept.union(docs.filter(F.col(key).isNull()))
