"""Connected groups of links, and the pairs of a group dealt out in blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import Scratch


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Links (u, v) with the smallest of u and all its neighbours as ``m``."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(least, "u")


def connected_groups(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the smallest node of its group.

    Alternates two star contractions until only stars are left, which takes about log(nodes) rounds for
    chains and two or three for cliques. Groups that are one star leave after the round, so that the last rounds
    hold the few that are not. Each round is written to the shared folder, so lineage stays short; the driver sees
    whether a round is the last. A node with many links costs a skewed join, which adaptive execution splits, never
    a collected list.
    """
    first = scratch.keep(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    edges, stars = first, []
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _least_neighbour(large)
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = scratch.keep(hung)
        scratch.let_go(first)
        # Done when every node hangs on one root, and no root hangs on another.
        torn = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
        chained = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_semi")
        loose = scratch.keep(torn.union(chained).distinct())
        if loose.isEmpty():
            break
        # Stars with neither such a node nor such a root are whole groups, which take no part in further rounds.
        open_ = edges.join(loose, "u", "left_semi").select(F.col("v").alias("root")).union(loose).distinct()
        marked = scratch.keep(edges.join(open_.withColumn("open", F.lit(True)), F.col("v") == F.col("root"), "left").drop("root"))
        scratch.let_go(edges, loose)
        stars.append(marked.filter("open is null").select("u", "v"))
        edges = marked.filter("open").select("u", "v")
    for star in stars:
        edges = edges.union(star)
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def in_blocks(members: DataFrame, node: str, root: str, block: int, tasks: int) -> DataFrame:
    """Deal groups out so that every pair of a group meets in some task of bounded size.

    Adds ``task`` (the key to group by), ``side`` and ``other``: groups of up to ``block`` members
    share a task with other small groups (side and other are 0); a larger group is cut into blocks
    by hash, and each pair of blocks is a task of its own, which compares side ``side`` with
    ``other`` (once within a block where both are equal).
    """
    sizes = members.groupBy(root).agg(F.count("*").alias("_n"))
    cut = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    dealt = members.join(sizes, root).withColumn("_cut", cut)
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64(node), F.col("_cut")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_cut") - 1)))
    pair = F.xxhash64(root, F.least("side", "other"), F.greatest("side", "other"))
    task = F.when(F.col("_cut") == 1, F.pmod(F.xxhash64(root), F.lit(tasks))).otherwise(pair)
    return dealt.withColumn("task", task).drop("_n", "_cut")
