"""Repair of conversations against a search from the right over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from racecast.llm import conversations
from racecast.llm.common import Scratch, ship_code
from racecast.llm.queries import QUERIES

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def cheapest(rows, insert=5):
    """(cost, audit, repaired turns) of rows (role, text): every suffix is solved for every last initial."""
    found = faults(rows)

    def fits(last, initial):
        return initial == "a" if last == "u" else initial == "u" or (initial == "s" and last == "")

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        choices = []
        if i == len(rows):
            if last in ("", "a"):
                choices.append((0, "", ()))
        else:
            role, text = rows[i]
            late = 5 if found[i] == "t" else 0
            cost, audit, turns = best(i + 1, last, 0)
            choices.append((cost + 2, "D" + audit, turns))
            if found[i] not in "bd":
                for edit, new, more in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if fits(last, new[:1]):
                        cost, audit, turns = best(i + 1, new[0], 0)
                        choices.append((cost + more + late, edit + audit, ((new, text), *turns)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if fits(last, new[0]):
                    cost, audit, turns = best(i, new[0], inserted + 1)
                    choices.append((cost + insert, "I" + audit, ((new, ""), *turns)))
        return min(choices, default=(10**9, "", ()))

    return best(0, "", 0)


def damaged(rows):
    """The rows (conv, turn, role, text) after the query's damage, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: sorted(mine) for conv, mine in out.items()}


def expected(rows):
    turns = [t for known, t, _, _ in rows if known]
    pairs = [(r, t) for _, _, r, t in rows]
    found = faults(pairs)
    cost, audit, repaired = cheapest(pairs)
    lines = "\n".join(f"{r}:{t}" for r, t in repaired)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit,
            hashlib.sha256(lines.encode()).hexdigest())


def check(rows, given):
    want = damaged(given)
    assert len(rows) == len(want)
    for r in rows:
        assert tuple(r)[1:] == expected(want[r.conv_id]), r.conv_id


def test_query_against_all_edits(spark):
    folder = "/root/testdata/sf0.01"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = QUERIES["op12_conversation_repair"](spark, folder).collect()
    check(rows, given)
    assert {c for r in rows for c in r.audit} == set("KRD")  # at these costs a deletion always beats an insertion


SCHEMA = "conv_id long, turn long, role string, text string, node string, at string, `F` long"


def table_of(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", None, 1) for r in rows], SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def random_rows(rng, convs, most):
    texts = ["a.", "b!", "c", "", " ", "d?", "e. \n", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [
        (conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{turn}.")
        for conv in [*range(convs), None]
        for turn in range(rng.randint(0, most))
    ]


def test_random_rows_with_nulls_ties_and_clashing_columns(spark, tmp_path):
    given = random_rows(random.Random(5), 150, 9)
    check(QUERIES["op12_conversation_repair"](spark, table_of(spark, given, tmp_path)).collect(), given)


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_conversation_repair"](spark, table_of(spark, [], tmp_path)).count() == 0


@pytest.mark.parametrize(("size", "fan"), [(1, 2), (3, 2), (4, 3), (1024, 1024)])
def test_blocks_and_levels_give_the_whole_answer(spark, size, fan):
    ship_code(spark)
    rng = random.Random(size)
    given = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "", f"x{t}", f"y{t}."]))
             for c, n in enumerate([1, 2, 7, 40, 90]) for t in range(n)]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    repair = conversations.repair(df, Scratch(spark), rows_per_block=size, fan=fan)
    totals = {r.conv: r for r in repair.totals.collect()}
    shas = {r.conv: r.sha256 for r in conversations.digests(repair.repaired).collect()}
    for c in totals:
        pairs = [(r, t) for conv, _, r, t in given if conv == c]
        cost, audit, turns = cheapest(pairs)
        assert (totals[c].cost, totals[c].audit) == (cost, audit)
        assert totals[c].illegal == sum(a[0][0] + b[0][0] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in turns)
        assert shas.get(c, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(20))
def test_insertions_where_they_are_cheap(seed, monkeypatch):
    monkeypatch.setattr(conversations, "INSERT", 1)
    rng = random.Random(seed)
    pairs = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "", f"x{i}", f"y{i}."])) for i in range(12)]
    codes = [(r[0] if r[0] in "sua" else "x") + f for (r, _), f in zip(pairs, faults(pairs))]
    cost, audit, _ = cheapest(pairs, insert=1)

    def whole(ways):
        return min((w["cost"] + len(conversations.TAIL[w["end"]]), w["rank"], w["audit"] + conversations.TAIL[w["end"]]) for w in ways)

    at_once = conversations.block_ways("".join(codes), True)
    assert (whole(at_once)[0], whole(at_once)[2]) == (cost, audit)
    # In blocks: the ranks alone choose the same way.
    blocks = [conversations.block_ways("".join(codes[i : i + 3]), i == 0) for i in range(0, 12, 3)]
    joined = conversations.joined_ways(blocks, True)
    end = min((w["cost"] + len(conversations.TAIL[w["end"]]), w["rank"], w["end"]) for w in joined)[2]
    states = " " + next(w["trail"] for w in joined if w["end"] == end)
    parts = [next(w["audit"] for w in b if (w["start"], w["end"]) == (states[k], states[k + 1])) for k, b in enumerate(blocks)]
    assert "".join(parts) + conversations.TAIL[end] == audit


def test_very_long_conversation_with_one_row_many_times(spark):
    ship_code(spark)
    rows = spark.range(3000).select(
        F.lit(1).alias("conv_id"), F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id")).alias("turn"),
        F.when(F.col("id") < 2000, "user").when(F.col("id") % 2 == 0, "assistant").otherwise("user").alias("role"),
        F.when(F.col("id") < 2000, "hello.").otherwise(F.concat(F.col("id").cast("string"), F.lit("."))).alias("text"),
    )
    repair = conversations.repair(rows, Scratch(spark), rows_per_block=256, fan=4)
    row = repair.totals.collect()[0]
    # 1,001 turns stay after the copies go, of which the last is a user's.
    assert (row.duplicate, row.cost) == (1999, 2 * 1999 + 2)
    assert row.audit == "K" + "D" * 1999 + "K" * 999 + "D"
