"""Periodic runs against a search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from racecast.llm import periods
from racecast.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """All (start, length, period), by the definition: each period by itself, smaller ones tried on each stretch."""
    ids = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int64)
    out = []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            x = w[s : e + q]
            if len(x) >= max(12, 2 * q) and not any((x[p:] == x[:-p]).all() for p in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_all_periods(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        words = planted(r.doc_id, WORD.findall(texts[r.doc_id] or ""))
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
        assert (r.n_words, r.n_runs) == (len(words), len(runs))
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(brute_kept(words, runs)))
    assert sum(r.n_runs > 0 for r in rows) > 10


def random_words(rng):
    alphabet = "ab" if rng.random() < 0.5 else "abcdefgh"
    words = []
    while len(words) < 60 or rng.random() < 0.7:
        unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 30))]
        words += unit * rng.randint(1, 6) + unit[: rng.randint(0, len(unit))]
        words += [rng.choice(alphabet) for _ in range(rng.randint(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_catchers_against_all_periods(seed):
    rng = random.Random(seed)
    words = random_words(rng)
    hashes = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    want = brute_runs(words)
    whole = periods.Catchers()
    whole.append(hashes)
    assert [tuple(r) for r in whole.runs().tolist()] == want
    online = periods.Catchers()
    at = 0
    while at < len(hashes):
        step = 1 if seed % 2 else rng.randint(1, 9)
        online.append(hashes[at : at + step])
        at += step
        if rng.random() < 0.1:
            assert [tuple(r) for r in online.runs().tolist()] == brute_runs(words[:at])
    assert [tuple(r) for r in online.runs().tolist()] == want


def test_many_texts_at_once_are_kept_apart():
    rng = random.Random(3)
    texts = [random_words(rng) if rng.random() < 0.7 else ["a"] * rng.randint(0, 30) for _ in range(40)]
    hashes = np.array([zlib.crc32(w.encode()) for t in texts for w in t], np.uint64)
    rows, owner = periods.text_runs(hashes, np.array([len(t) for t in texts]))
    for i, t in enumerate(texts):
        assert [tuple(r) for r in rows[owner == i].tolist()] == brute_runs(t)


def test_odd_rows(spark):
    texts = [None, "", " \n", "x " * 12, "x " * 12, "x " * 11, "a b " * 13, "é " * 40_000, "a b c " * 30_000 + "d"]
    docs = spark.createDataFrame([(t, i, "k") for i, t in enumerate(texts)], "text string, `i` long, runs string")
    got = {r.i: r for r in periods.find(docs, keep=docs.columns).collect()}
    assert [[tuple(x) for x in got[i].runs] for i in range(9)] == [
        [], [], [], [(0, 12, 1)], [(0, 12, 1)], [], [(0, 13, 1)], [(0, 40_000, 1)], [(0, 90_000, 3)]
    ]
    assert [got[i].collapsed for i in range(9)] == ["", "", "", "x", "x", "x " * 10 + "x", "a b", "é", "a b c d"]
    assert got[0].text is None and got[0].n_words == 0
    assert periods.find(docs.limit(0), keep=["i"]).count() == 0
