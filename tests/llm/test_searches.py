"""WARC, packing, and the two vector searches: SQL, brute force, and odd rows."""

import numpy as np
import pytest
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from racecast.llm import multi_index, packing, voronoi, warc
from racecast.llm.common import Scratch, tokenizer_path
from racecast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert difference(spark, SF, connect(SF), QUERIES[name], ORACLES[name]) is None


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int, sha string, number int")


def archived(spark, df, tmp_path, **options):
    warc.write(df, str(tmp_path / "w"), **options)
    return {
        (r["page_id"], r["url"]): r for r in warc.resolved(warc.read(spark, str(tmp_path / "w"))).collect()
    }


def test_warc_odd_rows(spark, tmp_path):
    long = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\né" * 3000
    rows = [
        (1, "a", None, 0, "", 0), (2, "b", "", 0, "", 0), (3, None, long, 0, "", 0), (4, "d\r\ne", long, 0, "", 0),
        (None, "f", "only", 0, "", 0), (7, "g", "same", 0, "", 0), (7, "h", "same", 0, "", 0), (6, "i", "same", 0, "", 0),
    ]
    got = archived(spark, pages(spark, rows), tmp_path, segment=1000)
    assert len(got) == 8 and all(r["valid"] for r in got.values())
    assert got[1, "a"]["refers_to"] == 2 and got[1, "a"]["payload_bytes"] == 0
    assert got[3, None]["refers_to"] == 4 and got[4, "de"]["payload"].decode() == long
    assert got[3, None]["payload_bytes"] == len(long.encode()) == got[4, "de"]["payload_bytes"]
    assert got[None, "f"]["record_type"] == "response"
    assert got[7, "g"]["record_type"] == got[7, "h"]["record_type"] == "response" and got[6, "i"]["refers_to"] == 7


def test_warc_empty_table_and_smallest_payload(spark, tmp_path):
    assert not archived(spark, pages(spark, []), tmp_path)
    got = archived(spark, pages(spark, [(1, "a", "xy", 0, "", 0), (2, "b", "xy", 0, "", 0)]), tmp_path / "2", min_bytes=3)
    assert {r["record_type"] for r in got.values()} == {"response"}


def test_warc_damage_is_seen(spark):
    rows = [
        ("o", "response", 1, "u", "D", None, 1, "o", None, bytearray(b"ab"), True),
        ("o3", "continuation", None, None, None, None, 3, "o", 6, bytearray(b"ef"), True),
        ("p", "response", 2, "u", "D", None, 1, "p", None, bytearray(b"ab"), True),
        ("p2", "continuation", None, None, None, None, 2, "p", 4, bytearray(b"cd"), True),
    ]
    got = {r["page_id"]: r for r in warc.reassembled(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert not got[1]["whole"] and got[2]["whole"] and bytes(got[2]["content"]) == b"abcd"


@given(st.binary(max_size=200), st.integers(1, 50))
def test_chunked_round_trip(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=12), st.integers(1, 40))
def test_fullest_is_the_best_sum(available, room):
    best, items = 0, [x for x, n in available.items() for _ in range(n)]
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums if s + x <= room}
    best = max(sums)
    chosen = packing.fullest(available, room)
    assert sum(chosen) == best and all(chosen.count(x) <= available[x] for x in set(chosen))


def test_packing(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 1), (3, "word " * 5000, 2), (4, "日本 \U0001f600 naïve", 3), (4, "日本 \U0001f600 naïve", 3)]
        + [(k, "some words here " * k, 0) for k in range(5, 60)],
        "doc_id long, text string, length int",
    )
    path = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(docs, path, Scratch(spark), width=128).toPandas()
    assert (got[["doc_id", "piece"]].drop_duplicates().shape[0]) == len(got) - 1  # the repeated row
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= 128
    long = got[got.doc_id == 3].sort_values("piece")
    assert (long["start"] == long["length"].cumsum() - long["length"]).all() and (long["length"][1:] == 128).all()
    assert got.sequence_id.nunique() <= 1.02 * got["length"].sum() / 128 + 1
    assert got[got.doc_id == 1]["length"].tolist() == [1]
    assert packing.pack(docs.limit(0), path, Scratch(spark)).count() == 0


def test_fast_encoder_agrees_with_the_tokenizer():
    slow, fast = packing._tokenizer(tokenizer_path("byte_bpe_50k.json"))
    texts = [w.replace("@", chr(c)) for c in range(256) for w in ("a@b", "1@2", " @ ", "@@", "x@ @\n@  y", "<|endoftext|>@")]
    assert [x.ids for x in slow.encode_batch(texts, add_special_tokens=False)] == [fast.encode_ordinary(t) for t in texts]


def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in rng.normal(size=8)], 1.0) for k in range(300)]
    rows += [(k, rows[3][1], 1.0) for k in range(300, 420)]  # one crowded vector
    rows += [(1000, None, 0.0), (1100, [float("nan")] + [0.0] * 7, 0.0), (1200, [None] + [1.0] * 7, 0.0)]
    rows += [(1300, [0.0] * 8, 0.0), (None, [1.0] * 8, 0.0), (1400, [1.0, 2.0], 0.0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, norm double"), rows


def padded(vector):
    return np.array(vector + [0.0] * (8 - len(vector)))


def test_voronoi_is_exact(spark):
    df, rows = vectors(spark)
    data = voronoi.lattice(df, "vec_id", "embedding", 16.0)
    got = voronoi.top_inner_products(
        data, F.col("id") % 20 == 0, Scratch(spark), k=4, pivots=6, query_block=5, data_slice=50
    ).collect()
    good = [(i, np.floor(16 * padded(v))) for i, v, _ in rows if i is not None and i not in (1000, 1100, 1200)]
    want = set()
    for i, q in good:
        if i % 20 == 0:
            order = sorted((-int(q @ x), j) for j, x in good if j != i)[:4]
            want |= {(i, r, j, -s) for r, (s, j) in enumerate(order, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_voronoi_repeated_query_id(spark):
    """A query's own rows, more than k + 1, equal or not, are no answers that its bound may count on."""
    rows = [(0, [-100.0, 100.0])] * 15 + [(0, [k - 99.0, 120.0]) for k in range(15)]
    rows += [(k, [k - 50.0, 50.0]) for k in range(1, 31)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = voronoi.top_inner_products(df, F.col("id") == 0, Scratch(spark)).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(k, 100 * (50 - k) + 5000) for k in range(1, 11)]


def test_voronoi_whole_numbers_beyond_doubles(spark):
    big = [(0, [2.0**31, 1.0]), (1, [2.0**30, 1.0]), (2, [2.0**30, 2.0])]
    df = spark.createDataFrame(big, "id long, vector array<double>")
    got = voronoi.top_inner_products(df, F.col("id") == 0, Scratch(spark)).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 2**61 + 2), (1, 2**61 + 1)]


def test_multi_index_recall_and_distances(spark):
    df, rows = vectors(spark)
    got = multi_index.nearest(
        df, "vec_id", "embedding", F.col("id") % 20 == 0, Scratch(spark), k=5, centroids=8, slice_rows=60
    ).collect()
    good = {i: padded(v) for i, v, _ in rows if i is not None and i not in (1000, 1100, 1200, 1300)}
    hits = wanted = 0
    for i, q in good.items():
        if i % 20 == 0:
            own = [r for r in got if r["query_id"] == i]
            assert sorted(r["rank"] for r in own) == [1, 2, 3, 4, 5]
            assert all(r["score"] == np.sqrt(((good[r["vec_id"]] - q) ** 2).sum()) for r in own)
            want = sorted((np.sqrt(((x - q) ** 2).sum()), j) for j, x in good.items() if j != i)[:5]
            hits += len({j for _, j in want} & {r["vec_id"] for r in own})
            wanted += 5
    assert hits >= 0.9 * wanted


def test_multi_index_query_recall(spark):
    got = QUERIES["op7_multi_index"](spark, SF).toPandas()
    want = connect(SF).execute(
        "WITH s AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS d"
        " FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)"
        " SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) <= 10"
    ).df()
    both = want.merge(got, on=["query_id", "vec_id"])
    assert len(both) >= 0.9 * len(want) and np.allclose(both["d"], both["score"], atol=1e-9)


@settings(deadline=None, max_examples=30)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(0, 40), st.randoms())
def test_visits_come_in_order_and_suffice(n, m, wanted, rng):
    first, second = np.array([rng.random() for _ in range(n)]), np.array([rng.random() for _ in range(m)])
    counts = np.array([[rng.randint(0, 5) for _ in range(m)] for _ in range(n)])
    seen = multi_index.visit(first, second, counts, wanted)
    sums = first[seen // m] + second[seen % m]
    assert (np.diff(sums) >= 0).all() and len(set(seen.tolist())) == len(seen)
    held = counts.ravel()[seen].sum()
    assert held >= min(wanted, counts.sum())


def test_searches_over_nothing(spark):
    df, _ = vectors(spark)
    none = df.limit(0)
    assert multi_index.nearest(none, "vec_id", "embedding", F.lit(True), Scratch(spark)).count() == 0
    assert voronoi.top_inner_products(voronoi.lattice(none, "vec_id", "embedding"), F.lit(True), Scratch(spark)).count() == 0
