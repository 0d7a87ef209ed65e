"""Operators on texts: brute force, round trips, held-out accuracy, and odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from racecast.llm import byte_bpe, html_text, jaccard, language_id, line_dedup, lm_scoring
from racecast.llm.common import Scratch, table, tokenizer_path
from racecast.llm.elias_fano import EliasFano
from racecast.llm.queries import QUERIES
from racecast.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}


# Main text


def test_main_text():
    page = """<body><header class="site"><p>Welcome, all of you.</p></header><div id="main-menu"><a href=x>A</a></div>
    <div class="cookie-notice">We use cookies; many, indeed. Please accept: it is a long notice, with marks.</div>
    <div class="content"><div class="post"><header class="post-header"><h2>Title</h2></header>
    <p>First, with <b>bold</b><br>and <span class="share">Share</span> more; text   here. Caf&eacute; &amp; co
    <p>Short.<ul><li>One item<li>Two</ul><form><label>Mail</label></form></div><div class="sidebar"><p>Side, of it.</p></div>
    <section id="comments"><div class="comment"><p>Great article, really! Thanks, so much.</p></div></section></div>
    <script>var x = "</p>";</script><footer>Foot, of all.</footer>"""
    got = html_text.main_text(page)
    assert "First, with bold and " in got and "more; text here. Café & co\n\nShort.\n\nOne item\n\nTwo" in got
    for other in ("Welcome", "cookies", "Side", "Great", "Foot", "var x", "Mail", "<"):
        assert other not in got


@pytest.mark.parametrize("page, text", [("", ""), ("plain", "plain"), ("<nav>a</nav>", ""), ("<p>Hi<script>x", "Hi")])
def test_main_text_of_little(page, text):
    assert html_text.main_text(page) == text


LONG = "".join(f"<p>Part {k} of the body, with some words; and more, to be long.</p>" for k in range(80))
PARTS = {
    "title and lead": ("<h1>Title</h1><p class=lead>The lead.</p>", f"<div class=body>{LONG}</div>", ""),
    "last section": ("<h1>Title</h1>", f"<section>{LONG}</section>", "<section><h2>End</h2><p>The end.</p></section>"),
    "list": ("<h1>Title</h1><p>Before.</p>", f"<ul>{LONG.replace('p>', 'li>')}</ul>", "<p>After.</p>"),
    "quote": ("<p>Before.</p>", f"<blockquote>{LONG}</blockquote>", "<p>After.</p>"),
    "table": ("<p>Before.</p>", f"<table>{LONG.replace('<p>', '<tr><td>').replace('</p>', '</td></tr>')}</table>", "<p>After.</p>"),
}


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<main>{}</main>", "<div role=main>{}</div>", "<div>{}</div>"])
@pytest.mark.parametrize("name", PARTS)
def test_main_text_of_nested_layouts(outer, name):
    inner = "".join(PARTS[name])
    page = f"<body><nav><a href=x>Home</a></nav>{outer.format(inner)}<aside><p>Beside, it is.</p></aside></body>"
    assert html_text.main_text(page).split() == re.sub("<[^>]*>", " ", inner).split()


def test_main_text_keeps_links_and_math():
    math = "<math><mi>a</mi><mo>=</mo><mi>b</mi><annotation>a = b</annotation></math>"
    links = "<ul><li><a href=x>Source one</a><li><a href=y>Source two</a></ul>"
    got = html_text.main_text(f"<body><article><div>{LONG}</div><p>So {math} holds.</p>{links}</article></body>")
    assert got.endswith("So a=b holds.\n\nSource one\n\nSource two")


@settings(deadline=None, max_examples=200)
@given(st.text(st.sampled_from("<>/pabdiv ul\"'=!-&;x"), max_size=80))
def test_main_text_of_broken_markup(page):
    html_text.main_text(page)


def test_articles_of_the_test_pages(spark):
    from html import unescape

    for row in QUERIES["op2_html_text"](spark, SF).join(table(spark, SF, "pages").drop("url"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S).group(1)
        words = unescape(re.sub("<[^>]*>", " ", article)).split()
        assert row["text"].split() == words and row["n_chars"] == len(row["text"])


def test_html_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a</p>", "y")], "page_id long, url string, html string, text string")
    assert {(r["page_id"], r["text"]) for r in html_text.extract(df).collect()} == {(1, ""), (None, "a")}
    assert html_text.extract(df.limit(0)).count() == 0


# Byte-level BPE


@pytest.fixture(scope="module")
def coders():
    ranks = byte_bpe.load_ranks(RANKS)
    own = byte_bpe.Coder(ranks, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(deadline=None, max_examples=150)
@given(st.text(max_size=60) | st.text(st.sampled_from("aabn =.é"), max_size=200))
def test_ids_of_any_text(coders, text):
    own, other = coders
    ids = next(own.encode([text]))
    assert ids == other.encode_ordinary(text) and own.decode(ids) == text.encode()


@settings(deadline=None, max_examples=60)
@given(st.binary(max_size=60), st.binary(max_size=8), st.data())
def test_edits_of_prefixes(coders, data, new, draw):
    vocabulary = coders[0].vocabulary
    end = draw.draw(st.integers(0, len(data)))
    start = draw.draw(st.integers(0, end))
    own = byte_bpe.Prefixes(vocabulary, data)
    own.edit(start, end, new)
    whole = data[:start] + new + data[end:]
    assert own.data == whole and own.last == byte_bpe.Prefixes(vocabulary, whole).last
    own.append(b"xyz")
    assert own.last == byte_bpe.Prefixes(vocabulary, whole + b"xyz").last


def test_bpe_query(spark, coders, texts):
    for r in QUERIES["op4_byte_bpe"](spark, SF).collect():
        ids = coders[1].encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# Language


def test_language_accuracy(spark):
    docs = table(spark, SF, "documents").select("doc_id", "lang", "n_chars")
    got = QUERIES["op9_language_id"](spark, SF).join(docs, "doc_id").filter("held_out and n_chars > 100").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95 and got.score.between(0, 1).all() and got.accepted.all()


def test_language_odd_rows(spark):
    docs = table(spark, SF, "documents")
    model = language_id.fit(docs, sample=30, calibration=5)
    rows = [(1, None, "en"), (2, "", None), (3, "12 !!", "x"), (4, "\x00", "x"), (5, "жизнь и книга " * 20, "x"), (None, "the " * 30, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string").withColumn("_text", F.lit("z"))
    got = {r["doc_id"]: r for r in language_id.identify(df, model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["lang_score"] == 0 and not got[k]["lang_accepted"] for k in (1, 2, 3, 4))
    assert not got[5]["lang_accepted"] and got[None]["lang_accepted"]
    assert language_id.identify(df.limit(0), model).count() == 0
    none = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(df, none).collect()} == {"und"}


def test_probabilities_of_a_context_sum_to_one(spark):
    model = language_id.fit(table(spark, SF, "documents"), sample=20, calibration=2)
    points, scored, _ = language_id.normalised(["the"])
    letters = [chr(c) for c in range(32, 0x250) if chr(c).isalpha() and chr(c).lower() == chr(c)] + [" "]
    total = 0.0
    for letter in letters:
        at = np.concatenate([points, [np.uint64(ord(letter))]])
        total += np.exp(model.log_probabilities(at, np.array([len(at) - 1])))
    assert (total < 1.02).all() and (total > 0.9).all()


# Lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(deadline=None)
@given(st.text("ab", max_size=10), st.text("abc", max_size=10), st.integers(0, 7))
def test_edit_distance(a, b, most):
    assert line_dedup.within(a, b, most) == (distance(a, b) <= most)


def kept_lines(texts):
    """Brute force over all pairs of lines, by edit similarity alone."""
    lines = [(i, k, x) for i, t in sorted(texts.items()) for k, x in enumerate((t or "").split("\n"))]
    forms = [line_dedup.normal_form(x) for _, _, x in lines]
    first: dict[str, int] = {}
    own = [first.setdefault(f, k) for k, f in enumerate(forms)]
    classes = [k for f, k in first.items() if f]
    classes.sort(key=lambda k: len(forms[k]))
    sizes = np.array([len(forms[k]) for k in classes])
    letters = np.array([np.bincount([ord(x) % 64 for x in forms[k]], minlength=64) for k in classes]).reshape(-1, 64)
    group = {k: k for k in classes}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(classes)):
        most = int(0.1 * sizes[a] / 0.9 + 1)  # edits turn at most two counts of letters each
        end = np.searchsorted(sizes, sizes[a] + most, "right")
        for b in np.flatnonzero(np.abs(letters[a + 1 : end] - letters[a]).sum(axis=1) <= 2 * most) + a + 1:
            if line_dedup.similar(forms[classes[a]], forms[classes[b]]):
                x, y = root(classes[a]), root(classes[b])
                group[max(x, y)] = min(x, y)
    out = collections.defaultdict(list)
    for k, (i, _, x) in enumerate(lines):
        if not forms[k] or root(own[k]) == k:
            out[i].append(x)
    return {i: "\n".join(out[i]) for i in texts}


def test_pairs_verified_together_as_one_by_one():
    rng = np.random.default_rng(5)
    texts = ["", "a"]
    for size in rng.integers(1, 400, 60):
        texts.append("".join(rng.choice(list("abcé日 "), size)))
        for _ in range(3):
            other = list(texts[-1])
            for at in rng.integers(0, len(other) or 1, rng.integers(1, 2 + len(other) // 6) if other else 0):
                other[at] = rng.choice(["", "a", "xy", "日"])
            texts.append("".join(other))
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    near = np.abs(a - b) < 4
    a, b = a[near], b[near]
    for similarity in (0.9, 0.6):
        most = [int((1 - similarity) * max(len(texts[i]), len(texts[j])) + 1e-9) for i, j in zip(a, b)]
        want = [line_dedup.within(texts[i], texts[j], m) for i, j, m in zip(a, b, most)]
        got = line_dedup.Characters(texts).within(a, b, np.array(most))
        assert got.tolist() == want and 300 < sum(want) < len(want)
    for wide in ([chr(0x4E00 + k) for k in range(300)], [chr(0x1000 + k) for k in range(66_000) if not 0xD800 <= 0x1000 + k < 0xE000]):
        line = "".join(wide)
        pair = line_dedup.Characters([line, line[:7] + "x" + line[8:-1]])
        assert [pair.within(*(np.array([v]) for v in (0, 1, m)))[0] for m in (1, 2)] == [False, True]


def test_lines_of_a_group_are_verified_without_a_run_of_python_for_each_pair(monkeypatch):
    """Each pair that is not similar was verified twice, one pair at a time."""
    rng, calls = np.random.default_rng(6), []
    line = rng.choice(list("abcdefgh"), 300)
    forms = ["".join(np.where(rng.random(300) < share, "z", line)) for share in (0.0, 0.02, 0.03, *[0.3] * 60)]
    alone = line_dedup.within
    monkeypatch.setattr(line_dedup, "within", lambda *x: calls.append(x) or alone(*x))
    n = len(forms)
    zeros = pa.array(np.zeros(n, np.int64))
    columns = {c: zeros for c in ("root", "side", "other", "sim", "letters")}
    rows = pa.table({"node": pa.array(range(n)), "size": pa.array([300] * n), "form": pa.array(forms), **columns})
    links = line_dedup._verified(64, 0.9)(rows).to_pylist()
    assert {(min(x.values()), max(x.values())) for x in links} >= {(0, 1)} and not calls
    joined = line_dedup.forest(n, *(np.array([x[c] for x in links]) for c in "uv"))
    assert joined[0].tolist() == [1, 2] and joined[1].tolist() == [0, 0]


@pytest.mark.parametrize("cut", [False, True])
def test_links_of_a_group_of_near_lines_are_fewer_than_its_lines(cut, monkeypatch):
    """Lines that were not joined yet met every line of a group: its links and runs grew with the square of its size."""
    rng, tried = np.random.default_rng(8), []
    line = rng.choice(list("abcdefgh"), 300)
    forms = ["".join(np.where(rng.random(300) < 0.03, "z", line)) for _ in range(200)]
    forms += ["".join(rng.choice(list("ijkl"), 300)) for _ in range(3)]
    together = line_dedup.Characters.within
    monkeypatch.setattr(line_dedup.Characters, "within", lambda self, a, *x: tried.append(len(a)) or together(self, a, *x))
    n = len(forms)
    zeros = np.zeros(n, np.int64)
    side = np.arange(n) % 2 * cut
    columns = {"side": side, "other": 1 - side if cut else side} | {c: zeros for c in ("root", "sim", "letters")}
    rows = pa.table({"node": np.arange(n), "size": zeros + 300, "form": forms, **columns})
    links = line_dedup._verified(64, 0.9)(rows).to_pylist()
    assert len(links) == 199 and sum(tried) < 1000
    joined = line_dedup.forest(n, *(np.array([x[c] for x in links]) for c in "uv"))
    assert joined[0].tolist() == list(range(1, 200)) and set(joined[1].tolist()) == {0}


def test_counts_of_neighbouring_characters_lose_no_similar_pair():
    rng = np.random.default_rng(9)
    forms = ["", "a"] + ["".join(rng.choice(list("abcé日 "), rng.integers(1, 60))) for _ in range(80)]
    forms += [f[:3] + "日b" + f[4:] for f in forms]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(forms)), np.arange(len(forms))))
    apart = np.array([distance(forms[x], forms[y]) for x, y in zip(a, b)])
    bigrams = line_dedup.Bigrams(forms)
    assert bigrams.allow(a, b, apart).all() and not bigrams.allow(a, b, apart // 3).all()


def test_rows_of_shared_buckets_over_batches():
    """All rows went on to the shuffle with all columns, also those of buckets with a single class."""
    rng = np.random.default_rng(10)
    for width in (1, 2, 7, 300):
        bucket = np.sort(np.r_[rng.integers(0, 200, 150), [300] * 20])
        rows = pa.record_batch({"bucket": bucket, "node": np.arange(len(bucket))})
        parts = [rows.slice(0, 0), *(rows.slice(k, width) for k in range(0, len(bucket), width))]
        got = [x for part in line_dedup._shared(iter(parts)) for x in part.column("node").to_pylist()]
        _, at, n = np.unique(bucket, return_inverse=True, return_counts=True)
        want = np.flatnonzero(n[at] > 1).tolist()
        # A row goes out once another one of its bucket is seen.
        assert sorted(got) == want and 0 < len(want) < len(bucket)


def test_line_dedup_query(spark, texts):
    got = {r["doc_id"]: r["text"] for r in QUERIES["op10_line_dedup"](spark, SF).collect()}
    assert got == kept_lines(texts)


@pytest.mark.parametrize("n", [5, 6, 7, 8, 12, 20, 23, 24, 30, 45, 63, 64, 80])
def test_near_lines_share_a_block(n):
    """One word of every fifteen changed, left out or added; words of some letters."""
    rng = np.random.default_rng(n)
    lines, found, total = [], 0, 0
    for _ in range(200):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrst"), 7)) for _ in range(n)]
        other = list(words)
        for at in sorted(rng.choice(n, max(1, n // 15), replace=False).tolist(), reverse=True):
            other[at : at + 1] = [[other[at][:-1] + "x"], [], [other[at], "yz"]][rng.integers(3)]
        lines.append((" ".join(words), " ".join(other)))
    for a, b in lines:
        if line_dedup.similar(a, b):
            hashes, counts = word_hashes(np.frombuffer(f"{a}\n{b}\n".encode(), np.uint8), np.array([0, len(a) + 1, len(a) + len(b) + 2]))
            sims = line_dedup.simhashes(hashes, counts)
            keys, own = line_dedup.line_blocks(hashes, counts)
            shared = set(keys[: own[0]].tolist()) & set(keys[own[0] :].tolist())
            found += bool(shared) and int(sims[0] ^ sims[1]).bit_count() <= line_dedup.DISTANCE
            total += 1
    assert total > 50 and found >= 0.95 * total


def test_letters_lose_no_similar_pair():
    rng = np.random.default_rng(1)
    forms = [line_dedup.normal_form("".join(rng.choice(list("abc é日x 7"), rng.integers(5, 60)))) or "a" for _ in range(60)]
    forms += [f[:3] + "日b" + f[4:] for f in forms]
    data = np.frombuffer("".join(f + "\n" for f in forms).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(f.encode()) + 1 for f in forms])
    letters = line_dedup.letter_counts(data, bounds, ~line_dedup.SPACES[data] & (data & 0xC0 != 0x80))
    size = np.array([len(f) for f in forms])
    pairs = np.array([(a, b) for a in range(120) for b in range(120) if line_dedup.similar(forms[a], forms[b], 0.8)])
    assert len(pairs) > 120 and line_dedup.maybe(pairs[:, 0], pairs[:, 1], size, letters, 0.8).all()


def test_line_dedup_groups_of_near_lines_and_odd_rows(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen " * 3
    rows = [(k, f"{base} tail{k % 7}x\n\nunique line number {'abcdefghijklmnopqrst'[k]} of all", "z") for k in range(20)]
    rows += [(50, None, "a"), (51, "", "b"), (None, f"{base} tail1x", "c"), (52, "Hello, World 7!\n...\nhello  world 8", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string").withColumn("node", F.lit(1))
    got = {r["doc_id"]: r for r in line_dedup.deduplicated(df, Scratch(spark)).collect()}
    assert got[50]["text"] is None and got[51]["text"] == "" and got[None]["text"] == f"{base} tail1x"
    assert got[52]["text"] == "Hello, World 7!\n..." and got[52]["n_removed"] == 1
    assert {k: got[k]["text"] for k in range(20)} == {
        k: v for k, v in kept_lines({r[0]: r[1] for r in rows if r[0] is not None and r[1]}).items() if k < 20
    }
    assert line_dedup.deduplicated(df.limit(0), Scratch(spark)).count() == 0


# Near-duplicate documents


def linked(texts):
    sets = {}
    for i, t in texts.items():
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids, group, links = sorted(sets), {i: i for i in sets}, collections.Counter()
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links.update((a, b))
                x, y = group[a], group[b]
                group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    return {i: (group[i], links[i]) for i in sets}


def test_jaccard_query(spark, texts):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op6_ngram_jaccard"](spark, SF).collect()}
    assert got == linked(texts)


def test_jaccard_blocks_and_odd_rows(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[:40] + [f"v{k % 9}"] + words[40:]), 0) for k in range(30)]
    rows += [(100, None, 0), (101, "", 0), (102, "a b", 0), (103, "A  b", 0), (None, "a b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int").withColumn("root", F.lit("x"))
    got = jaccard.near_duplicates(df, Scratch(spark), block=4).collect()
    want = linked({i: t for i, t, _ in rows if i is not None})
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got if r["doc_id"] is not None} == want
    assert [(r["class_id"], r["n_links"]) for r in got if r["doc_id"] is None] == [(None, 0)]
    kept = jaccard.one_of_each(df, Scratch(spark), block=4).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["0", "100", "101", "102", "None"]
    assert jaccard.near_duplicates(df.limit(0), Scratch(spark)).count() == 0


@pytest.mark.parametrize("block", [jaccard.BLOCK, 4])
def test_jaccard_chains(spark, block):
    """Chains where only neighbours are linked: 40 shingles each, of which neighbours share 36."""
    texts, key = {}, 0
    for n in range(4, 21):
        for _ in range(3):
            line = [f"c{key}w{k}" for k in range(44 + 4 * n)]
            for k in range(n):
                texts[key] = " ".join(line[4 * k : 4 * k + 44])
                key += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df, Scratch(spark), block=block).collect()}
    want, first = {}, 0
    for n in range(4, 21):
        for _ in range(3):
            want |= {first + k: (first, 1 if k in (0, n - 1) else 2) for k in range(n)}
            first += n
    assert got == want


def test_depth_reaches_the_recall():
    assert jaccard.matched_depth(0.8, 20, 8, 0.999) == 5 and jaccard.matched_depth(0.8, 1, 8, 0.999) == 1


# Language model


@settings(deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=200))
def test_elias_fano(values):
    values = np.unique(values)
    own = EliasFano.of(EliasFano.build(values).parts())
    assert (own.get(np.arange(len(values))) == values).all()
    asked = np.arange(3002)
    n = np.full(len(asked), len(values))
    place = np.searchsorted(values, asked)
    want = np.where(np.isin(asked, values), place, -1)
    assert (own.find(np.zeros(len(asked), int), n, asked) == want).all()
    half = len(values) // 2
    assert (own.find(np.full(len(asked), half), n, asked) == np.where(want >= half, want, -1)).all()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, order):
    rows = [(k, t) for k, t in enumerate(["the cat sat", "The cat ran", "a dog ran\tfar", "the dog", "", None, "cat é cat"] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x"))
    held = language_id.held_out(F.col("doc_id"), 7, 2)
    got = lm_scoring.score(df, held, Scratch(spark), order=order, strength=5.0, block_bytes=60, shard_bytes=40).collect()
    tokens = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["</s>"] for k, t in rows}
    learnt = [k for k in tokens if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = collections.Counter()
    for k in learnt:
        line = ["<s>"] + tokens[k]
        for n in range(1, order + 1):
            counts.update(tuple(line[p - n + 1 : p + 1]) for p in range(max(1, n - 1), len(line)))
    n, v = sum(c for g, c in counts.items() if len(g) == 1), sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (n + v + 1)
        seen = len(learnt) if gram[:-1] == ("<s>",) else counts[gram[:-1]]
        return (counts[gram] + 5.0 * p(gram[1:])) / (seen + 5.0)

    assert len(got) == len(rows)
    for r in got:
        own = tokens[r["doc_id"]]
        line = ["<s>"] + own
        score = sum(math.log10(p(tuple(line[max(0, k - order + 1) : k + 1]))) for k in range(1, len(line))) if order > 1 else None
        base = sum(math.log10(p((w,))) for w in own)
        assert r["train_tokens"] == n and r["n_tokens"] == len(own)
        assert r["n_known"] == sum(counts[(w,)] > 0 for w in own) and r["held_out"] == (r["doc_id"] not in learnt)
        assert abs(r["base_score"] - base) < 1e-9
        assert abs(r["score"] - (base if score is None else score)) < 2e-3 * len(own)
    assert lm_scoring.score(df.limit(0), held, Scratch(spark)).count() == 0


def test_squeezed_numbers():
    for keys in ([5], [1, 2, 2**63], list(range(0, 2**20, 1000))):
        keys = np.array(keys, np.uint64)
        assert (lm_scoring.widened(lm_scoring.squeezed(keys)) == keys).all()


# Pipeline


def test_pipeline_stages(spark):
    docs, scratch = table(spark, SF, "documents"), Scratch(spark)
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, SF))
        kept.append((name, docs.count()))
        if name == "line_dedup":
            want = kept_lines({r["doc_id"]: r["text"] for r in before.collect()})
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == {k: t for k, t in want.items() if t.strip()}
        if name == "ngram_jaccard":
            groups = linked({r["doc_id"]: r["text"] for r in before.collect()})
            assert {r["doc_id"] for r in docs.collect()} == {g for g, _ in groups.values()}
            packed = {r["doc_id"] for r in docs.collect()}
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == packed
    total, bins = docs.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert bins <= 1.02 * total / 2048 + 1 and kept[0][1] >= 190
