"""Personal data against the plain patterns in Python's ``re``, and the added kinds by hand."""

import hashlib
import random
import re

import pytest

from racecast.llm import pii
from racecast.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def holds(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 8 <= len(number) <= 15


def base_spans(text):
    found = ((k, m) for k, p in PATTERNS.items() for m in re.finditer(p, text or ""))
    return [(k, m.start(), m.end()) for k, m in found if holds(k, m.group())]


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return {r.i: [(s.kind, s.start, s.end) for s in r.pii] for r in pii.find(df).collect()}


def base_only(found):
    return [s for s in found if s[0] in PATTERNS]


def test_query_against_plain_patterns(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_pii"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in PATTERNS]
        assert base_only([tuple(s.split(":")) for s in r.spans.split(",") if s]) == [(k, str(a), str(b)) for k, a, b in want]
    assert sum(r.n_email + r.n_card for r in rows) > 0


def test_random_texts_against_plain_patterns(spark):
    rng = random.Random(7)
    bits = ["a@b.c", "@", "d.e", "_x", " ", "1.2.3.4", ".5.6", "+1 (487) 555-7209", "+", "4111 1111 1111 1111", "-", "99",
            "é", "\U0001f600", "\n", "x.y", "300", "0" * 20, "(", ")", "a-b@c-d.e-f.g.", "%", "256.1.1.1", "001.002.003.004"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    found = spans(spark, texts)
    assert all(base_only(found[i]) == base_spans(t) for i, t in enumerate(texts))


@pytest.mark.parametrize(
    "text",
    ["a" * 20_000, "1." * 10_000, "1 " * 10_000, "a@b.c " * 20_000, "+1" + "(" * 100_000, "a." * 10_000 + "@x",
     "x@" + "a." * 60_000, "é 4111 1111 1111 1111 " * 3_000],
)
def test_very_long_texts(spark, text):
    assert base_only(spans(spark, [text])[0]) == base_spans(text)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("GB82 WEST 1234 5698 7654 32", [("iban", 0, 27)]),
        ("DE89370400440532013000.", [("iban", 0, 22)]),
        ("DE89370400440532013001", []),
        ("my ssn is 123-45-6789", [("ssn", 10, 21)]),
        ("part 123-45-6789", []),
        ("ssn 666-45-6789", []),
        ("card 378282246310005", [("short_card", 5, 20)]),
        ("number 378282246310005", []),
        ("card 378282246310006", []),
        ("call (212) 555-1234 now", [("local_phone", 5, 19)]),
        ("sum 212-555-1234", []),
    ],
)
def test_added_kinds(spark, text, want):
    assert [s for s in spans(spark, [text])[0] if s[0] not in PATTERNS] == want


def test_words_nearby_change_scores(spark):
    texts = ["release 1.2.3.4", "1.2.3.4", "login from 1.2.3.4"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    scores = [round(r.pii[0].score, 6) for r in pii.find(df).orderBy("i").collect()]
    assert scores == [0.6, 0.7, 0.9]


def test_odd_rows(spark):
    texts = [None, "", " ", "a@b.cd", "a@b.cd"]
    found = spans(spark, texts)
    assert [found[i] for i in range(5)] == [[], [], [], [("email", 0, 6)], [("email", 0, 6)]]
    other = spark.createDataFrame([("x", "a@b.cd", None)], "pii string, text string, kind string")
    row = pii.find(other).collect()[0]
    assert row.kind is None and row.pii[0].value == "a@b.cd"
    assert pii.find(other.limit(0)).count() == 0


def test_masked(spark):
    texts = ["mail a@b.cd or +1 (487) 555-7209, card 4111 1111 1111 1111.", None, "none", "+4111 1111 1111 1111"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = [r.text for r in pii.masked(df).orderBy("i").collect()]
    assert got == ["mail <email> or <phone>, card <card>.", None, "none", "+<card>"]


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_pii"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
