"""Personal data in texts, with built-in functions only: patterns propose spans, validators confirm them,
nearby words adjust their score.

``find`` adds a column ``pii``: an array of (kind, start, end, score, value), by kind in the order of the
kinds given, then by start. Positions count code points, the end is exclusive. A kind's matches are the leftmost,
non-overlapping ones of its pattern; a match that its validator refuses is dropped and its characters are not
tried again. Spans of different kinds may overlap.

The score of a confirmed match is its kind's prior plus a gain if one of the kind's context words stands
within ``WINDOW`` characters before or after it (not beyond the neighbouring match of the same kind), minus a loss for
a word that speaks against it. Spans below ``THRESHOLD`` go. The priors of the first four kinds are so high that
nothing lowers them below it; the others are reported only with a checksum or a context word.

Where a match stands follows from the lengths of the pieces between the matches. Only these lengths are added
up, in two levels (sums of ``CHUNK`` lengths, then single ones), so a text of very many matches costs little more
than its scan. The patterns are possessive where that changes no match: each character run is tried once, and
no repetition recurses, so long runs of digits, dots or word characters cost linear time.

Odd rows: a NULL text has no spans (an empty array), as an empty one; repeated rows and equal texts are
treated row by row; an empty table gives an empty table; all columns of the input are kept, except that a
column named ``pii`` is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 40
THRESHOLD = 0.5
CHUNK = 256

# Validators: SQL conditions on a match ``v``. Built as SQL text, since the same tree made of many small
# Column calls takes the driver seconds.
DIGITS = "regexp_replace(v, '[^0-9]', '')"
ANY = "true"
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]?)"
OCTETS = rf"v RLIKE r'^{OCTET}(?:\.{OCTET}){{3}}$'"
# Area, group and serial numbers that can have been issued.
SOCIAL = "NOT v RLIKE '^(?:000|666|9)|-00-|-0000$'"
# ISO 7064: the first four characters moved to the end, letters as 10 to 35, the rest by 97 is 1.
COMPACT = "replace(v, ' ', '')"
MOD_97 = f"""char_length({COMPACT}) BETWEEN 15 AND 34 AND 1 = aggregate(
    filter(split(substring({COMPACT}, 5) || substring({COMPACT}, 1, 4), ''), c -> c <> ''), 0,
    (rest, c) -> if(ascii(c) < 65, rest * 10 + ascii(c) - 48, rest * 100 + ascii(c) - 55) % 97)"""


def luhn(least: int, most: int) -> str:
    """So many digits, of which the last is the Luhn check digit of the others."""
    return f"char_length({DIGITS}) BETWEEN {least} AND {most} AND luhn_check({DIGITS})"


def n_digits(least: int, most: int) -> str:
    return f"char_length({DIGITS}) BETWEEN {least} AND {most}"


@dataclass(frozen=True)
class Kind:
    """A pattern with its validator; ``hint`` is a quick test that every text with a match passes.

    ``confirmed`` is a SQL condition on the match ``v``. Patterns hold no single quotes.
    """

    name: str
    pattern: str
    hint: str
    confirmed: str
    prior: float
    near: str = ""
    against: str = ""
    gain: float = 0.4
    loss: float = 0.1


CARD_WORDS = r"(?i)\b(?:card|visa|mastercard|credit|debit|karte|carte|tarjeta)\b"
PHONE_WORDS = r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|telefon|téléphone|teléfono)\b"
LOCAL = "A-Za-z0-9._%+-"

BASE = (
    # A local part begins after the last match or after another character; it is tried once.
    Kind("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", ANY, 0.9),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", OCTETS, 0.7,
        r"(?i)\b(?:ip|address|host|server|login)\b", r"(?i)\b(?:version|release|section|chapter)\b", 0.2,
    ),
    Kind(
        "card", "[0-9](?:[ -]?+[0-9])++", "[0-9](?:[ -]?+[0-9]){15}", luhn(16, 19), 0.7, CARD_WORDS,
        r"(?i)\b(?:order|invoice|tracking|isbn)\b", 0.2,
    ),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", n_digits(8, 15), 0.6,
        PHONE_WORDS,
    ),
)
ADDED = (
    Kind(
        "iban", "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9]{4}){2,7}(?: ?+[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}", MOD_97, 0.8, r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b", gain=0.2,
    ),
    Kind(
        "ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", SOCIAL, 0.3,
        r"(?i)\b(?:ssn|social security)\b",
    ),
    Kind(
        "short_card", "[0-9](?:[ -]?+[0-9])++", "[0-9](?:[ -]?+[0-9]){12}", luhn(13, 15), 0.3, CARD_WORDS,
    ),
    Kind(
        "local_phone", r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", "[0-9]{3}[ .-][0-9]{4}",
        ANY, 0.2, PHONE_WORDS,
    ),
)
KINDS = (*BASE, *ADDED)
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>"


def score(kind: Kind) -> str:
    """SQL of a span's score, from what stands ``before`` and ``after`` it."""
    total = str(kind.prior)
    for words, weight in ((kind.near, kind.gain), (kind.against, -kind.loss)):
        if words:
            total += f" + if(y.before RLIKE r'{words}' OR y.after RLIKE r'{words}', {weight}D, 0D)"
    return f"greatest(0D, least(1D, {total}))"


def spans_of(text: str, kind: Kind, threshold: float) -> Column:
    """The spans of one kind; NULL where the text cannot have any.

    Each ``transform(array(..), name -> ..)`` gives a name to a value, which is so computed once.
    """
    text, pattern, total = "`" + text.replace("`", "``") + "`", f"r'{kind.pattern}'", "0L, (a, b) -> a + b"
    matches = f"struct(split({text}, {pattern}, -1) AS pieces, regexp_extract_all({text}, {pattern}, 0) AS found)"
    sizes = "transform(m.pieces, (p, i) -> bigint(char_length(p) + coalesce(char_length(get(m.found, i - 1)), 0)))"
    good = f"filter(transform(m.found, (v, i) -> if({kind.confirmed}, struct(i, v), NULL)), x -> x IS NOT NULL)"
    # Not by slice(), which copies its whole array.
    part = "aggregate(transform(sequence({}, {}), j -> get({}, j)), {})"
    sums = f"""transform(sequence(0, int(floor((size(s.sizes) - 1) / {CHUNK}))), c -> {part.format(
        f"c * {CHUNK}", f"least(c * {CHUNK} + {CHUNK}, size(s.sizes)) - 1", "s.sizes", total)})"""
    chunk = f"int(floor(x.i / {CHUNK}))"
    start = f"""if({chunk} > 0, {part.format(0, f"{chunk} - 1", "u", total)}, 0L)
        + {part.format(f"{chunk} * {CHUNK}", "x.i", "s.sizes", total)}"""
    placed = f"""transform(s.good, x -> struct({start} AS start, x.v AS v,
        right(get(m.pieces, x.i), {WINDOW}) AS before, left(get(m.pieces, x.i + 1), {WINDOW}) AS after))"""
    scored = f"""transform({placed}, y -> struct('{kind.name}' AS kind, y.start AS start,
        y.start + char_length(y.v) AS end, double({score(kind)}) AS score, y.v AS value))"""
    found = f"""get(transform(array({matches}), m ->
        get(transform(array(struct({sizes} AS sizes, {good} AS good)), s ->
        get(transform(array({sums}), u -> filter({scored}, z -> z.score >= {threshold})), 0)), 0)), 0)"""
    return F.expr(f"if({text} RLIKE r'{kind.hint}', {found}, NULL)")


def find(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the column ``pii``; see the module for what it holds and for odd rows."""
    none = F.array().cast(SPANS)
    found = [F.coalesce(spans_of(text, kind, threshold), none) for kind in kinds]
    return docs.withColumn("pii", F.concat(none, *found))


def listed(spans: str, names: Sequence[str] | None = None) -> Column:
    """Spans (of the named kinds) as ``kind:start:end``, joined by commas; empty without spans."""
    return F.expr(f"array_join(transform({of_kinds(spans, names)}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def of_kinds(spans: str, names: Sequence[str] | None) -> str:
    """SQL of the spans of the named kinds."""
    return f"filter({spans}, s -> s.kind IN ({', '.join(repr(n) for n in names)}))" if names else spans


def masked(docs: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets; NULL stays NULL.

    Of overlapping spans the first stands for all that overlap it in a chain. ``pii`` holds the spans found in the
    text as it was. Made of runs of kept text, so a span costs the text length once: meant for texts with few spans.
    """
    found = find(docs, text, kinds, threshold)
    by_start = F.array_sort(
        F.transform(F.col("pii"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    begun = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def cut(state: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = F.struct(F.concat(state["out"], gap, F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))
        inside = F.struct(state["out"].alias("out"), F.greatest(state["at"], s["end"]).alias("at"))
        return F.when(s["start"] < state["at"], inside).otherwise(fresh)

    def end(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col(text), (state["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return found.withColumn(text, F.when(F.size("pii") > 0, F.aggregate(by_start, begun, cut, end)).otherwise(F.col(text)))
