"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased and reduced to letters with one space between words. The models are fitted on
a bounded sample of labelled documents and stored in sorted hash arrays; a text gets the language
with the lowest cross-entropy per character, a calibrated score, and is rejected where even the best
model finds it stranger than its calibration allows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import slices, string_bytes, text_column
from racecast.llm.words import ODD, HashArray, mix

ORDER = 5
PAD = "\x00" * ORDER
# Share of a unigram's left-over probability that any one unseen character gets.
UNSEEN = 1 / 4096
UNKNOWN = "und"
SLICE_CHARS = 1_000_000

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether a code point is a letter of any script."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return _letters


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, which of them belong to a text, and where each text starts.

    A text is preceded by padding, then holds its letters with one space after each word that
    something follows.
    """
    texts = [t.replace("\x00", " ") if "\x00" in t else t for t in texts]
    raw = np.frombuffer((PAD + PAD.join(texts)).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[raw]
    pad = raw == 0
    after = np.zeros_like(letter)
    after[1:] = letter[:-1] & ~letter[1:] & ~pad[1:]
    kept = letter | pad | after
    letter, pad = letter[kept], pad[kept]
    points = np.where(letter, raw[kept], np.uint32(32)).astype(np.uint64)
    return points, ~pad, np.flatnonzero(pad)[::ORDER]


def gram_keys(points: np.ndarray, length: int, back: int = 0) -> np.ndarray:
    """At each place, the hash of the ``length`` code points up to ``back`` places before it."""
    sums = np.zeros(len(points), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(back, back + length):
            sums[j:] += points[: len(points) - j] * power
            power *= ODD
    return mix(sums + np.uint64(length))


@dataclass
class Model:
    """``grams[k]``: log probability of each known k-gram in every language; ``contexts[k]``: log weight
    that a known context of k-1 characters leaves to the shorter gram."""

    languages: list[str]
    grams: dict[int, HashArray]
    contexts: dict[int, HashArray]
    sharpness: float = 1.0
    limit: float = float("inf")

    def log_probabilities(self, points: np.ndarray, at: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log of each language's probability of the characters at places ``at``."""
        out = np.zeros((len(at), len(self.languages)), np.float32)
        left = np.arange(len(at))
        for k in range(order, 0, -1):
            keys = gram_keys(points, k)[at[left]]
            rows = self.grams[k].find(keys)
            hit = rows >= 0
            out[left[hit]] += self.grams[k].values[rows[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if k > 1:
                rows = self.contexts[k].find(gram_keys(points, k - 1, 1)[at[left]])
                known = rows >= 0
                out[left[known]] += self.contexts[k].values[rows[known]]
            else:
                out[left] += self.contexts[1].values[0]
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the mean of -log p; and how many characters each text has."""
        entropy = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        first = 0
        while first < len(texts):
            last, chars = first + 1, len(texts[first])
            while last < len(texts) and chars + len(texts[last]) <= SLICE_CHARS:
                chars += len(texts[last])
                last += 1
            points, scored, starts = normalised(texts[first:last])
            logs = np.zeros((len(points), len(self.languages)), np.float32)
            logs[scored] = self.log_probabilities(points, np.flatnonzero(scored))
            n = np.add.reduceat(scored.astype(np.int64), starts)
            sums = np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
            entropy[first:last] = -sums / np.maximum(n, 1)[:, None]
            sizes[first:last] = n
            first = last
        return entropy, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1, and whether the text is accepted.

        The language is ``und`` with score 0 where a text has no letter or there is no model; ties
        go to the language that sorts first.
        """
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, sizes = self.cross_entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - lowest[:, None])).sum(axis=1)
        some = sizes > 0
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)]
        return names, np.where(some, score, 0.0), some & (lowest <= self.limit)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each language's texts of a batch hold each run of ORDER characters."""
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        texts = text_column(batch, "text")
        for language in sorted(set(languages)):
            own = [t for t, x in zip(texts, languages) if x == language]
            points, scored, _ = normalised(own)
            at = np.flatnonzero(scored)
            if not len(at):
                continue
            keys, first, n = np.unique(gram_keys(points, ORDER)[at], return_index=True, return_counts=True)
            window = at[first][:, None] - np.arange(ORDER)[::-1]
            grams = points[window].astype("<u4")
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([language] * len(keys)),
                    "gram": pa.array([g.tobytes().decode("utf-32-le", "surrogatepass") for g in grams]),
                    "n": pa.array(n.astype(np.int64)),
                }
            )


def _distinct(keys: np.ndarray, language: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal (language, key) summed: first place, sums and number of rows."""
    order = np.lexsort((keys, language))
    k, g = keys[order], language[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (g[1:] != g[:-1])]
    starts = np.flatnonzero(new)
    return order[starts], np.add.reduceat(weight[order], starts), np.diff(np.append(starts, len(k)))


def build(counts: pa.Table) -> Model:
    """Kneser-Ney models from the counts (lang, gram, n) of runs of ORDER characters."""
    names = counts.column("lang").combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    if not languages:
        return Model([], {}, {})
    place = np.array([languages.index(x) for x in names.dictionary.to_pylist()])
    language = place[names.indices.to_numpy()]
    text = b"".join(c.cast(pa.large_string()).buffers()[2] for c in [counts.column("gram").combine_chunks()])
    grams = np.frombuffer(text.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    grams = grams.reshape(-1, ORDER).astype(np.uint64)
    weight = counts.column("n").to_numpy().astype(np.float64)

    levels = {}
    for k in range(ORDER, 0, -1):
        keys = _row_keys(grams[:, ORDER - k :])
        first, sums, _ = _distinct(keys, language, weight)
        grams, language, keys, sums = grams[first], language[first], keys[first], sums
        levels[k] = (grams, language, keys, sums)
        # Shorter grams are weighted by how many different characters precede them.
        weight = np.ones(len(first))

    model = Model(languages, {}, {})
    wide = len(languages)
    for k in range(1, ORDER + 1):
        grams, language, keys, sums = levels[k]
        once, twice = (sums == 1).sum(), (sums == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context = _row_keys(grams[:, ORDER - k : ORDER - 1])
        first, totals, types = _distinct(context, language, sums)
        context_keys, context_row = np.unique(context[first], return_inverse=True)
        left = np.zeros((len(context_keys), wide))
        total = np.ones((len(context_keys), wide))
        left[context_row, language[first]] = np.log(discount * types / totals)
        total[context_row, language[first]] = totals
        if k == 1:
            left = left + np.log(UNSEEN)
        model.contexts[k] = HashArray(context_keys, left.astype(np.float32))
        gram_keys_, at, row = np.unique(keys, return_index=True, return_inverse=True)
        share = np.zeros((len(gram_keys_), wide))
        of_context = np.searchsorted(context_keys, context)
        share[row, language] = np.maximum(sums - discount, 0) / total[of_context, language]
        weights = np.exp(left[of_context[at]])
        if k == 1:
            values = share + weights
        else:
            sample = grams[at][:, ORDER - k + 1 :]
            shorter = model.grams[k - 1]
            values = share + weights * np.exp(shorter.values[shorter.find(_row_keys(sample))])
        model.grams[k] = HashArray(gram_keys_, np.log(values).astype(np.float32))
    return model


def _row_keys(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of code points, the same as ``gram_keys`` gives for such a run."""
    sums = np.zeros(len(rows), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(rows.shape[1] - 1, -1, -1):
            sums += rows[:, j] * power
            power *= ODD
    return mix(sums + np.uint64(rows.shape[1]))


def calibrate(model: Model, texts: list[str], languages: list[str], slack: float) -> Model:
    """Choose how sharply cross-entropies become scores, and the cross-entropy beyond which to reject.

    The limit lies ``slack`` times the spread above the strangest calibration text.
    """
    known = [(t, model.languages.index(x)) for t, x in zip(texts, languages) if x in model.languages]
    if not known:
        return model
    entropy, sizes = model.cross_entropies([t for t, _ in known])
    truth = np.array([x for _, x in known])[sizes > 0]
    entropy = entropy[sizes > 0]
    if not len(truth):
        return model
    own = entropy[np.arange(len(truth)), truth]

    def loss(sharpness: float) -> float:
        z = -sharpness * (entropy - entropy.min(axis=1, keepdims=True))
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))

    model.sharpness = min((2.0**k for k in range(-2, 9)), key=loss)
    model.limit = float(own.max() + slack * max(own.max() - own.min(), 0.5))
    return model


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = 800,
    calibration: int = 100, slack: float = 1.0,
) -> Model:
    """Models from at most about ``sample`` documents of each language, chosen by hash of their key.

    ``calibration`` more of each set the score and the limit. Rows whose text or language is NULL take
    no part. What reaches the driver is bounded by the sample and the number of languages.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("_h"))
    rows = rows.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {}, {})
    place = F.pmod(F.col("_h"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    share = F.create_map(*[F.lit(x) for lng, n in sizes.items() for x in (lng, min(1.0, sample / n))])
    more = F.create_map(*[F.lit(x) for lng, n in sizes.items() for x in (lng, min(1.0, (sample + calibration) / n))])
    chosen = rows.withColumn("_at", place)
    train = chosen.filter(F.col("_at") < share[F.col("lang")]).select("lang", "text")
    held = chosen.filter((F.col("_at") < more[F.col("lang")]) & (F.col("_at") >= share[F.col("lang")]))
    grams = train.mapInArrow(_counts, "lang string, gram string, n long")
    # As Arrow: the driver holds columns, not an object for each row.
    model = build(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    check = held.select("lang", "text").collect() or train.limit(calibration).collect()
    return calibrate(model, [r["text"] for r in check], [r["lang"] for r in check], slack)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred``, ``lang_score`` and ``lang_accepted``.

    Whole texts are read. NULL, empty and letterless texts give ``und``, 0 and False; repeated rows
    are predicted alike; an empty table gives an empty one. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, accepted = shared.value.predict(text_column(batch, "_text"))
            columns = {c: batch.column(c) for c in names}
            columns |= {"lang_pred": pa.array(lang, pa.string()), "lang_score": pa.array(score, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns | {"lang_accepted": pa.array(accepted, pa.bool_())})

    chosen = docs.select(*(F.col(c) for c in names), F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text")
    return chosen.mapInArrow(run, f"{schema}, lang_pred string, lang_score double, lang_accepted boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model accepts, with their columns as they are.

    Rows pass through Python once, in parts of some megabytes of text, and only those accepted come back. NULL, empty
    and letterless texts are not accepted. No column is added, so any names may occur; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = string_bytes(batch.column(at))
            for first, last in slices(offsets):
                part = batch.slice(first, last - first)
                _, _, fits = shared.value.predict([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(fits, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the crc32 of the key, written in digits, leaves ``part`` divided by ``parts``."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


