"""The training-data pipeline over ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racecast.llm import jaccard, language_id, line_dedup, packing
from racecast.llm.common import Scratch, ship_code, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns but key and text named by their places, so that no stage's own columns clash with them."""
    return docs.toDF(*(n if n in ("doc_id", "text") else f"_column_{i}" for i, n in enumerate(docs.columns)))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models, fitted on the labelled documents at hand, accept.

    A document without a letter, or with a NULL or empty text, is not accepted and goes. Repeated rows stay or go alike;
    an empty table stays empty; without labelled documents nothing is accepted. Further columns pass through.
    """
    ship_code(spark)
    return language_id.accepted(docs, language_id.fit(docs.select("doc_id", "text", "lang")))


_open: list[Scratch] = []


def _scratch(spark: SparkSession) -> Scratch:
    """Intermediate tables of one stage.

    A stage's result has been written before the next one begins, so what the stage before left in the
    shared folder goes then.
    """
    while _open:
        with suppress(Exception):  # a session that has ended
            _open.pop().close()
    _open.append(Scratch(spark))
    return _open[-1]


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, or nearly repeat, a line of an earlier document or place.

    A document that loses all lines it had goes. A NULL text stays NULL; rows with a NULL key stay as they are; an empty
    table stays empty; further columns, of any name, pass through.
    """
    ship_code(spark)
    named = apart(docs)
    found = line_dedup.deduplicated(named, _scratch(spark))
    kept = found.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return kept.select(*named.columns).toDF(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each connected group with five-word Jaccard similarity of 0.8 or more.

    Of rows that repeat a key one stays; rows with a NULL key stay; an empty table stays empty; further columns, of any
    name, pass through.
    """
    ship_code(spark)
    return jaccard.one_of_each(apart(docs), _scratch(spark)).toDF(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence of 2048 tokens and its place there.

    A NULL or empty text is a piece of the end token alone; repeated rows are packed each; an empty table gives no
    pieces. Further columns do not pass through.
    """
    ship_code(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), _scratch(spark))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard", one_of_near_duplicates),
    ("best_fit_packing", packed_sequences),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
