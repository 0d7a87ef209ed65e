"""Pipeline stages over odd rows: clashing names, NULLs, empty and long texts, repeated rows, empty tables."""

import pytest

import corpus_pipeline

NAMES = ("lang_pred", "lang_accepted", "_text", "n_removed", "_packed", "_key", "_gone", "class_id", "u", "root", "_column_2")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def rows():
    texts = {
        1: ("the quick brown fox jumps over the lazy dog and runs away from the old house", "en"),
        2: ("the river was cold and the men of the village waited for the first boat to come", "en"),
        3: ("der alte Mann ging mit seinem Hund durch den Wald und sprach mit sich selbst", "de"),
        4: ("die Kinder spielten auf der Wiese und die Sonne schien auf die roten Blumen", "de"),
        5: (None, "en"), 6: ("", None), 7: ("12 34 !!", None),
        8: ("the men of the village told many stories about the house by the river. " * 4000, "en"),
    }
    out = [(k, t, lang, "s", 1, *NAMES) for k, (t, lang) in texts.items()]
    return [*out, out[0], (None, texts[2][0] + " again and again", "en", "s", 1, *([None] * len(NAMES)))]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:3]])
def test_stages_keep_columns_of_any_name(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = stage(spark, docs, "")
    assert got.schema.names == docs.schema.names
    found = got.collect()
    assert found and all(tuple(r)[5:] in (NAMES, (None,) * len(NAMES)) for r in found)
    if name == "language_id":
        assert {r.doc_id for r in found} >= {1, 2, 3, 4, 8} and not {5, 6, 7} & {r.doc_id for r in found}
    assert stage(spark, docs.limit(0), "").count() == 0


def test_packing_takes_any_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    pieces = corpus_pipeline.packed_sequences(spark, docs, "").collect()
    assert len({(r.doc_id, r.piece) for r in pieces if r.doc_id == 8}) > 10
    assert sum(r.doc_id == 5 and r.length == 1 for r in pieces) == 1
