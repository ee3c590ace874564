from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid

TEXTS = {
    "en": "the thing that was there with their mother and father when they went home again",
    "fr": "les enfants étaient très contents de leur après-midi dans le jardin avec leurs parents",
    "de": "die kinder waren sehr glücklich über ihren nachmittag im garten und gingen dann nach hause",
}


@pytest.fixture(scope="module")
def table(make_docs):
    docs, no = [], 0
    for lang, text in TEXTS.items():
        words = text.split()
        for i in range(20):
            docs.append((no, " ".join(words[(i + j * (i % 5 + 1)) % len(words)] for j in range(12)), lang))
            no += 1
    return make_docs([*docs, (900, None, "en"), (901, "", "en"), (902, "123 --", "en"), (903, TEXTS["de"], None), (None, TEXTS["fr"], "fr"), (903, TEXTS["de"], None)])


def test_predictions_and_odd_texts(table):
    model = langid.train(table, "text", "lang", ~langid.held_out("doc_id"))
    rows = model.identify(table.withColumn("held", langid.held_out("doc_id")), "text", "p").select("doc_id", "lang", "held", "p.*").collect()
    assert len(rows) == 66
    by = {r.doc_id: r for r in rows}
    for no in (900, 901, 902):
        assert (by[no].lang_pred, by[no].score) == ("und", 0.0)
    assert by[903].lang_pred == "de" and by[None].lang_pred == "fr" and by[None].held
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 100]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in known if r.held]) >= 0.9


def test_held_out_is_crc32(table):
    import zlib

    for r in table.select("doc_id", langid.held_out("doc_id").alias("h")).where("doc_id is not null").collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_bundle_equals_plain_hyperdimensional_sum():
    """The counted bundle is the sum over all places of the bound, permuted letters."""
    text, d = "Thé cat, thé hat", 64
    grams, counts = langid.text_grams(text)
    clean = " thé cat thé hat "
    letter = lambda c: np.random.default_rng([3, ord(c)]).integers(0, 2, d, dtype=np.int8) * 2 - 1
    want = sum(np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c) for a, b, c in zip(clean, clean[1:], clean[2:], strict=False))
    assert counts.sum() == len(clean) - 2
    assert np.array_equal(langid._bundles([(grams, counts)], d, 3)[0], want)


def test_long_text_is_counted_whole_and_in_slices(monkeypatch):
    text = "ab cd, éf! " * 500
    want = langid.text_grams(text)
    monkeypatch.setattr(langid, "_SLICE", 7)
    got = langid.text_grams(text)
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def test_empty_table_and_nothing_to_learn_from(table):
    none = table.where(F.lit(False))
    model = langid.train(none, "text", "lang", F.lit(True))
    assert model.identify(none, "text", "p").count() == 0
    assert {r.lang_pred for r in model.identify(table, "text", "p").select("p.*").collect()} == {"und"}


def test_too_many_languages_is_an_error(table):
    with pytest.raises(ValueError, match="languages"):
        langid.train(table, "text", "lang", F.lit(True), max_languages=2)
