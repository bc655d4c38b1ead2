import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestat.llm.language_id import UNKNOWN, fit, grams_of, held_out, predict_languages, words_in


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(docs):
    model = fit(docs.where(~held_out()))
    rows = predict_languages(docs, model).where(held_out() & F.col("lang").isNotNull()).select("lang", "language.*").toDF("truth", "lang", "score").collect()
    assert len(rows) > 100
    assert sum(r.truth == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_are_those_of_the_remainder(docs):
    rows = docs.select("doc_id", held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_model_agrees_with_counting(spark, small_docs):
    model = fit(small_docs, sample_docs=10_000, least_count=1, most_items=10_000_000)
    words = Counter((r.lang, w) for r in small_docs.collect() for w in words_in(r.text))
    grams = Counter()
    for (lang, w), n in words.items():
        for g in grams_of(w, 3):
            grams[lang, g] += n
    for table, index in ((words, model.words), (grams, model.grams[2])):
        items = {i for _, i in table}
        assert index.keys() == items
        for at, lang in enumerate(model.langs):
            total = sum(table[lang, i] or 0.5 for i in items) + 0.5 * sum(table[lang, i] > 0 for i in items)
            for item in list(items)[:50]:
                assert math.isclose(model.table[index[item], at], math.log((table[lang, item] + 0.5) / total), rel_tol=1e-4)


def test_unseen_words_fall_back_to_shorter_grams(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("straße größe", "de"), ("night light", "en")] * 5)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert model.predict("Straßen", {})[0] == "de" and model.predict("xßx", {})[0] == "de" and model.predict("nights", {})[0] == "en"
    lang, score = model.predict("日本", {})
    assert lang in ("de", "en") and math.isclose(score, 0.5)


def test_numbers_of_any_kind_are_no_letters():
    assert words_in("½ ² ① Ⅳ 12 _ ٣") == [] and words_in("m² Éa") == ["m²", "éa"]


def test_odd_and_empty_tables(odd_docs, no_docs):
    model = fit(odd_docs)
    got = predict_languages(odd_docs, model, into="found")
    assert got.count() == 17 and got.columns == [*odd_docs.columns, "found"]
    for r in got.collect():
        assert (r.found.lang == UNKNOWN and r.found.score == 0) == (not words_in(r.text))
    nothing = fit(no_docs)
    assert {r.found.lang for r in predict_languages(odd_docs, nothing, into="found").collect()} == {UNKNOWN}
    assert predict_languages(no_docs, model).isEmpty()
