"""Language identification, toxicity and quality: held-out accuracy and odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovelift.llm.langid import LanguageModel, fit_languages, identify_languages, ngrams_of
from grovelift.llm.quality import (
    SAMPLE_BYTES,
    Compressors,
    classify_quality,
    fit_quality,
    isotonic,
    pieces_of,
    score_quality,
)
from grovelift.llm.toxicity import FEATURES, classify_toxicity, features_of, fit_toxicity, plain, tokens_of
from tests.llm.conftest import auc, fold_of

ODD = [(900, None), (901, ""), (902, "12 34 !?"), (903, "x" * 200_000), (904, "ü"), (None, "the and")]
TINY = [(1, None), (2, "a b"), (2, "a b"), (None, "c")]


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.01"
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def test_languages_held_out(larger):
    truth = larger("documents").select("doc_id", "lang")
    found = identify_languages(larger("documents")).join(truth, "doc_id").toPandas()
    assert (found.held_out == [fold_of(i, 3) == 1 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert held.score.between(0, 1).all() and len(found) == larger("documents").count()


def test_languages_of_held_out_rows_are_not_learnt(larger):
    wrong = larger("documents").withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "xx").otherwise(F.col("lang"))
    )
    one, other = (sorted(identify_languages(d).collect()) for d in (larger("documents"), wrong))
    assert one == other


def test_languages_of_odd_texts(larger, documents):
    rows = larger("documents").limit(300).unionByName(documents(ODD))
    found = {r.doc_id: r for r in identify_languages(rows).collect()}
    for i in (900, 901, 902):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[903].lang_pred != "" and found[904].lang_pred != "und"
    assert None in found


def test_languages_without_anything_to_learn(documents):
    found = identify_languages(documents(TINY)).collect()
    assert {r.lang_pred for r in found} == {"und"} and len(found) == 4
    assert identify_languages(documents([])).collect() == []


def test_words_first_then_shorter_ngrams(documents):
    rows = [(i, "house mouse", "en") for i in range(3)] + [(9, "maison souris", "fr")]
    model = fit_languages(documents(rows))
    assert model.langs == ["en", "fr"]
    assert model.predict("house")[0] == "en" and model.predict("souris")[0] == "fr"
    assert model.predict("houses")[0] == "en"  # unknown word, known 4-grams
    assert model.predict("zzzz") == ("und", 0.0)
    assert ngrams_of("ab", 3) == [" ab", "ab "]
    again = LanguageModel(*model.parts)
    assert again.predict("mouse souris ous") == model.predict("mouse souris ous")


def test_a_rare_language_keeps_its_share_of_the_model(documents):
    """One language with nearly all tokens, one in a script of its own, more words than fit."""
    rows = [(i, " ".join(f"{a}{b}{c}" for a in "abcdef" for b in "ghijkl" for c in "mnop") + " und", "de") for i in range(40)]
    rows += [(100, "мир дом лес", "ru")]
    model = fit_languages(documents(rows), model_words=20, model_ngrams=20)
    assert set("мирдолес") <= set(model.grams) and {"мир", "дом", "лес"} <= set(model.words)
    assert 10 < len(model.words) <= 20
    assert model.predict("мир")[0] == "ru" and model.predict("сел")[0] == "ru"
    assert model.predict("und")[0] == "de"


def test_ties_at_the_end_of_a_share_are_filled(documents):
    """Of words that all occur once as many are taken as fit."""
    rows = [(1, " ".join(a + b for a in "abcdefgh" for b in "ijklmnop"), "en")]
    model = fit_languages(documents(rows), model_words=10)
    assert sorted(model.words) == ["ai", "aj", "ak", "al", "am", "an", "ao", "ap", "bi", "bj"]


def test_toxicity_held_out(larger):
    found = classify_toxicity(larger("documents"), larger("labels"))
    found = found.join(larger("labels"), "doc_id").toPandas()
    assert (found.held_out == [fold_of(i, 5) == 0 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    assert auc(found.toxic, found.score) > 0.85
    held = found[found.held_out]
    assert (held.toxic == held.predicted).mean() > 0.9


def test_toxicity_without_labels(spark, documents):
    for labels, score in (([], 0.0), ([(2, 1, 1)], 1.0), ([(2, 1, 0)], 0.0)):
        frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        found = classify_toxicity(documents(TINY), frame).collect()
        assert [r.score for r in found] == [score] * 4
    assert classify_toxicity(documents([]), frame).collect() == []


def test_toxicity_of_odd_texts(larger, documents):
    rows = larger("documents").unionByName(documents(ODD + ODD[:1]))
    found = classify_toxicity(rows, larger("labels")).where("doc_id >= 900 OR doc_id IS NULL").collect()
    assert all(0 <= r.score <= 1 for r in found)
    assert len([r for r in found if r.doc_id == 900]) >= 2


def test_toxicity_keeps_the_true_shares_when_the_sample_is_capped(spark, documents):
    """Texts that cannot be told apart score with the share of toxic ones, also beyond the cap."""
    rows = documents([(i, "the same words in every text") for i in range(3000)])
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(3000)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(rows, labels, per_class=200)
    (score,) = {r.score for r in model.score(rows.limit(5), ["doc_id"]).collect()}
    assert 0.05 < score < 0.16


def test_features():
    words, stems = {"fool": 3.0}, {"dumm": 2.0}

    def of(text):
        return dict(zip(FEATURES, features_of(text, words, stems), strict=True))

    assert set(of(None).values()) == set(of("").values()) == {0.0}
    assert of("you are a fool")["near_second_person"] > 0
    assert of("fool " + "x " * 20 + "you")["near_second_person"] == 0
    assert of("Fool!")["word_hits"] > 0 and of("dummkopf")["stem_hits"] > 0
    assert of("f00l")["disguised_hits"] > 0 and of("f00d")["disguised_hits"] == 0
    assert of("ABC def")["capital_share"] == 0.5 and of("ABC def")["shouted_words"] == 0.5
    assert of("a!!!")["exclamation_share"] == 0.75 and of("a!!!")["repeated_marks"] == 0.5
    assert tokens_of("¡Hola, «tú»!") == ["hola", "tú"] and plain("abc") is None


def test_quality_held_out(larger):
    found = classify_quality(larger("documents"), larger("labels"))
    found = found.join(larger("labels"), "doc_id").toPandas()
    assert (found.held_out == [fold_of(i, 3) == 1 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    held = found[found.held_out]
    assert auc(held.quality, held.score) > 0.93
    assert (held.quality == held.predicted).mean() > 0.9


def test_quality_without_labels(spark, documents):
    for labels in ([], [(2, 1, 1)], [(2, 0, 1), (1, None, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        found = classify_quality(documents(TINY), frame).collect()
        assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)
    assert classify_quality(documents([]), frame).collect() == []


def test_quality_of_odd_texts(larger, documents):
    found = classify_quality(larger("documents").unionByName(documents(ODD)), larger("labels"))
    found = found.where("doc_id >= 900 OR doc_id IS NULL").collect()
    assert all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert scores[900] == scores[901]


def test_quality_keeps_the_true_shares_when_the_sample_is_capped(spark, documents):
    """Texts that cannot be told apart score with the share of good ones, also beyond the cap."""
    rows = documents([(i, "the same words in every text") for i in range(3000)])
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    model = fit_quality(rows, labels, per_class=90)
    (score,) = {r.score for r in score_quality(rows.limit(5), model).collect()}
    assert 0.8 < score < 0.96


def test_quality_is_calibrated_on_long_texts_too(spark, documents):
    long = "some words over and over " * (SAMPLE_BYTES // 20)
    rows = documents([(i, long) for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    _, _, points, chances = fit_quality(rows, labels)
    assert 0.6 < np.interp(0.0, points, chances) < 0.9


def test_pieces_hold_the_whole_text():
    text = "äöü" * 5000
    assert b"".join(pieces_of(text)).decode() == text
    assert pieces_of(None) == pieces_of("") == [b""]


def test_dictionaries_tell_texts_apart():
    rng = random.Random(0)
    words = {c: [c * 3 + str(i) for i in range(50)] for c in "ab"}
    texts = {c: " ".join(rng.choices(words[c], k=400)) for c in "ab"}
    sizes = Compressors(texts["a"].encode(), texts["b"].encode())
    assert sizes.difference(" ".join(words["a"])) > 0 > sizes.difference(" ".join(words["b"]))
    assert sizes.difference(None) == sizes.difference("")


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(0)
    x = rng.random(4000)
    y = (rng.random(4000) < x).astype(float)
    points, values = isotonic(x, y)
    assert (np.diff(points) > 0).all() and (np.diff(values) >= 0).all()
    assert abs(np.interp(0.3, points, values) - 0.3) < 0.08
