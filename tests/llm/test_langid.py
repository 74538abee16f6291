import random

import numpy as np
import pytest

from leaguespark.llm import langid


def corpus(seed, n):
    rnd = random.Random(seed)
    stems = {"aa": ["ban", "lo", "mir", "ta"], "bb": ["xin", "qua", "zer", "ött"]}
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(rnd.choice(stems[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(12)), lang))
    return rows


@pytest.fixture
def models(spark):
    return langid.fit(spark.createDataFrame(corpus(1, 200), "doc_id long, text string, lang string"))


def test_probabilities_are_a_distribution(models):
    for model in models.models:
        for context in (0, 0x0203, 0x01020304 >> 8, int(models.grams[5]) >> 8):
            grams = (np.uint32(context & 0xFFFFFF) << np.uint32(8)) | np.arange(256, dtype=np.uint32)
            assert abs(model.prob(grams).sum() - 1) < 1e-9


def test_held_out_accuracy_and_rejection(spark, models):
    rows = [*corpus(2, 100), (900, None, None), (901, "", "aa"), (902, "12 !! 34", None), (903, "wwwk ggpf hjjdd ccvv kkwwg pphh", None), (904, "BAN LO", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs, models).collect()}
    assert all(got[i]["__lang"] == lang for i, _, lang in rows[:100])
    assert not any(got[i]["__rejected"] for i in range(100))
    for i in (900, 901, 902):
        assert got[i]["__lang"] == "und" and got[i]["__rejected"] and got[i]["__score"] == 0
    assert got[903]["__rejected"] and got[903]["__lang"] in ("aa", "bb")
    assert got[904]["__lang"] == "aa"
    kept = langid.keep_identified(docs, spark.createDataFrame(corpus(1, 200), "doc_id long, text string, lang string"))
    assert kept.columns == docs.columns and 903 not in {r.doc_id for r in kept.collect()}


def test_counts_cover_everything_and_lower_orders_fit(spark):
    rows = corpus(3, 50)
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = {}
    for _, text, lang in rows:
        for g in langid.symbols().ngrams(text, 3).tolist():
            want[lang, g] = want.get((lang, g), 0) + 1
    assert {(r.lang, r.gram): r.n for r in langid.count_ngrams(labelled, 3).collect()} == want
    assert langid.fit(labelled, 3).order == 3


def test_no_labels(spark):
    empty = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    models = langid.fit(empty)
    assert [(r["__lang"], r["__rejected"]) for r in langid.identify(empty, models).collect()] == [("und", True)]
    assert langid.identify(empty.limit(0), models).count() == 0


def test_order_and_predictions_do_not_depend_on_the_number_of_ngrams(spark, models, monkeypatch):
    labelled = spark.createDataFrame(corpus(1, 200), "doc_id long, text string, lang string")
    docs = spark.createDataFrame([*corpus(2, 60), (900, None, None), (901, "12", None), (903, "wwwk ggpf hjjdd ccvv kkwwg pphh", None)], "doc_id long, text string, lang string")
    want = {r.doc_id: r for r in langid.identify(docs, models).collect()}
    monkeypatch.setattr(langid, "MAX_NGRAMS", 60, raising=False)  # an earlier form lowered the order beyond so many
    for cells in (1500, 150):  # a language to each part, and several parts of a language
        monkeypatch.setattr(langid, "PART_CELLS", cells, raising=False)
        small = langid.fit(labelled)
        assert small.order == langid.ORDER
        got = {r.doc_id: r for r in langid.identify(docs, small).collect()}
        assert got.keys() == want.keys()
        for i, r in want.items():
            assert (got[i]["__lang"], got[i]["__rejected"]) == (r["__lang"], r["__rejected"])
            assert got[i]["__score"] == pytest.approx(r["__score"], rel=1e-6)
            assert got[i]["__entropy"] == pytest.approx(r["__entropy"], rel=1e-6, nan_ok=True)
        assert np.allclose(small.moments, models.moments, rtol=1e-9)
    assert len(small.parts) > len(small.langs)
