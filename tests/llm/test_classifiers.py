import random

import numpy as np

from leaguespark.llm import quality, toxicity


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


def toxic_rows(prose, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i, text in enumerate(prose(n, 40, seed=seed, vocabulary=[f"w{k}" for k in range(300)])):
        toxic = int(i % 4 == 0)
        words = text.split()
        if toxic:
            for _ in range(3):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["scumlord", "scumbag", "scummy"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_learns_and_scores_everything(spark, prose):
    model = toxicity.fit(spark.createDataFrame(toxic_rows(prose, 400, 1), "doc_id long, text string, label int"))
    rows = [*toxic_rows(prose, 200, 2), (900, None, None), (901, "", 1), (902, "w1 " * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = {r.doc_id: r["__score"] for r in toxicity.score(docs, model).collect()}
    labels = np.array([r[2] for r in rows[:200]])
    scores = np.array([got[i] for i in range(200)])
    assert auc(scores, labels) > 0.99 and ((scores >= 0.5) == labels).mean() > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 203
    again = toxicity.fit(spark.createDataFrame(toxic_rows(prose, 400, 1), "doc_id long, text string, label int").repartition(3))
    assert abs(again.score(rows[0][1]) - got[0]) < 1e-6


def test_pairs_have_weights_of_their_own():
    """Only the pair of two terms is toxic; a linear model can't tell, the factors can."""
    model = toxicity.FactorizationMachine()
    a, b, c = (np.array([i]) for i in (1, 2, 3))
    rows = [(np.array([1, 2]), 1), (np.array([3, 4]), 1), (np.array([1, 4]), 0), (np.array([2, 3]), 0)]
    rng = np.random.default_rng(0)
    for _ in range(1500):
        rng.shuffle(order := list(range(4)))
        model.train([rows[i] for i in order])
    logits = [model.logit(terms)[0] for terms, _ in rows]
    assert min(logits[:2]) > max(logits[2:])


def test_toxicity_without_both_classes(spark):
    rows = lambda labels: spark.createDataFrame([(t, x) for t, x in zip(("a", "b"), labels, strict=True)], "text string, label int")
    assert toxicity.fit(rows([0, 0])).score("x") < 1e-9
    assert toxicity.fit(rows([1, 1])).score("x") > 1 - 1e-9
    assert toxicity.fit(rows([None, None])).score("x") < 1e-9


def quality_rows(prose, n, seed):
    return [(i, t if i % 3 else " ".join(w for w in t.split()[:6] for _ in range(7)), int(i % 3 > 0)) for i, t in enumerate(prose(n, 50, seed=seed))]


def test_quality(spark, prose):
    train = spark.createDataFrame(quality_rows(prose, 300, 1), "doc_id long, text string, label int")
    measured = quality.with_statistics(train)
    model = quality.fit(measured)
    rows = [*quality_rows(prose, 150, 2), (900, None, None), (901, "", None), (902, "x" * 300_000, None)]
    test = quality.with_statistics(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    scored = quality.score(test, model)
    got = {r.doc_id: r["__score"] for r in scored.collect()}
    labels = np.array([r[2] for r in rows[:150]])
    assert scored.columns == ["doc_id", "label", "__score"]
    assert auc(np.array([got[i] for i in range(150)]), labels) > 0.99 and all(0 <= s <= 1 for s in got.values()) and len(got) == 153
    # The moments are those of numpy.
    x = np.array([quality.statistics_of(r[1]) for r in quality_rows(prose, 300, 1) if r[2] == 0])
    assert np.allclose(model.means[0] * model.scale + model.center, x.mean(0))


def test_quality_without_both_classes(spark):
    one = quality.with_statistics(spark.createDataFrame([(1, "a b", 1)], "doc_id long, text string, label int"))
    assert [r["__score"] for r in quality.score(one, quality.fit(one)).collect()] == [1.0]
    none = one.filter("label = 0")
    assert [r["__score"] for r in quality.score(one, quality.fit(none)).collect()] == [0.0]
