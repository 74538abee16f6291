"""Registered queries without SQL, against plain twins over whole small tables."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaguespark.llm import langid, quality, toxicity, url_lists
from leaguespark.llm.queries import QUERIES


def tables(spark, path, texts, langs=None, sources=None, labels=()):
    rows = [(i, t, langs[i] if langs else None, sources[i] if sources else None, 1.0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, __score double").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def crc(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


def plain_kneser_ney(training):
    """lang -> function of a 4-gram, by dictionaries."""
    out = {}
    for lang in sorted({x for _, x in training}):
        counts = {4: {}}
        for text, own in training:
            if own == lang:
                for g in langid.symbols().ngrams(text, 4).tolist():
                    counts[4][g] = counts[4].get(g, 0) + 1
        for k in (3, 2, 1):  # in how many longer ones a shorter one stands
            counts[k] = {}
            for g in counts[k + 1]:
                low = g & ((1 << 8 * k) - 1)
                counts[k][low] = counts[k].get(low, 0) + 1

        def prob(gram, k, counts=counts):
            if k == 0:
                return 1 / 256
            own = counts[k]
            ones, twos = (sum(n == m for n in own.values()) for m in (1, 2))
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            g = gram & ((1 << 8 * k) - 1)
            same = [n for x, n in own.items() if x >> 8 == g >> 8]
            lower = prob(gram, k - 1, counts)
            if not same:
                return lower
            return max(own.get(g, 0) - discount, 0) / sum(same) + discount * len(same) / sum(same) * lower

        out[lang] = prob
    return out


def test_op3_equals_plain_models(spark, tmp_path):
    rnd = random.Random(3)
    stems = {"aa": ["ban", "lo", "mi"], "bb": ["xin", "qua", "ött"]}
    langs = [("aa", "bb")[i % 2] for i in range(24)]
    texts = [" ".join(rnd.choice(stems[x]) + rnd.choice(stems[x]) for _ in range(4)) for x in langs]
    texts += [None, "12 34", "lo", texts[0], "ban xin " * 3]
    langs += ["aa", None, None, langs[0], None]
    found = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, tables(spark, tmp_path, texts, langs)).collect()}
    models = plain_kneser_ney([(t, x) for i, (t, x) in enumerate(zip(texts, langs, strict=True)) if crc(i, 4) != 2 and t and x])
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].held_out == (crc(i, 4) == 2)
        grams = langid.symbols().ngrams(text or "", 4).tolist()
        if not grams:
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        entropy = {x: -sum(math.log(p(g, 4)) for g in grams) / len(grams) for x, p in models.items()}
        best = min(entropy, key=lambda x: (entropy[x], x))
        assert found[i].lang_pred == best
        assert found[i].cross_entropy == pytest.approx(entropy[best], rel=1e-4)
        assert found[i].score == pytest.approx(1 / sum(math.exp((entropy[best] - e) * min(len(grams), langid.SCORE_SYMBOLS)) for e in entropy.values()), rel=1e-2)


def test_op5_equals_the_machine_trained_in_one_process(spark, tmp_path, prose):
    rnd = random.Random(6)
    texts = [t + (" scumlord scumbag" if i % 3 == 0 else "") for i, t in enumerate(prose(120, 20, seed=4, vocabulary=[f"w{k}" for k in range(60)]))]
    texts += [texts[0]] * 200 + [None, ""]  # one text with most of the labelled rows
    labels = [(i, rnd.randint(0, 1), int(bool(t) and "scum" in t)) for i, t in enumerate(texts)]
    path = tables(spark, tmp_path, texts, labels=labels)
    found = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, path).collect()}
    assert len(found) == len(texts)
    docs = toxicity.with_keys(spark.read.parquet(f"{path}/documents.parquet"))
    learned = docs.join(spark.read.parquet(f"{path}/labels.parquet").select("doc_id", F.col("toxic").alias("label")), "doc_id").filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    chosen, rates = toxicity.choose(learned)
    sample = sorted((r.u, r.label, tuple(r.terms)) for r in toxicity.training_rows(docs, chosen).collect())
    assert len(sample) == len({(t or "", x) for t, (i, _, x) in zip(texts, labels, strict=True) if crc(i, 5)})  # each text once
    model, seen = toxicity.FactorizationMachine(), {}
    for _, _, terms in sample:
        for term in terms:
            seen[term] = seen.get(term, 0) + 1
    model.known = np.array([seen.get(b, 0) >= toxicity.MIN_ROWS for b in range(toxicity.BUCKETS)])
    slot = lambda u: math.floor(u * (1 << 40)) % 1000
    rows = [(slot(u), label, np.array(terms, np.int32)) for u, label, terms in sample]
    cut = lambda terms: terms[model.known[terms]]
    for turn in range(toxicity.ROUNDS):
        machines = []
        for part in range(toxicity.PARTS):
            own = [(cut(t), x) for s, x, t in rows if s >= 1000 * toxicity.CALIBRATION and s % toxicity.PARTS == part]
            if own:
                new = toxicity.FactorizationMachine()
                new.bias, new.linear, new.factors = model.bias, model.linear.copy(), model.factors.copy()
                new.train([own[i] for i in np.random.default_rng(turn).permutation(len(own))])
                machines.append(new)
        changed = np.array([m.linear != model.linear for m in machines])
        at = changed.any(0)
        weight = changed[:, at] / changed[:, at].sum(0)
        model.bias = float(np.mean([m.bias for m in machines]))
        model.factors[at] = sum(w[:, None] * m.factors[at] for w, m in zip(weight, machines, strict=True))
        model.linear[at] = sum(w * m.linear[at] for w, m in zip(weight, machines, strict=True))
    back = sorted((x, model.logit(cut(t))[0]) for s, x, t in rows if s < 1000 * toxicity.CALIBRATION)
    model.calibrate(np.array([z for _, z in back]), np.array([x for x, _ in back]), np.ones(len(back)) / np.where([x for x, _ in back], rates[1], rates[0]))
    for i, text in enumerate(texts):
        assert found[i].score == pytest.approx(model.score(text), abs=2e-3)
        assert found[i].held_out == (crc(i, 5) == 0) and found[i].predicted == int(found[i].score >= 0.5)


def test_op5_bound_holds_under_copies(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_NEGATIVE", 20)
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 10)
    rows = [("same words", 1)] * 400 + [(f"text {i}", i % 2) for i in range(100)]
    chosen, rates = toxicity.choose(toxicity.with_keys(spark.createDataFrame(rows, "text string, label int")))
    assert {r.label: r["count"] for r in chosen.groupBy("label").count().collect()} == {0: 20, 1: 10}
    assert rates == {0: 20 / 50, 1: 10 / 51}


def test_op5_rounds_deal_the_sample_once(spark, monkeypatch, prose):
    rows = [(t + (" scumlord" if i % 3 == 0 else ""), int(i % 3 == 0)) for i, t in enumerate(prose(300, 40, seed=5))]
    labelled, scala = spark.createDataFrame(rows, "text string, label int"), spark.sparkContext._jsc.sc()
    kept, found = scala.getPersistentRDDs().size(), {}
    for rounds in (1, 6):
        monkeypatch.setattr(toxicity, "ROUNDS", rounds)
        scala.listenerBus().waitUntilEmpty()
        first = scala.dagScheduler().nextStageId()
        toxicity.fit(labelled)
        scala.listenerBus().waitUntilEmpty()
        no_quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        stages = scala.statusStore().stageList(None, False, False, no_quantiles, None)
        found[rounds] = sum(x.shuffleWriteBytes() for x in (stages.apply(i) for i in range(stages.size())) if x.stageId() >= first)
    assert 0 < found[6] <= 1.1 * found[1]
    assert scala.getPersistentRDDs().size() == kept


def test_op9_equals_densities_by_numpy(spark, tmp_path, prose):
    texts = [t if i % 3 else " ".join(w for w in t.split()[:6] for _ in range(7)) for i, t in enumerate(prose(150, 50, seed=1))] + [None, "", "x " * 5000]
    texts += texts[:3]
    labels = [(i, int(i % 3 > 0), 0) for i in range(150)]
    found = {r.doc_id: r for r in QUERIES["op9_quality"](spark, tables(spark, tmp_path, texts, labels=labels)).collect()}
    x = np.array([quality.statistics_of(t) for t in texts])
    train = [np.array([x[i] for i, y, _ in labels if y == k and crc(i, 5)]) for k in (0, 1)]
    total = sum(map(len, train))
    every = np.vstack(train)
    center, scale = every.mean(0), np.sqrt(np.maximum(every.var(0), 1e-9))
    pooled = sum(np.cov(t.T, bias=True) * len(t) for t in train) / total / np.outer(scale, scale)
    logs = []
    for t in train:
        d = x.shape[1]
        shrink = max(quality.SHRINK, d / (len(t) + d))
        cov = (1 - shrink) * np.cov(t.T, bias=True) / np.outer(scale, scale) + shrink * pooled + quality.RIDGE * np.eye(d)
        z = (x - center) / scale - (t.mean(0) - center) / scale
        logs.append((-0.5 * ((z * np.linalg.solve(cov, z.T).T).sum(1) + np.linalg.slogdet(cov)[1]), math.log(len(t) / total)))
    want = 1 / (1 + np.exp(-np.clip(quality.TEMPERATURE * (logs[1][0] - logs[0][0]) + logs[1][1] - logs[0][1], -500, 500)))
    assert len(found) == len(texts)
    for i in range(len(texts)):
        assert found[i].score == pytest.approx(want[i], abs=1e-6) and found[i].held_out == (crc(i, 5) == 0) and found[i].predicted == int(found[i].score >= 0.3)


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = budget - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def test_op6_takes_near_its_targets(spark, tmp_path):
    rnd = random.Random(2)
    texts = ["w " * rnd.randint(1, 40) for _ in range(3000)] + [None, "", "w\t" * 20_000, "w " * 3]
    sources = [rnd.choice(["big"] * 6 + ["a", "b", "é", None]) for _ in texts]
    found = QUERIES["op6_mixing"](spark, tables(spark, tmp_path, texts, sources=sources)).collect()
    size = [len((t or "").split()) for t in texts]
    sizes = {s: sum(n for n, x in zip(size, sources, strict=True) if x == s) for s in set(sources)}
    targets, taken, spread = plain_targets(sizes), dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0.0)
    assert len(found) == len(texts)
    for r in found:
        s = sources[r.doc_id]
        rate = targets[s] / sizes[s]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s]) and r.target == pytest.approx(targets[s])
        assert math.floor(rate) * r.size <= r.taken <= min(math.floor(rate) + 1, 2) * r.size
        taken[s] += r.taken
        spread[s] += r.size**2 * (rate % 1) * (1 - rate % 1)
    for s in sizes:  # every source, within four standard deviations of its coins
        assert abs(taken[s] - targets[s]) <= 4 * math.sqrt(spread[s]) + 1e-6
    again = QUERIES["op6_mixing"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in found}


def test_op2_hosts_in_any_case_and_clashing_columns(spark):
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    entries = spark.createDataFrame([("bad", "X.com", True, "add", day(1)), ("bad", "x.com.", True, "remove", day(5)), ("bad", "Y.COM", True, "add", day(1))], "list string, host string, blocks boolean, action string, at string").withColumn("at", F.to_timestamp("at"))
    urls = [("http://x.com", day(3)), ("http://X.COM", day(6)), ("http://a.y.com", day(6)), ("http://a.y.com", day(6)), ("http://" + "l." * 300 + "y.com", day(6))]
    rows = spark.createDataFrame([(i, u, at, "e", "h", True) for i, (u, at) in enumerate(urls)], "page_id long, url string, at string, entries string, listed_host string, __blocked boolean").withColumn("fetched_at", F.to_timestamp("at"))
    found = {r.page_id: (r["__blocked"], r.entries, r.listed_host) for r in url_lists.judge(rows, entries).collect()}
    assert found == {i: (b, "e", "h") for i, b in enumerate([True, False, True, True, True])}


def test_pipeline_with_odd_tables(spark, tmp_path, prose):
    import corpus_pipeline

    good = prose(30, 40, seed=2)
    rows = [(i, t, "aa", "s", 1, "x") for i, t in enumerate(good)] + [(None, good[0], "aa", "s", 1, "x"), (3, good[3], "aa", None, 1, "x"), (50, None, None, None, None, None), (51, "", "aa", "s", 0, "x"), (52, good[1] + " w", "aa", "s", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, copy string"
    for name, data in (("full", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path / "full"))
    kept = {r.doc_id for r in found.collect()}
    assert kept <= set(range(30)) and set(found.columns) == {"doc_id", "text", "lang", "source", "n_chars", "copy"}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


CLASHES = ["__lang", "__score", "__entropy", "__rejected", "__n_words", "__hits", "__item_ids", "__id", "__digest", "__k1", "__k2", "__n", "__source", "__rate", "__q_chars", "row", "key", "source_size", "target", "number", "n", "k1", "lost", "digest", "a.b"]


def test_clashing_columns_come_back_unchanged(spark, tmp_path, prose):
    """Every stage keeps columns that are named like its own, with their values."""
    import corpus_pipeline

    rows = [(i, t, "aa", "s", *[f"{c}{i}" for c in CLASHES]) for i, t in enumerate(prose(12, 40, seed=3))]
    rows += [rows[0], (20, rows[1][1], "aa", "s", *[f"{c}20" for c in CLASHES]), (21, rows[2][1] + " w", "aa", "s", *[f"{c}21" for c in CLASHES])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        assert [c for c in found.columns if c != "copy"] == docs.columns, name
        for r in found.collect():
            assert [r[c] for c in CLASHES] == [f"{c}{r.doc_id}" for c in CLASHES], name
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {0, 1, 2, *range(4, 12)}
    docs = docs.toDF(*[c.replace(".", "_") for c in docs.columns])  # Spark itself hands no dotted names to Arrow
    measured = quality.with_statistics(docs)
    assert measured.columns.count("__q_chars") == 1 and quality.score(measured, quality.fit(measured.withColumn("label", F.lit(1)))).columns.count("__score") == 1
    from leaguespark.llm import langid

    assert langid.identify(docs, langid.fit(docs)).columns.count("__lang") == 1


def test_op6_meets_targets_without_ids(spark, tmp_path):
    """Rows that are equal, or differ in their texts only, don't share one decision."""
    from leaguespark.llm import mixing

    texts = ["w w w"] * 1000 + [f"x{i} w w" for i in range(1000)] + ["a b"] * 500
    rows = [(None, t, "s1" if i < 2000 else "s2", str(i)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, at string").repartition(7)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    taken, target = {}, {}
    for r in plan:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source] = r.target
        assert r.copies <= 2
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target)
    # Whole rows: each as often as the plan says, equal ones one more or less.
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    counts = {r["at"]: r["count"] for r in mixed.groupBy("at").count().collect()}
    equal = [counts.get(str(i), 0) for i in range(1000)]
    assert max(equal) - min(equal) <= 1 and sum(counts.values()) == sum(r.copies for r in plan)
