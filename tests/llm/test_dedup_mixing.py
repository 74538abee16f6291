import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leaguespark.llm import exact_dedup, mixing


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


TEXTS = ["a  b", "a b", "a\tb", None, "", " ", "\n \t", "x" * 200_000, "x" * 200_000, "é b", "é b", "a b ", *["hot copy"] * 50]


def expected(texts):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[normal(t)].append(i)
    return {i: (min(g), len(g), i == min(g)) for g in groups.values() for i in g}


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, lambda t: F.substring(F.sha2(t, 256), 1, 1).cast("binary"), lambda t: F.lit("same").cast("binary")])
def test_groups_survive_any_digest(spark, documents, digest):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents(TEXTS).repartition(5), digest).collect()}
    assert got == expected(TEXTS)


def test_hot_groups_go_by_broadcast(spark, documents):
    texts = ["hot"] * 1500 + [f"t{i}" for i in range(300)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents(texts)).collect()}
    assert got == expected(texts)


def test_deduplicate_keeps_rows(spark, documents):
    docs = documents(TEXTS)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in expected(TEXTS).items() if x[2])
    twice = docs.unionByName(docs)  # repeated rows count as copies, one row of each text stays
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(twice).collect()) == sorted(r.doc_id for r in kept.collect())
    assert exact_dedup.deduplicate(documents([])).count() == 0 and exact_dedup.exact_groups(documents([])).count() == 0


def test_null_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.kept) if r.doc_id else (0, r.keep_id or 0, r.kept) for r in exact_dedup.exact_groups(rows).collect())
    assert got == [(0, 0, True), (0, 3, False), (3, 3, True)]
    assert sorted(r.text for r in exact_dedup.deduplicate(rows).collect()) == ["a", "b"]


def targets(sizes, weights=(5, 2, 1), epochs=1.5, cap=2.0):
    """Plain water filling."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = epochs * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] >= cap * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing_plan(spark, documents, prose):
    texts = [*prose(300, 20), None, "", "  x y\x0bz "]
    sources = {i: ("big" if i % 3 else f"s{i % 7}") for i in range(302)}
    docs = documents(texts, sources=sources)
    rows = mixing.mix_plan(docs).collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}
    assert {r.doc_id: r.size for r in rows} == words
    totals = defaultdict(int)
    for i, n in words.items():
        totals[sources.get(i)] += n
    want = targets(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and abs(r.target - want[r.source]) < 1e-6
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 2
    taken = sum(r.size * r.copies for r in rows if r.source == "big")
    assert abs(taken / want["big"] - 1) < 0.15
    again = {r.doc_id: r.copies for r in mixing.mix_plan(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in rows}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    assert {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {k: v for k, v in again.items() if v}


def test_mixing_by_shuffle_and_empty(spark, documents, prose, monkeypatch):
    docs = documents(prose(40, 5), sources={i: f"s{i % 4}" for i in range(35)})
    want = sorted(tuple(r) for r in mixing.mix_plan(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(tuple(r) for r in mixing.mix_plan(docs).collect()) == want
    assert mixing.mix_plan(documents([])).count() == 0
    assert mixing.mix_plan(documents([None, ""])).count() == 2
