import random
import re

import numpy as np
import pytest

from leaguespark.llm import ngram_join as nj
from leaguespark.llm.components import connected


def brute(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def mutated(rnd, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def cases(prose, seed=1):
    rnd = random.Random(seed)
    base = prose(12, 120, seed=seed)
    texts = list(base)
    for t in base[:4]:
        texts += [mutated(rnd, t, e) for e in (0, 1, 1, 2, 2, 3, 3, 4, 5)]
    step = base[5]
    for _ in range(15):  # a chain: neighbours link, ends don't
        step = mutated(rnd, step, 1)
        texts.append(step)
    passage = prose(1, 70, seed=99)[0]  # a passage that many documents share
    texts += [f"{passage} {t}" for t in prose(40, 20, seed=7)]
    texts += [base[6].upper(), f" {base[7]}\n", None, "", " ", "one two", "One  two", "one two three four", "a b c d e", "a b c d e f", "x " * 3000]
    rnd.shuffle(texts)
    return texts


def rows(found):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, documents, prose, seed):
    texts = cases(prose, seed)
    assert rows(nj.near_duplicates(documents(texts).repartition(3))) == brute(texts)


def test_blocks_salts_and_small_trees(spark, documents, prose, monkeypatch):
    """Every key is salted and joined in blocks; order of rarity plays no part in the result."""
    monkeypatch.setattr(nj, "BLOCK", 3)
    monkeypatch.setattr(nj, "SALTS", 3)
    real = nj._prefixes
    monkeypatch.setattr(nj, "_prefixes", lambda docs, slots: real(docs, np.where(np.arange(len(slots)) % 2, 10**9, 0)))
    texts = cases(prose, 3)
    assert rows(nj.near_duplicates(documents(texts))) == brute(texts)


def test_tree_join_equals_all_pairs():
    rng = np.random.default_rng(3)
    centers = rng.poisson(8, (40, nj.GROUPS))
    points = np.concatenate([np.maximum(0, centers + rng.integers(-1, 2, centers.shape) * (rng.random(centers.shape) < 0.2)) for _ in range(30)]).astype(np.int64)
    sizes, components = points.sum(1), rng.integers(0, 5, len(points))

    def plain(a, b, own):
        found = set()
        for i in a:
            bound = np.minimum(points[i], points[b]).sum(1) >= nj.needed_overlap(sizes[i], sizes[b])
            sized = (100 * sizes[i] >= 80 * sizes[b]) & (100 * sizes[b] >= 80 * sizes[i])
            for j in b[bound & sized & (components[b] != components[i])]:
                if not own or i < j:
                    found.add((int(i), int(j)))
        return found

    every = np.arange(len(points))
    tree = lambda at: nj.CountVectorTree(points[at], sizes[at], components[at])
    t = tree(every)
    got = [tuple(sorted(p)) for x, y in t.join(t) for p in zip(x.tolist(), y.tolist(), strict=True)]
    assert len(got) == len(set(got)) and set(got) == plain(every, every, True)
    a, b = every[:35], every[35:]
    got = [(int(a[p]), int(b[q])) for x, y in tree(a).join(tree(b)) for p, q in zip(x, y, strict=True)]
    assert len(got) == len(set(got)) and set(got) == plain(a, b, False)


def test_repeated_rows_nulls_and_empty_tables(spark, documents, prose):
    texts = prose(3, 30)
    docs = documents([texts[0], texts[0], texts[1]])
    assert rows(nj.near_duplicates(docs.unionByName(docs))) == {0: (26, 0), 1: (26, 0), 2: (26, 2)}
    assert nj.near_duplicates(docs.unionByName(docs)).count() == 6
    assert nj.near_duplicates(documents([])).count() == 0
    nulls = spark.createDataFrame([(None, texts[0]), (5, texts[0]), (None, texts[1])], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in nj.near_duplicates(nulls).collect()) == [(0, 0), (0, 5), (5, 5)]
    kept = nj.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_connected_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)] + [(1, 1)]
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if x != 1 and any(a != b and x in (a, b) for a, b in links)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_representatives_are_rows(spark, prose):
    a, b, c, d = prose(4, 60)
    near = lambda t: " ".join([*t.split()[:-1], "changed"])
    table = [
        (None, a), (None, near(a)),  # near copies without an id: one stays
        (7, b), (7, near(b)),  # under one id: one stays
        (3, c), (9, near(c)), (9, d),  # 9's other text names its own component
        (5, prose(1, 60, seed=8)[0]), (5, prose(1, 60, seed=8)[0]),  # repeated rows
        (None, ""), (None, None), (1, " "),  # no words: no copies
    ]
    docs = spark.createDataFrame(table, "doc_id int, text string")
    kept = nj.keep_representatives(docs)
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(i for i, t in got if i is not None) == [1, 3, 5, 7, 9]
    assert sum(i is None for i, _ in got) == 3
    assert (3, c) in got and (9, d) in got
    assert set(got) <= set(table)
