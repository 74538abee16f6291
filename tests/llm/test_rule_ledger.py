import random
from collections import Counter
from functools import reduce

import pytest

from leaguespark.llm import rule_ledger as rules

SCHEMA = "doc_id long, text string, source string, __words string, kept string"


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    return len({i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)})


def test_repeated_windows_equal_brute_force():
    rnd = random.Random(4)
    for _ in range(300):
        words = [rnd.choice([b"a", b"b"]) for _ in range(rnd.randint(0, 60))]
        assert rules.repeat_words(words) == brute_repeats(words)


def test_measurements():
    text = "Uno due, $tre$\nUno due, $tre$\n \néè!!\r\néè!!"
    found = dict(zip(rules.MEASURES, rules.measurements(text), strict=True))
    assert found == {"words": 8, "word_chars": 12 * 2 + 8, "symbols": 4, "lines": 4, "dup_lines": 1, "repeat_words": 0, "capitals": 2, "shouts": 4}
    assert rules.measurements(None) == rules.measurements("") == (0,) * 8


@pytest.fixture
def judged(spark):
    clean = " ".join(f"word{i}" for i in range(30))
    texts = {1: clean, 2: None, 3: "", 4: "again " * 40, 5: " ".join(f"a{i} $ #" for i in range(30)), 6: " ".join(f"W{i}!" for i in range(30)), 7: " ".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2 + str(i) for i in range(30)), 8: "x" * 300_000 + " " + clean}
    rows = [(i, t, "s" if i % 2 else None, "clash", "clash") for i, t in texts.items()]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


def test_bits_are_the_rules_that_fail(judged):
    found = {r.doc_id: r for r in rules.judge(rules.ledger(judged)).collect()}
    names = lambda bits: {n for i, (n, _) in enumerate(rules.RULES) if bits >> i & 1}
    assert {i: names(r["__failed"]) for i, r in found.items()} == {
        1: set(), 2: {"few_words"}, 3: {"few_words"}, 4: {"repeated_windows"}, 5: {"symbols"}, 6: {"shouts"}, 7: {"long_words", "capitals"}, 8: {"long_words"},
    }
    assert {i for i, r in found.items() if r["__kept"]} == {1, 8}
    assert found[1]["__words"] == 30 and found[1].kept == "clash" and found[1].source == "s"


def test_policies_are_versions_over_the_same_ledger(judged):
    rows = rules.ledger(judged)
    kept = [sorted(r.doc_id for r in rules.judge(rows, p).filter("__kept").collect()) for p in rules.POLICIES]
    assert kept == [[1, 1, 5, 6, 7, 8], [1, 1, 7, 8], [1, 1, 8]]


def test_ablation_counts_equal_judging_again(judged):
    rows = rules.ledger(judged).cache()
    found = rules.ablate(rows, by="source").collect()
    assert {r.group for r in found} == {"s", None}
    for r in found:
        policy = next(p for p in rules.POLICIES if p.version == r.version)
        bit = rules.mask(r.rule)
        same = [x for x in rows.collect() if x.source == r.group]
        keeps = lambda x, p: not x["__failed"] & p.hard and bin(x["__failed"] & p.soft).count("1") < p.limit
        less = rules.Policy("less", 0, policy.hard & ~bit, policy.soft & ~bit, policy.limit)
        assert (r.n, r.kept, r.failing, r.kept_without) == (len(same), sum(keeps(x, policy) for x in same), sum(bool(x["__failed"] & bit) for x in same), sum(keeps(x, less) for x in same))
        assert r.failed_by_any == reduce(lambda a, x: a | x["__failed"], same, 0)
    assert rules.ablate(rows.limit(0)).collect() == [] and rules.ledger(judged.limit(0)).collect() == []
