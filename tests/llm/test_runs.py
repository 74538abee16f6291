import random

from leaguespark.llm import runs


def brute(words):
    """Every stretch of every period, by comparing all words."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(rnd):
    words = [rnd.randrange(rnd.choice([1, 2, 3, 40])) for _ in range(rnd.randint(0, 120))]
    for _ in range(rnd.randint(0, 4)):
        if len(words) > 4:
            a, p = rnd.randrange(len(words)), rnd.randint(1, len(words) // 3)
            for i in range(a, min(len(words), a + p * rnd.randint(2, 6) + rnd.randint(0, 3))):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(11)
    for _ in range(1500):
        words = planted(rnd)
        assert runs.find_runs(words) == brute(words)


def test_every_period_has_one_block_length():
    for longest in (1, 5, 6, 7, 1000):
        ranges = sorted((low, high, block) for block, found in runs.scales(longest).items() for low, high in found)
        assert [low for low, _, _ in ranges] == [1, *(high + 1 for _, high, _ in ranges[:-1])] and ranges[-1][1] == longest
        for low, high, block in ranges:
            assert all(2 * block - 1 <= max(12, 2 * q) - q for q in range(low, high + 1))


def test_long_periods_use_short_keys():
    """Blocks beyond KEY_WORDS are found by their beginnings."""
    rnd = random.Random(3)
    period = [rnd.randrange(50) for _ in range(1500)]
    words = [99, 98] + period * 3 + period[:7] + [97]
    assert [r for r in runs.find_runs(words) if r[2] == 1500] == [(2, 4507, 1500)]


def test_nested_and_touching_runs():
    words = (["a"] * 14 + ["b"]) * 3
    assert runs.find_runs(words) == [(0, 14, 1), (0, 45, 15), (15, 14, 1), (30, 14, 1)]
    assert runs.collapse(words, [(0, 45, 15), (0, 14, 1)]) == ["a", "b"]


def test_very_long_texts_of_one_word_stay_fast():
    assert runs.find_runs(["x"] * 200_000) == [(0, 200_000, 1)]
    assert runs.find_runs(list("ab") * 30_000) == [(0, 60_000, 2)]


def test_detect_keeps_columns_and_handles_odd_texts(spark):
    rows = [(1, None, "k", 1), (2, "", "k", 1), (3, " \t\n", "k", 1), (4, "one  two\tthree", "k", 1), (4, "one  two\tthree", "k", 1), (5, "é è " * 12, None, None), (6, "w " * 11, "k", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __runs string, length int")
    found = sorted(runs.detect(docs).collect(), key=lambda r: r.doc_id)
    assert runs.detect(docs).columns == ["doc_id", "text", "length", "__runs", "__collapsed"]
    assert [r["__collapsed"] for r in found] == ["", "", "", "one two three", "one two three", "é è", "w w w w w w w w w w w"]
    assert [[tuple(x) for x in r["__runs"]] for r in found] == [[], [], [], [], [], [(0, 12, 1)], []]
    assert [r.text for r in found] == [r[1] for r in rows] and found[-1].length == 2
    assert runs.detect(docs.limit(0)).collect() == []
