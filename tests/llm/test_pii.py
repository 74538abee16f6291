import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from leaguespark.llm import pii
from leaguespark.llm.queries import QUERIES

PARTS = ["a@b.c", "@", ".", "_", "d@e.f", "x", "+", "-", " ", "1", "12", "255", "256.", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "+1 (743) 555-3824", "(743) 555-3824", "+33", "é", "\n", "😀", "\x01", "Dr. Smith", "123-45-6789", "0000", "999999999999999", "(", ")"]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    for kind, pattern, passes in rules:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if passes(m)]
    return out


def test_base_spans_equal_plain_expressions(spark, documents):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    texts += [None, "", "a" * 200_000, "1" * 100_000, "a@" + "b.c" * 20_000, "+" * 50_000, "+1" + "(" * 100_000, "x@y.zz " * 300]
    found = {r.doc_id: r for r in pii.find(documents(texts)).collect()}
    for i, text in enumerate(texts):
        if text is None or len(text) < 3000:
            assert [tuple(s)[:3] for s in found[i].base] == brute(text)
        for s in found[i].added:
            assert s.kind in pii.ADDED_KINDS and not any(b.start < s.end and s.start < b.end for b in found[i].base)
    assert [tuple(s)[:3] for s in found[1504].base] == [("email", 0, 60_002)]
    assert any(found[i].added for i in range(1500))


def test_empty(spark, documents):
    assert pii.find(documents([])).count() == 0
    assert [(r.base, r.added) for r in pii.find(documents([None, "plain words"])).collect()] == [([], []), ([], [])]


def test_expectation_maximisation_tells_reliable_labelers():
    """Labelers with planted reliabilities: the posterior follows the good ones."""
    rnd = random.Random(1)
    counts, truth = {}, {}
    for _ in range(4000):
        personal = rnd.random() < 0.6
        votes = "".join(str(int(personal if rnd.random() < q else not personal)) for q in (0.9, 0.85, 0.6, 0.9))
        counts["k", votes] = counts.get(("k", votes), 0) + 1
        good, all_ = truth.get(votes, (0, 0))
        truth[votes] = good + personal, all_ + 1
    posterior = pii.estimate(counts)
    assert all(abs(posterior["k", v] - g / n) < 0.15 for v, (g, n) in truth.items() if n > 50)
    weights = pii.train({("k", "10000"): (100.0, 90.0), ("k", "00000"): (100.0, 10.0)})
    assert weights["kind:k"] < 0 < weights["kind:k"] + weights["f0"]


def test_sums_and_overlaps_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        spans = lambda n: sorted((s := rnd.randint(0, 60), s + rnd.randint(1, 5)) for _ in range(rnd.randint(0, n)))
        rows.append((i, [rnd.randint(0, 9) for _ in range(rnd.randint(0, 400))], spans(8), spans(8)))
    df = spark.createDataFrame(rows, "i long, numbers array<long>, added array<struct<start:long,end:long>>, base array<struct<start:long,end:long>>")
    found = df.select("i", pii.sums_before(F.col("numbers")).alias("sums"), pii.off_base(F.col("added"), F.col("base")).alias("clear"))
    for r in found.collect():
        _, numbers, added, base = rows[r.i]
        assert r.sums == [sum(numbers[:k]) for k in range(len(numbers))]
        assert [tuple(x) for x in r.clear] == [a for a in added if not any(b[0] < a[1] and a[0] < b[1] for b in base)]


def test_time_follows_the_number_of_spans(spark, documents):
    def seconds(n):
        docs = documents([" ".join(f"mail x{i}@y.com or Dr. Smith" for i in range(n))])
        begun = time.time()
        [row] = pii.find(docs).collect()
        assert len(row.base) == n
        return time.time() - begun

    seconds(100)
    short = seconds(4_000)
    assert seconds(32_000) < 8 * short + 20  # growing with the square, it would be 64 times


def iban(rnd, country, length, right=True):
    body = "".join(rnd.choice("0123456789") for _ in range(length - 4))
    number = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{country}{(98 - number % 97 + (not right) * 7) % 97:02d}{body}"


def test_planted_spans_of_added_kinds(spark, documents, prose):
    """Spans of every added kind after cue words, and look-alikes: precision and recall of at least 0.9."""
    rnd, texts, planted = random.Random(3), [], []
    filler = prose(400, words=12, seed=9)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    for text in filler:
        kind = rnd.choice(pii.ADDED_KINDS)
        true = rnd.random() < 0.7
        cue, hit = "", ""
        if kind == "ssn":
            cue, hit = ("social ", f"{rnd.randint(101, 665)}-{rnd.randint(10, 98)}-{rnd.randint(1000, 9999)}") if true else ("order ", f"9{digits(2)}-00-{digits(4)}")
        elif kind == "iban":
            cue, hit = ("iban ", iban(rnd, *rnd.choice([("DE", 22), ("FR", 27), ("ES", 24)]))) if true else ("serial ", iban(rnd, "ZZ", 19, False))
        elif kind == "local":
            cue, hit = ("call ", f"({rnd.randint(201, 989)}) {rnd.randint(201, 989)}-{rnd.randint(2000, 9999)}") if true else ("ref ", f"011-1{digits(2)}-1111")
        elif kind == "name":
            true, cue, hit = True, "contact ", rnd.choice(["Dr. ", "Mrs. ", "Prof. "]) + rnd.choice(["Smith", "Garcia", "Weber", "Dubois"])
        elif kind == "hidden":
            true, cue, hit = True, "mail ", f"u{digits(3)}[at]mail{digits(1)}.com"
        elif kind == "ipv6":
            group = lambda: "".join(rnd.choice("123456789abcdef") for _ in range(4))
            cue, hit = ("host ", ":".join(["2a02", *[group() for _ in range(7)]])) if true else ("version ", "0:0:0:0:0:0:0:1")
        else:
            cue, hit = ("tel ", f"0033 {rnd.randint(1, 9)}{digits(2)} {digits(3)} {digits(3)}") if true else ("build ", "00999 11111111")
        left = text + " " + cue
        planted.append((kind, len(left), len(left) + len(hit)) if true else None)
        texts.append(left + hit + " " + text)
    found = {r.doc_id: {tuple(s) for s in r.added} for r in pii.find(documents(texts)).collect()}
    right = sum(p in found[i] for i, p in enumerate(planted) if p)
    assert right >= 0.9 * sum(p is not None for p in planted)
    assert right >= 0.9 * sum(map(len, found.values()))


def test_registered_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(15)
    texts = [None, ""] + ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(200)]
    texts += texts[5:9]
    spark.createDataFrame([(i, t, "b") for i, t in enumerate(texts)], "doc_id long, text string, base string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op10_pii"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.BASE_KINDS)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans.startswith(joined) and 0 <= r.n_likely <= r.spans.count(",") + 1
