import re

from leaguespark.llm import decontaminate as dc


def brute(texts, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            for i in range(max(1, len(iw) - size + 1)) if iw else ():
                win = iw[i : i + size]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        found.add(str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def check(spark, documents, texts, items, **options):
    docs = documents(texts)
    got = dc.find_hits(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    rows = {r.doc_id: (r["__n_words"], sum(r["__hits"][1::2]) - sum(r["__hits"][::2]), list(r["__item_ids"])) for r in got.collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts, items)
    assert got.columns[: len(docs.columns)] == docs.columns
    clean = dc.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in rows.items() if not r[1]}


def texts_and_items(prose):
    passages = prose(6, 25, seed=3)
    texts = prose(20, 80)
    texts[2] += " " + passages[0]
    texts[3] = passages[1].upper() + "!! " + passages[1]
    texts[4] = "x " + " ".join(passages[2].split()[3:14]) + " y"
    texts[5] += ", ".join(passages[3].split())
    items = [(i, p) for i, p in enumerate(passages)] + [(10, "tiny item"), (11, None), (12, "  ..."), (13, passages[0]), (10, "tiny item")]
    return [*texts, "a Tiny, item here tiny item", None, "", " ", "tiny", texts[2]], items


def test_hits_equal_brute_force(spark, documents, prose):
    check(spark, documents, *texts_and_items(prose))


def test_blocks_of_the_benchmark_give_the_same(spark, documents, prose):
    check(spark, documents, *texts_and_items(prose), block_bytes=4000)


def test_empty_tables(spark, documents, prose):
    check(spark, documents, ["a b c", None], [])
    assert dc.find_hits(documents([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
