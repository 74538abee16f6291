import re

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
from leaguespark.llm import mixing

from tests.llm.test_ngram_join import brute


def test_pipeline_equals_its_stages_by_brute_force(spark, prose, tmp_path):
    base = prose(20, 60, seed=4)
    item = prose(1, 30, seed=77)[0]
    near = base[0].split()
    near[3] = "changed"
    texts = [*base, base[1] + " ", base[2].replace(" ", "\n"), " ".join(near), base[5] + " " + " ".join(item.split()[4:15]), "12 34", None, base[1]]
    table = {"doc_id": list(range(len(texts))), "text": texts, "lang": ["aa"] * len(texts), "source": [f"s{i % 3}" for i in range(len(texts))], "n_chars": [len(t or "") for t in texts]}
    pq.write_table(pa.table(table, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), tmp_path / "benchmark.parquet")

    kept = {i: t for i, t in enumerate(texts) if t and re.search("[a-z]", t)}
    first = {}
    for i, t in kept.items():
        first.setdefault(re.sub(r"\s+", " ", t), i)
    kept = {i: texts[i] for i in first.values()}
    ids = sorted(kept)
    kept = [ids[i] for i, (_, root) in brute([texts[i] for i in ids]).items() if root == i]
    kept = {i for i in kept if i != len(base) + 3}

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert docs.columns == list(table), name
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= kept
    plan = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").count().collect()
    assert all(r["count"] <= 2 for r in plan) and len(plan) >= len(kept) // 2


def test_each_stage_keeps_exactly_its_documents(spark, prose, tmp_path):
    base = prose(20, 60, seed=4)
    item = prose(1, 30, seed=77)[0]
    near = " ".join([*base[0].split()[:3], "changed", *base[0].split()[4:]])
    leak = base[5] + " " + " ".join(item.split()[4:15])
    texts = [*base, base[1] + " ", base[2].replace(" ", "\n"), near, leak, "12 34", None, base[1]]
    table = [(i, t, "aa", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    lettered = {i: t for i, t in enumerate(texts) if t and re.search("[a-z]", t)}
    first: dict[str, int] = {}
    for i, t in lettered.items():
        first.setdefault(re.sub(r"\s+", " ", t), i)
    single = sorted(first.values())
    apart = [single[i] for i, (_, root) in brute([texts[i] for i in single]).items() if root == i]
    passages = {tuple(item.split()[k : k + 10]) for k in range(21)}
    clean = [i for i in apart if not passages & {tuple(texts[i].split()[k : k + 10]) for k in range(len(texts[i].split()))}]
    wanted = [sorted(lettered), single, apart, clean]
    assert len(set(map(len, wanted))) >= 3

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted, strict=False):
        docs = stage(spark, docs, str(tmp_path))
        assert sorted(tuple(r) for r in docs.collect()) == [table[i] for i in want], name
    mixed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    plan = mixing.mix_plan(spark.createDataFrame([table[i] for i in clean], docs.schema))
    copies = {r.doc_id: r.copies for r in plan.collect() if r.copies}
    for found in (mixed, corpus_pipeline.run(spark, str(tmp_path))):
        assert {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()} == copies
