import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from leaguespark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"


def brute(rows):
    """The contract, word for word, over all rebuilt prefixes."""
    turns = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[-1] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaf = lambda m: not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in members)
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(m) == len(node) + 1 for m in below), sum(map(leaf, below)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == columns
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def table(seed, n, kinds=3, longest=12):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(n), -3, -10]:
        for turn in range(rnd.randint(1, longest)):
            rows.append((c, rnd.choice([turn, turn, None]), rnd.choice(["user", None]), rnd.choice(["é" * k for k in range(kinds)]), 1, "x"))
    rows += [(None, 1, "user", "a", 1, "x"), (3, 2, "user", "b", 1, "x"), (3, 2, "user", "b", 1, "x"), (4, 0, None, None, None, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = table(seed, 40)
    assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_large_first_turns_are_dealt_out_again(spark):
    """With small bounds nearly every key is split, several times; the nodes are the same."""
    rows = table(3, 60, kinds=2) + [(c, t, "system", "hello", 1, "x") for c in range(200, 260) for t in range(15)]
    turns = spark.createDataFrame(rows, SCHEMA)
    convs = prefix_trie.with_shared_heads(prefix_trie.sequences(turns))
    assert rows_of(prefix_trie.nodes(convs, bucket_turns=50, max_turns=6)) == brute(rows)


def test_one_long_conversation_is_one_chain(spark):
    """No bound on the length: a key that can't be parted becomes a chain of nodes in Spark."""
    turns = spark.range(3000).select(F.lit(10).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    convs = prefix_trie.with_shared_heads(prefix_trie.sequences(turns.unionByName(turns.withColumn("conv_id", F.lit(11).cast("long")))))
    found = prefix_trie.nodes(convs, max_turns=100).collect()
    assert sorted(r.depth for r in found) == list(range(3001))
    assert {(r.n_convs, r.n_leaves) for r in found} == {(2, 1)}
    texts = [len(f"t{i}") for i in range(3000)]
    assert all(r.saved_tokens == sum(texts[max(r.depth - 1, 0) :]) for r in found)


def test_ids_are_hashed_in_pieces(spark):
    """A conversation that very many others equal: its ids are several pieces, in numeric order."""
    n = 3 * prefix_trie.PIECE
    turns = spark.range(n).select((F.col("id") * 5).alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text"))
    found = {r.depth: r for r in prefix_trie.conversation_trie(turns).collect()}
    assert found[1].n_convs == n and found[1].ends_sha256 == hashlib.sha256(",".join(str(5 * i) for i in range(n)).encode()).hexdigest()
    assert found[0].saved_tokens == found[1].saved_tokens == 2 * (n - 1)


def test_empty_and_turnless(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    c = next(i for i in range(1, 50) if i % 5 and zlib.crc32(str(i).encode()) % 9 > 1)
    rows = [(c, 1, "user", "only", 1, "x")]
    assert rows_of(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
