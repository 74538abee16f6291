"""Prefix tries of conversations, built bucket by bucket.

A turn becomes a digest (SHA-256 of role and text, the role's length before
them), so that texts are read once and never shuffled.  Equal conversations are
combined first; what is left is one sequence of digests for each distinct
conversation.  Sequences are dealt to buckets by the digest of their first turn.
``applyInPandas`` builds one trie of pointers a bucket: a dictionary from (node,
digest) to node.  A node is made after its parent, so going through the nodes
backwards is a postorder without recursion, which sums up leaves and savings.

A first turn with more than ``MAX_TURNS`` turns below it isn't put into a bucket.
Spark aggregates its node and all that follow it up to the first place where its
sequences part (the common prefix of the smallest and the largest sequence), and
the sequences are dealt out again by their next turn, as often as it takes.  The
values of such nodes are summed up from the tries below them afterwards.

The ids of the conversations that end in a node are hashed as one text.  SHA-256
runs from the first id to the last, so the sorted ids of a node pass through one
task; they come in pieces of at most ``PIECE`` ids and are never held together.

Defined cases: rows without conv_id belong to no conversation and are left out;
turns go by number, null first, equal numbers by their digest; repeated rows are
turns of their own; a null role or text is the empty one; other columns are
ignored; an empty table has no nodes, not even a root.  The digests of one
conversation (40 bytes a turn) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguespark.llm.common import small_batches, stash

#: Turns of distinct sequences in one bucket on average, and at most below one key.
BUCKET_TURNS = 20_000
MAX_TURNS = 4_000
#: Ids of one piece of a node's ends, a power of two.
PIECE = 4096
#: Turns that a conversation may take over from another one.
HEAD = 8

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent_key binary"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, base, path array of digests, sizes array of bytes) of each conversation, one shuffle by base."""
    conv = F.col("conv_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(conv.alias("conv_id"), (conv - conv % 5).alias("base"), F.col("turn").cast("long").alias("turn"), turn_digest(F.col("role"), F.col("text")).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.filter("conv_id IS NOT NULL").repartition("base")
    # Structs sort by their fields in turn, nulls first.
    grouped = rows.groupBy("base", "conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "digest", "bytes"))).alias("t"))
    return grouped.select("conv_id", "base", F.col("t.digest").alias("path"), F.col("t.bytes").alias("sizes"))


def with_shared_heads(convs: DataFrame) -> DataFrame:
    """Conversations rebuilt: the first h turns of their base, then their own after the first h; h = crc32(conv_id) % 9."""
    own = F.col("conv_id") == F.col("base")
    by_base = Window.partitionBy("base")
    head = F.max(F.when(own, F.struct(F.slice("path", 1, HEAD).alias("path"), F.slice("sizes", 1, HEAD).alias("sizes")))).over(by_base)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    rebuilt = lambda c, kind: F.concat(F.coalesce(F.slice(F.col("head")[c], F.lit(1), h), F.array().cast(f"array<{kind}>")), F.slice(c, h + 1, F.greatest(F.size(c), F.lit(1))))
    return convs.withColumn("head", head).select("conv_id", rebuilt("path", "binary").alias("path"), rebuilt("sizes", "bigint").alias("sizes"))


def hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq, ends_sha256) of sorted rows (seq, piece): pieces of a seq are parts of one text, joined by commas."""
    seq, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key == seq:
                state.update(b"," + piece.encode())
                continue
            if state is not None:
                done.append((seq, state.hexdigest()))
            seq, state = key, hashlib.sha256(piece.encode())
        yield pa.record_batch([pa.array([k for k, _ in done], pa.binary()), pa.array([v for _, v in done], pa.string())], ["seq", "ends_sha256"])
    if state is not None:
        yield pa.record_batch([pa.array([seq], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["seq", "ends_sha256"])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(path, sizes, n, conv_id, ends_sha256): each sequence once, how many conversations it is, the smallest and the hash of all."""
    small_batches(convs.sparkSession)
    seq = F.unhex(F.sha2(F.array_join(F.transform("path", F.base64), ",").cast("binary"), 256))
    keyed = convs.withColumn("seq", seq)
    once = keyed.groupBy("seq", "path", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    block = F.shiftright("conv_id", PIECE.bit_length() - 1)
    pieces = keyed.groupBy("seq", block.alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("piece"))
    ordered = pieces.repartition("seq").sortWithinPartitions("seq", "block").select("seq", "piece")
    ends = ordered.mapInArrow(hash_in_order, "seq binary, ends_sha256 string")
    return once.join(ends, "seq").drop("seq")


class Trie:
    """Nodes as parallel lists; ``children`` points from (node, digest) to a node.  Node -1 stands above the tops."""

    def __init__(self) -> None:
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.bytes: list[int] = []
        self.convs: list[int] = []
        self.least: list[int] = []
        self.ends: list[str] = []

    def add(self, above: int, depth: int, path: list[bytes], sizes: list[int], n: int, conv_id: int, ends: str) -> int:
        """The nodes of one sequence from ``depth`` on, below ``above``; gives the first of them."""
        at, top = above, above
        for i in range(depth - 1, len(path)):
            key = (at, path[i])
            found = self.children.get(key)
            if found is None:
                found = self.children[key] = len(self.parent)
                self.parent.append(at)
                self.depth.append(i + 1)
                self.bytes.append(sizes[i])
                self.convs.append(0)
                self.least.append(conv_id)
                self.ends.append(NO_ENDS)
            self.convs[found] += n
            self.least[found] = min(self.least[found], conv_id)
            at = found
            top = found if top == above else top
        self.ends[at] = ends
        return top

    def sums(self) -> tuple[list[int], list[int], list[int]]:
        """Children, leaves and savings of each node; children before parents."""
        size = len(self.parent)
        children, leaves = [0] * size, [0] * size
        saved = [(n - 1) * b for n, b in zip(self.convs, self.bytes, strict=True)]
        for i in range(size - 1, -1, -1):
            leaves[i] = leaves[i] or 1
            if self.parent[i] >= 0:
                children[self.parent[i]] += 1
                leaves[self.parent[i]] += leaves[i]
                saved[self.parent[i]] += saved[i]
        return children, leaves, saved


def build(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one bucket; ``parent_key`` is set for the tops only."""
    trie, tops = Trie(), {}
    above: dict[bytes, int] = {}
    for key, depth, parent_key, parent_conv, path, sizes, n, conv_id, ends in zip(*(rows[c] for c in ("key", "depth", "parent_key", "parent_conv_id", "path", "sizes", "n", "conv_id", "ends_sha256")), strict=True):
        # Each key has a place of its own above its top: two keys may begin with the same turn in different places.
        root = above.setdefault(key, -1 - len(above))
        tops[trie.add(root, depth, path.tolist(), sizes.tolist(), int(n), int(conv_id), ends)] = (parent_key, int(parent_conv))
    children, leaves, saved = trie.sums()
    parents = [tops[i][1] if p < 0 else trie.least[p] for i, p in enumerate(trie.parent)]
    keys = [tops[i][0] if p < 0 else None for i, p in enumerate(trie.parent)]
    return pd.DataFrame({"conv_id": trie.least, "depth": trie.depth, "parent_conv_id": parents, "n_convs": trie.convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": trie.ends, "parent_key": keys})


def _common(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    return F.when(other > 0, other - 1).otherwise(F.size(a))


def _split(rows: DataFrame) -> DataFrame:
    """One row for each key: the nodes from its depth to the place where its sequences part."""
    lo = F.min(F.struct("path", "ends_sha256", "sizes"))
    found = rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), lo.alias("lo"), F.max("path").alias("hi"), F.any_value("depth").alias("depth"), F.any_value("parent_key").alias("parent_key"), F.any_value("parent_conv_id").alias("parent_conv_id"))
    m = _common(F.col("lo.path"), F.col("hi"))
    found = found.withColumn("m", m)
    # Only the smallest sequence can end where the sequences part.
    ends = F.when(F.size("lo.path") == F.col("m"), F.col("lo.ends_sha256")).otherwise(F.lit(NO_ENDS))
    return found.select("key", "n", "conv_id", "depth", "parent_key", "parent_conv_id", "m", ends.alias("ends"), F.slice("lo.sizes", F.col("depth"), F.col("m") - F.col("depth") + 1).alias("chain"))


def _chains(split: DataFrame, tops: DataFrame) -> DataFrame:
    """Split nodes with the sums of what is below them: (split's columns, children, leaves, below)."""
    below = tops.groupBy("parent_key").agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below")).withColumnRenamed("parent_key", "of")
    joined = split.join(below, F.col("key") == F.col("of"), "left")
    return joined.withColumns({"children": F.coalesce("children", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(1)), "below": F.coalesce("below", F.lit(0)).cast("long")})


def _chain_nodes(chains: DataFrame) -> DataFrame:
    last = F.col("i") == F.size("chain") - 1
    # What the nodes from the i-th on save themselves.
    rest = F.aggregate(F.slice("chain", F.col("i") + 1, F.size("chain")), F.lit(0).cast("long"), lambda a, x: a + x)
    nodes = chains.select("*", F.posexplode("chain").alias("i", "bytes"))
    return nodes.select(
        "conv_id", (F.col("depth") + F.col("i")).cast("long").alias("depth"), F.when(F.col("i") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * rest).alias("saved_tokens"), F.when(last, F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"), F.when(F.col("i") == 0, F.col("parent_key")).alias("parent_key"),
    )


def nodes(convs: DataFrame, bucket_turns: int = BUCKET_TURNS, max_turns: int = MAX_TURNS) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, path, sizes), the root included."""
    spark = convs.sparkSession
    seqs = stash(distinct_sequences(convs))
    total = seqs.agg(F.min("conv_id"), F.sum("n"), F.sum(F.size("path")), F.max(F.when(F.size("path") == 0, F.col("ends_sha256")))).first()
    if total[0] is None:
        return spark.createDataFrame([], NODE).drop("parent_key")
    root = b""
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total[2] // bucket_turns))
    opened = seqs.filter(F.size("path") > 0).select(F.element_at("path", 1).alias("key"), F.lit(1).alias("depth"), F.lit(root).alias("parent_key"), F.lit(total[0]).cast("long").alias("parent_conv_id"), "path", "sizes", "n", "conv_id", "ends_sha256")
    built: list[DataFrame] = []
    splits: list[DataFrame] = []
    while True:
        sizes = opened.groupBy(F.col("key").alias("large")).agg(F.sum(F.size("path") - F.col("depth") + 1).alias("turns"))
        large = stash(sizes.filter(F.col("turns") > max_turns).select("large"))
        some = not large.isEmpty()
        rest = opened.join(large, F.col("key") == F.col("large"), "left_anti") if some else opened
        bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
        built.append(stash(rest.groupBy(bucket.alias("bucket")).applyInPandas(build, NODE)))
        if not some:
            break
        over = opened.join(large, F.col("key") == F.col("large"), "left_semi")
        split = stash(_split(over))
        splits.append(split)
        # A key stands for all that comes before it, so the key and the next turn do as well.
        where = split.select(F.col("key").alias("of"), F.col("m"), F.col("conv_id").alias("above"))
        further = over.join(where, F.col("key") == F.col("of")).filter(F.size("path") > F.col("m"))
        child = F.unhex(F.sha2(F.concat("key", F.element_at("path", F.col("m") + 1)), 256))
        opened = stash(further.select(child.alias("key"), (F.col("m") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("above").alias("parent_conv_id"), "path", "sizes", "n", F.col("conv_id"), "ends_sha256"))
    # From the deepest round up: the tops of a round are summed into the split nodes of the round before.
    tops = built[-1].filter("parent_key IS NOT NULL").select("parent_key", "n_leaves", "saved_tokens")
    found = [built[-1]]
    for split, same in zip(reversed(splits), reversed(built[:-1]), strict=True):
        chain = stash(_chain_nodes(_chains(split, tops)))
        found += [chain, same]
        tops = chain.unionByName(same).filter("parent_key IS NOT NULL").select("parent_key", "n_leaves", "saved_tokens")
    top = tops.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_leaves"), F.lit(1)), F.coalesce(F.sum("saved_tokens"), F.lit(0))).first()
    whole = spark.createDataFrame([(total[0], 0, None, total[1], top[0], top[1], top[2], total[3] or NO_ENDS, None)], NODE)
    for part in found:
        whole = whole.unionByName(part)
    return whole.drop("parent_key")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    return nodes(with_shared_heads(sequences(turns)))
