"""Near-duplicate documents by an exact n-gram Jaccard join over a count-vector R-tree.

A document's set holds the hashes (64 bits) of its distinct shingles of ``WORDS``
words.  Two documents link when the Jaccard similarity is at least ``PERCENT`` %.
No link between different sets is lost, and no pairs inside a group of equal or
near copies are spelled out:

1. One pass measures every document: set size, a 128-bit digest of the set, and a
   count vector: its shingles are dealt by hash into ``GROUPS`` groups, and the
   group counts are a point.  Equal sets become one *node*.  The same pass counts
   shingles in ``SLOTS`` slots over all documents (the rarity of a shingle is the
   count of its slot).
2. A second pass emits each node's prefix: its n - ceil(0.8 n) + 1 rarest shingles.
   Two linked sets share a shingle of both prefixes, so a prefix shingle is a key
   under which linked nodes meet.  Common passages are last in that order and
   rarely keys.  Keys counted far above the mean are salted.
3. Under each key one node is the center: the one whose prefix is the most common,
   for copies that were changed have shingles of their own there, which the text
   they stem from has not (ties: the smallest node).  Each node is first compared
   with the ``CENTERS`` centers with which it shares most keys (stars, not all
   pairs); these few pairs are verified, and their components found.
4. Pairs of one component need no more work.  Where nodes of several components
   share a key, a packed R-tree over their count vectors finds the rest: overlap
   is at most the sum over coordinates of the smaller count, for tree nodes of the
   smaller maximum.  Pairs of tree nodes that lie below the needed overlap, differ
   too much in size or belong to one component are left out.  Keys with more than
   ``BLOCK`` nodes are joined in blocks, so memory is bounded.
5. What survives must also share enough prefix shingles, and is then verified on
   the sets themselves, computed again from the whole texts.

Links join nodes, and components of both rounds give each document the smallest
doc_id that it reaches.

Defined cases: null and wordless texts have the empty set, link with nothing and
are their own component; fewer than ``WORDS`` words are one shingle; repeated rows
are copies of each other; a null doc_id takes part, but never names a component
unless no other id is there; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.llm.common import packed, small_batches, stash
from leaguespark.llm.components import connected

WORDS = 5
PERCENT = 80
GROUPS = 256
SLOTS = 1 << 20
SLOT_CHUNK = 4096
SALTS = 32
BLOCK = 4096
LEAF = 32
#: Centers that a node is compared with before its keys are searched.
CENTERS = 3
#: Nodes (32 bytes each) that are broadcast to the documents; more are joined by shuffle.
BROADCAST_NODES = 200_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    if len(h) < WORDS:
        mixed = np.array([len(h)], np.uint64)
        for i in range(len(h)):
            mixed += h[i : i + 1] * _ODD[i]
    else:
        n = len(h) - WORDS + 1
        mixed = h[:n] * _ODD[0]
        for i in range(1, WORDS):
            mixed += h[i : i + n] * _ODD[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def prefix_length(n):
    """Shingles of a set of n that a set of similarity PERCENT can't all miss."""
    return n - -(-PERCENT * n // 100) + 1


def _narrowest(counts: np.ndarray) -> np.ndarray:
    return counts.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max(initial=0) <= np.iinfo(t).max))


def _key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), text, doc_id)


def _keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): a row's key follows from its id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    k1, k2 = _key(F.col("doc_id"), F.col("text"))
    return rows.select(k1.alias("k1"), k2.alias("k2"), "doc_id", "text")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents (slot is null), then the slot counts of the partition."""
    names = ["k1", "k2", "doc_id", "n", "digest", "counts", "slot"]
    slots = np.zeros(SLOTS, np.int64)
    for batch in batches:
        n, digests, points, waiting = [], [], [], []
        for text in batch.column(3):
            found = shingles(text.as_py())
            n.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            points.append(_narrowest(np.bincount((found % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)).tobytes())
            waiting.append(found)
        if waiting:
            slots += np.bincount((np.concatenate(waiting) >> np.uint64(20)).astype(np.int64) % SLOTS, minlength=SLOTS)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(points, pa.binary()), pa.nulls(len(n), pa.int32())], names)
    for i in range(0, SLOTS, SLOT_CHUNK):
        part = slots[i : i + SLOT_CHUNK]
        if part.any():
            small = _narrowest(part)
            yield pa.RecordBatch.from_arrays([pa.array([small.itemsize], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([small.tobytes()], pa.binary()), pa.array([i // SLOT_CHUNK], pa.int32())], names)


def _sum_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a slot chunk that the partition holds; rows are added as they come, so memory does not follow their number."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, width, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = totals.setdefault(slot, np.zeros(SLOT_CHUNK, np.int64))
            own += np.frombuffer(counts, f"u{width}")
    small = {slot: _narrowest(total.astype(np.uint64)) for slot, total in totals.items()}
    yield pa.RecordBatch.from_arrays([pa.array(list(small), pa.int32()), pa.array([x.itemsize for x in small.values()], pa.int64()), pa.array([x.tobytes() for x in small.values()], pa.binary())], ["slot", "k1", "counts"])


def slot_counts(measured: DataFrame) -> np.ndarray:
    """Shingles of all documents by slot; SLOTS numbers whatever the input.

    Rows of a slot are first summed where they lie in ``SALTS`` parts, then together.
    """
    rows = measured.filter("slot IS NOT NULL").select("slot", "k1", "counts")
    for salted in (True, False):
        dealt = rows.repartition("slot", F.pmod(F.xxhash64("counts"), F.lit(SALTS))) if salted else rows.repartition("slot")
        rows = dealt.select("slot", "k1", "counts").mapInArrow(_sum_slots, "slot int, k1 long, counts binary")
    total = np.zeros(SLOTS, np.int64)
    for row in rows.collect():  # one row a slot chunk, SLOTS / SLOT_CHUNK in all
        total[row.slot * SLOT_CHUNK : (row.slot + 1) * SLOT_CHUNK] = np.frombuffer(row.counts, f"u{row.k1}")
    return total


def _prefixes(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """(digest, n, weight, tokens, hot): each set's rarest shingles, how common these are, and which of them are hot keys; equal sets once a task."""
    hot_from = 8 * slots.mean() + 4096
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(slots, (1 << 32) - 1).astype(np.uint32))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            digests, sizes, weights, tokens, hot = [], [], [], [], []
            for text in batch.column(0):
                found = shingles(text.as_py())
                digest = xxhash.xxh3_128_digest(found.tobytes())
                if not len(found) or digest in seen:
                    continue
                seen.add(digest)
                rarity = shared.value[(found >> np.uint64(20)).astype(np.int64) % SLOTS]
                first = np.argsort(rarity, kind="stable")[: prefix_length(len(found))]  # ties by hash
                digests.append(digest)
                sizes.append(len(found))
                weights.append(int(1000 * np.log2(1.0 + rarity[first]).mean()))
                tokens.append(found[first].astype(np.int64))
                hot.append(rarity[first] > hot_from)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(weights, pa.int32()), pa.array(tokens, pa.list_(pa.int64())), pa.array(hot, pa.list_(pa.bool_()))], ["digest", "n", "weight", "tokens", "hot"])

    return docs.select(F.col("text").cast("string")).mapInArrow(emit, "digest binary, n long, weight int, tokens array<long>, hot array<boolean>")


def needed_overlap(a, b):
    """Least intersection of two sets of sizes a and b that link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


class CountVectorTree:
    """A packed R-tree over points of group counts, joined with itself or with another one."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, components: np.ndarray) -> None:
        # Sort-tile packing on the coordinates that vary most, after the size.
        order = np.lexsort((*(points[:, g] for g in np.argsort(points.var(0))[-2:]), sizes // 64))
        self.order = order
        self.points, self.sizes, self.components = points[order], sizes[order], components[order]
        self.levels = [self._pack(self.points, self.sizes, self.sizes, self.components, self.components)]
        while len(self.levels[-1][0]) > LEAF:
            self.levels.append(self._pack(*self.levels[-1]))

    @staticmethod
    def _pack(most, low, high, first, last):
        at = np.arange(0, len(low), LEAF)
        return np.maximum.reduceat(most, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)

    @staticmethod
    def _may_link(a, b):
        """Which of the tree nodes a and b can hold a pair that links; rows by columns."""
        (most_a, low_a, high_a, first_a, last_a), (most_b, low_b, high_b, first_b, last_b) = a, b
        sized = (100 * high_a[:, None] >= PERCENT * low_b) & (100 * high_b >= PERCENT * low_a[:, None])
        apart = (first_a[:, None] != last_b) | (last_a[:, None] != first_b)
        rows, columns = np.nonzero(sized & apart)
        keep = np.minimum(most_a[rows], most_b[columns]).sum(1) >= needed_overlap(low_a[rows], low_b[columns])
        return rows[keep], columns[keep]

    def join(self, other: CountVectorTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (in the given order) of the pairs that pass all bounds; each pair of a tree with itself once."""
        own = other is self
        top = lambda tree: (len(tree.levels), slice(0, len(tree.levels[-1][1])))
        todo = [(*top(self), *top(other))]
        while todo:
            i, mine, j, theirs = todo.pop()
            rows, columns = self._may_link([x[mine] for x in self._level(i)], [x[theirs] for x in other._level(j)])
            rows, columns = rows + mine.start, columns + theirs.start
            if own:
                keep = rows <= columns if i else rows < columns
                rows, columns = rows[keep], columns[keep]
            if i == 0 and j == 0:
                yield self.order[rows], other.order[columns]
            else:
                todo += [(*self._below(i, int(r)), *other._below(j, int(c))) for r, c in zip(rows, columns, strict=True)]

    def _level(self, i: int):
        return self.levels[i - 1] if i else (self.points, self.sizes, self.sizes, self.components, self.components)

    def _below(self, i: int, entry: int) -> tuple[int, slice]:
        """The level and the entries below an entry of level i; a point is its own."""
        if i == 0:
            return 0, slice(entry, entry + 1)
        return i - 1, slice(entry * LEAF, min(len(self._level(i - 1)[1]), (entry + 1) * LEAF))


def _rest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of different components that share a key and pass the bounds; rows come sorted by key."""

    def pairs(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys = np.stack([rows["token"], rows["i"], rows["j"]], 1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        ends = np.r_[starts[1:], len(keys)]
        points = rows["points"]
        size = ends - starts
        for k in np.unique(size[(size > 1) & (size <= LEAF)]):  # all groups of one small size at once
            at = starts[size == k]
            left, right = np.triu_indices(k, 1)
            a, b = (at[:, None] + left).ravel(), (at[:, None] + right).ravel()
            keep = rows["component"][a] != rows["component"][b]
            a, b = a[keep], b[keep]
            na, nb = rows["n"][a], rows["n"][b]
            keep = (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)) & ((rows["i"][a] == rows["j"][a]) | (rows["own"][a] != rows["own"][b]))
            a, b = a[keep], b[keep]
            for part in range(0, len(a), 50_000):
                x, y = a[part : part + 50_000], b[part : part + 50_000]
                keep = np.minimum(points[x], points[y]).sum(1) >= needed_overlap(rows["n"][x], rows["n"][y])
                yield x[keep], y[keep]
        for start, end in zip(starts[size > LEAF], ends[size > LEAF], strict=True):
            own = np.arange(start, end)
            tree = lambda at: CountVectorTree(points[at], rows["n"][at], rows["component"][at])
            if rows["i"][start] == rows["j"][start]:
                t = tree(own)
                for x, y in t.join(t):
                    yield own[x], own[y]
            else:
                left, right = own[rows["own"][own] == rows["i"][start]], own[rows["own"][own] == rows["j"][start]]
                if len(left) and len(right):
                    for x, y in tree(left).join(tree(right)):
                        yield left[x], right[y]

    def columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("token", "i", "j", "own", "node", "component", "n")}
        # A point's numbers are as wide as its largest one needs.
        out["points"] = np.array([np.frombuffer(raw, f"u{len(raw) // GROUPS}") for raw in batch.column("counts").to_pylist()], np.int64).astype(np.int32)
        return out

    def flush(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, b in pairs(rows):
            x, y = rows["node"][a], rows["node"][b]
            low, high = np.where(x < y, a, b), np.where(x < y, b, a)
            for part in range(0, len(a), 50_000):
                p, q = low[part : part + 50_000], high[part : part + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(rows["node"][p]), pa.array(rows["node"][q]), pa.array(rows["n"][p]), pa.array(rows["n"][q])], ["a", "b", "na", "nb"])

    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        new = columns(batch)
        held = {k: np.concatenate([held[k], new[k]]) for k in new} if held else new
        last = np.stack([held["token"], held["i"], held["j"]], 1)
        cut = int(np.flatnonzero((last != last[-1]).any(1))[-1]) + 1 if (last != last[-1]).any() else 0
        if cut:  # the last key may go on in the next batch
            yield from flush({k: v[:cut] for k, v in held.items()})
            held = {k: v[cut:] for k, v in held.items()}
    if held:
        yield from flush(held)


def _least_shared(na: Column, nb: Column) -> Column:
    """Shingles that both prefixes of a linked pair share: of the needed overlap, all but one set's shingles after its prefix."""
    after = lambda n: F.ceil(n * PERCENT / 100) - 1
    return F.ceil((na + nb) * PERCENT / (100 + PERCENT)) - F.greatest(after(na), after(nb))


def _texts(keyed: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the nodes of some pairs; the texts are shuffled only if these are many."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.join(nodes, "node", "left_semi").select("node", F.col("key.k1").alias("w1"), F.col("key.k2").alias("w2"))
    few = wanted.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    found = keyed.join(F.broadcast(wanted) if few else wanted, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))).select("node", "text")
    return stash(found).dropDuplicates(["node"])


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if last[0] != a:
                    last = a, shingles(left.as_py())
                x, y = last[1], shingles(right.as_py())
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def _placed(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, its key (k1, k2), n, component (null without words) and component_id."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs)
    measured = stash(keyed.mapInArrow(_measure, "k1 long, k2 long, doc_id long, n long, digest binary, counts binary, slot int"))
    slots = slot_counts(measured)
    rows = measured.filter("slot IS NULL").drop("slot")

    seed = 0
    while True:  # nodes are numbers; another seed, should two digests ever share one
        node = F.xxhash64(F.lit(seed), "digest")
        classes = stash(
            rows.filter("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("k1", "k2")).alias("key"), F.min("counts").alias("counts")).withColumn("node", node)
        )
        if classes.groupBy("node").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
            break
        seed += 1

    # Keys: prefix shingles, salted where hot.
    prefixes = _prefixes(docs, slots).select(node.alias("node"), "n", "weight", F.explode(F.arrays_zip("tokens", "hot")).alias("x"))
    salt = F.when(F.col("x.hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS)) + 1).otherwise(0).cast("int")
    keys = prefixes.select(F.col("x.tokens").alias("token"), salt.alias("salt"), "node", "n", "weight")
    together = Window.partitionBy("token", "salt")
    shared = keys.withColumns({"center": F.min(F.struct((-F.col("weight")).alias("light"), "node", "n")).over(together), "low": F.min("node").over(together), "high": F.max("node").over(together)}).filter("salt > 0 OR low <> high")
    shared = stash(shared.select("token", "salt", "node", "n", F.col("center.node").alias("center"), F.col("center.n").alias("center_n"), F.col("center.light").alias("light")).distinct())
    # The salts' centers of a hot key meet at its own.
    centers = shared.filter("salt > 0").select("token", "center", "center_n", "light").distinct()
    tops = centers.withColumn("top", F.min(F.struct("light", "center", "center_n")).over(Window.partitionBy("token")))
    stars = shared.select(F.col("center").alias("a"), F.col("center_n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb"))
    stars = stars.unionByName(tops.select(F.col("top.center").alias("a"), F.col("top.center_n").alias("na"), F.col("center").alias("b"), F.col("center_n").alias("nb")))
    stars = stars.filter("a <> b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
    # A node tries the centers with which it shares most keys, if it is a good part of
    # what a link needs; step 4 handles what these leave open.
    best = Window.partitionBy("b").orderBy(F.col("s").desc(), "a")
    stars = stars.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("s")).filter(F.col("s") * 4 >= _least_shared(F.col("na"), F.col("nb")))
    stars = stash(stars.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= CENTERS).select("a", "b"))

    links = stash(_verify(stars, _texts(keyed, classes, stars)))
    tied = connected(links)

    # Keys that still hold several components.
    component = F.coalesce("component", "node")
    placed = shared.join(tied.withColumnRenamed("node", "t_node"), F.col("node") == F.col("t_node"), "left").select("token", "node", "n", component.alias("component")).distinct()
    by_token = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held")).filter("low <> high")
    mixed = placed.join(by_token.select(F.col("token").alias("m_token"), "held"), F.col("token") == F.col("m_token"))
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    mixed = mixed.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    mixed = mixed.withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    points = classes.select(F.col("node").alias("p_node"), "counts")
    pointed = mixed.join(points, F.col("node") == F.col("p_node")).select("token", F.least("own", "peer").alias("i"), F.greatest("own", "peer").alias("j"), "own", "node", "component", "n", "counts")
    dealt = pointed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    rest = dealt.mapInArrow(_rest_pairs, "a long, b long, na long, nb long").groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("s"))
    rest = stash(rest.filter(F.col("s") >= _least_shared(F.col("na"), F.col("nb"))).select("a", "b"))
    more = stash(_verify(rest, _texts(keyed, classes, rest)))
    if not more.isEmpty():
        tied = connected(tied.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    named = classes.select("node", "digest", "doc_id").join(tied.withColumnRenamed("node", "t_node"), F.col("node") == F.col("t_node"), "left").select("node", "digest", "doc_id", component.alias("component"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "c_component")
    named = named.join(names, F.col("component") == F.col("c_component")).select(F.col("digest").alias("c_digest"), "component", "component_id")
    out = rows.select("doc_id", "k1", "k2", "n", "digest").join(named, F.col("digest") == F.col("c_digest"), "left")
    return out.select("doc_id", "k1", "k2", "n", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    return _placed(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, unchanged: the one with the smallest id (null last; ties by key); rows without words stay."""
    rows = stash(_placed(docs).filter("component IS NOT NULL").select("doc_id", "k1", "k2", "component"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("first")
    stays = stash(rows.groupBy("component").agg(first).select("first.k1", "first.k2"))
    key = ["k1", "k2"]
    gone = stash(rows.join(stays, key, "left_anti").select(*key).distinct())
    repeated = stash(rows.join(stays, key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    k1, k2 = _key(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kept = packed(docs, k1=k1, k2=k2).join(gone, key, "left_anti")
    if not repeated.isEmpty():  # rows that repeat both id and text
        kept = kept.join(repeated, key, "left_anti").unionByName(kept.join(repeated, key, "left_semi").dropDuplicates(key))
    return kept.select("row.*")
