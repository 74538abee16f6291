"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark windows.

A window is a run of ``WINDOW`` consecutive words of an item (a shorter item is
one window).  Document words inside any occurrence of a window are hit.

1. The words of the windows are counted over *all* documents and ordered by that
   rarity.  A window lies in a document only if all its words do, so for
   containment the necessary prefix is its single rarest word.
2. Document words are joined with these prefix words.  A match at position p with
   the word at offset o of a window of n words leaves one place, p - o, which must
   pass the bounds 0 <= p - o and p - o + n <= words of the document.
3. The words of that place are compared with the window, so the result is exact.

The benchmark's windows go to the tasks in blocks of at most ``BLOCK_BYTES``, each
broadcast by itself.  The documents are read twice whatever the benchmark's size:
once to count words, once to find hits; where there are several blocks, a task takes
``TOGETHER`` bytes of texts through them one after the other and holds one block at a
time.  Documents are never shuffled or rewritten.

Defined cases: null and wordless texts have no words and no hits; items without
words (null or empty texts) have no windows; an item repeated under several ids counts once for each
id; equal ids count once, and all null ids as one empty id; documents may repeat
(each row is answered); an empty benchmark hits nothing; existing columns
``__n_words``, ``__hits`` and ``__item_ids`` are replaced, others kept, never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.llm.common import gathered, packed, release, small_batches, stash

WINDOW = 10
BLOCK_BYTES = 32 << 20
#: Bytes of texts that go through the blocks at once, where there are several.
TOGETHER = 64 << 20
#: Different words that a task counts before it hands them on.
COUNTED = 200_000

#: Bytes of words: digits, lower-cased letters and all of UTF-8 beyond ASCII; the rest part words.
_WORD = bytes((b + 32 if 65 <= b <= 90 else b) if re.match(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", bytes([b])) else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id string, window binary), each pair once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = windows_of(words_of(text), size)
                ids += [item] * len(found)
                windows += found
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], ["item_id", "window"])

    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, "item_id string, window binary").distinct()


def word_counts(docs: DataFrame, windows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(word, n): how often each word of the windows stands in the documents, if it does."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(list({w for window in batch.column(0).to_pylist() for w in window.split(b" ")}), pa.binary())], ["word"])

    vocabulary = stash(windows.select("window").mapInArrow(split, "word binary").distinct())
    bounded = vocabulary.agg(F.coalesce(F.sum(F.length("word") + 100), F.lit(0))).first()[0] <= block_bytes
    # A vocabulary of any size: all words are counted, and joined with it.
    known = docs.sparkSession.sparkContext.broadcast(frozenset(bytes(r.word) for r in vocabulary.toLocalIterator()) if bounded else None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, keep = Counter(), known.value.__contains__ if known.value is not None else None

        def full() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update(filter(keep, words_of(text.as_py())) if keep else words_of(text.as_py()))
            if len(seen) > COUNTED:
                yield full()
                seen.clear()
        yield full()

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stash(counts if bounded else counts.join(vocabulary, "word", "left_semi"))


class WindowIndex:
    """Windows by their rarest word: word -> [(offset, words, items)]."""

    def __init__(self, windows: dict[bytes, list[str]], counts: dict[bytes, int]) -> None:
        self.by_word: dict[bytes, list[tuple[int, list[bytes], list[str]]]] = {}
        for window, items in windows.items():
            words = window.split(b" ")
            offset = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
            self.by_word.setdefault(words[offset], []).append((offset, words, items))

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words, in the order of their prefix words, and the items that occur."""
        ranges, found, by_word, total = [], set(), self.by_word, len(words)
        for p in [p for p, word in enumerate(words) if word in by_word]:
            for offset, window, items in by_word[words[p]]:
                start, end = p - offset, p - offset + len(window)
                if start >= 0 and end <= total and words[start:end] == window:
                    ranges.append((start, end))
                    found.update(items)
        return ranges, found


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as disjoint ranges."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(spark: SparkSession, items: DataFrame, size: int, block_bytes: int) -> list[DataFrame]:
    windows = stash(item_windows(items, size))
    total = windows.agg(F.coalesce(F.sum(F.length("window") + F.length(F.coalesce("item_id", F.lit(""))) + 200), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    if n == 1:
        return [windows]
    return [windows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == i) for i in range(n)]


def _indexes(docs: DataFrame, blocks: list[DataFrame], block_bytes: int) -> Iterator[WindowIndex]:
    """One index a block; the driver holds one block at a time."""
    counts = None
    for block in blocks:
        windows: dict[bytes, list[str]] = {}
        for row in block.toLocalIterator():  # a block, of bounded size
            windows.setdefault(bytes(row.window), []).append(row.item_id or "")
        if not windows:
            continue
        if counts is None:
            every = blocks[0]
            for other in blocks[1:]:
                every = every.unionByName(other)
            counts = word_counts(docs, every, block_bytes)
        words = {w for window in windows for w in window.split(b" ")}
        yield WindowIndex(windows, {word: r.n for r in counts.toLocalIterator() if (word := bytes(r.word)) in words})


def find_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents' columns, and __n_words, __hits (disjoint ranges, start and end flattened) and __item_ids (sorted)."""
    spark = docs.sparkSession
    small_batches(spark)
    new = {"__n_words": "long", "__hits": "array<int>", "__item_ids": "array<string>"}
    docs = docs.drop(*new)
    parts = []
    for index in _indexes(docs, _blocks(spark, items, size, block_bytes), block_bytes):
        parts.append(spark.sparkContext.broadcast(index))
        release(parts[-1])
    names = docs.columns

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = names.index("text")
        for group in gathered(batches, TOGETHER if len(parts) > 1 else 0):
            texts = [text for batch in group for text in batch.column(at_text)]
            n_words, hits, ids = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
            for part in parts or [None]:
                for i, text in enumerate(texts):
                    words = words_of(text.as_py())
                    n_words[i] = len(words)
                    if part is not None:
                        ranges, found = part.value.hits(words)
                        hits[i] += ranges
                        ids[i] |= found
                if len(parts) > 1:
                    release(part)
            at = 0
            for batch in group:
                own = slice(at, at := at + batch.num_rows)
                columns = [pa.array(n_words[own], pa.int64()), pa.array([[x for r in covered(h) for x in r] for h in hits[own]], pa.list_(pa.int32())), pa.array(list(map(sorted, ids[own])), pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *new])

    return docs.mapInArrow(probe, docs.limit(0).withColumns({name: F.lit(None).cast(kind) for name, kind in new.items()}).schema)


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window of any item occurs, unchanged."""
    held = packed(docs, text=F.col("text").cast("string"))
    return find_hits(held, items, size).filter(F.size("__hits") == 0).select("row.*")
