"""Periodic runs of words, by block matching.

A run is a stretch of consecutive words with smallest period q, at least
``max(MIN_WORDS, 2 q)`` long, that neither neighbour extends.  Its words agree with
those q places later over ``length - q`` words, so for the largest power of two L
with ``2 L - 1 <= max(MIN_WORDS, 2 q) - q`` one block of L words that starts at a
multiple of L lies inside, together with its repetition q words later.  Each block
length thus has its own distances.  The distinct aligned blocks of a length are keys
of one Aho-Corasick automaton over word numbers, which finds every place where one
of them occurs; two occurrences at a distance that belongs to the length are a seed,
and the words around a seed are compared one by one in both directions.  Stretches
with the same ends are one run, with the smallest of their periods.

Blocks are keys only if each of their four-word windows is repeated in the text (a
hash tells; equal windows have equal hashes), as all of a run's seeds are.  Seeds
that lie in a run already found whose period divides their distance say nothing new
and are left out, and so are seeds inside a stretch of the same distance.  The key of
a block of more than ``KEY_WORDS`` words is its first ``KEY_WORDS``: the automaton
stays small, it may give more seeds, and the extension compares every word anyway.

Defined cases: a null or empty text has no words and no runs; fewer than
``MIN_WORDS`` words have none; words part at ASCII white space and count as they
stand, in any script; repeated rows are found each on their own; all columns are
kept, those named ``__runs`` or ``__collapsed`` are replaced.  Texts are taken whole;
one text, its word numbers and the blocks of one length are in memory at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import named, small_batches

MIN_WORDS = 12
#: Words of a block that make its key, at most.
KEY_WORDS = 64
#: Words of the windows that must be repeated.
WINDOW = 4
#: Fixed value: an odd multiplier that mixes word numbers into window hashes.
MIX = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def scales(longest: int, least: int = MIN_WORDS) -> dict[int, list[tuple[int, int]]]:
    """Block length -> ranges of distances (both ends included) up to ``longest``."""
    found: dict[int, list[tuple[int, int]]] = {}
    q = 1
    while q <= longest:
        block = 1 << (((max(least, 2 * q) - q + 1) // 2).bit_length() - 1)
        # Up to here the block length is the same: beyond 2 q = least it holds until q + 1 reaches 4 blocks.
        last = min(longest, 4 * block - 2) if 2 * q >= least else q
        ranges = found.setdefault(block, [])
        if ranges and ranges[-1][1] == q - 1:
            ranges[-1] = (ranges[-1][0], last)
        else:
            ranges.append((q, last))
        q = last + 1
    return found


def repeated_windows(words: np.ndarray) -> np.ndarray:
    """For each place whether the window of WINDOW words there stands in the text again (or seems to)."""
    mixed = np.zeros(len(words) - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        mixed = (mixed + words[i : i + len(mixed)].astype(np.uint64)) * MIX
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    out = np.zeros(len(mixed), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def occurrences(words: tuple[int, ...], starts: list[int], block: int) -> list[tuple[list[int], list[int]]]:
    """For each distinct key at the given starts: those starts, and all places where it occurs."""
    size = min(block, KEY_WORDS)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    found: list[tuple[list[int], list[int]]] = []
    for at in starts:
        key = words[at : at + size]
        entry = automaton.get(key, None)
        if entry is None:
            found.append(entry := ([], []))
            automaton.add_word(key, entry)
        entry[0].append(at)
    automaton.make_automaton()
    for end, entry in automaton.iter(words):
        entry[1].append(end - size + 1)
    return found


def seeds(found: list[tuple[list[int], list[int]]], ranges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) for aligned starts and later occurrences of their block at the given distances."""
    places, distances = [], []
    for starts, all_at in found:
        if len(all_at) < 2:
            continue
        at, places_of = np.asarray(starts), np.asarray(all_at)
        for low, high in ranges:
            first, last = np.searchsorted(places_of, at + low), np.searchsorted(places_of, at + high, "right")
            n = last - first
            if n.any():
                b = np.repeat(at, n)
                partner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                places.append(b)
                distances.append(places_of[partner] - b)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(distances)


def _forward(words: np.ndarray, i: int, j: int) -> int:
    """The first place from i on where the words differ from those from j on; j > i."""
    step = 64
    while j < len(words):
        m = min(step, len(words) - j)
        differ = words[i : i + m] != words[j : j + m]
        if differ.any():
            return i + int(differ.argmax())
        i, j, step = i + m, j + m, 2 * step
    return i


def _backward(words: np.ndarray, i: int, j: int) -> int:
    """The first place such that from there up to i the words equal those up to j."""
    step = 64
    while i > 0:
        m = min(step, i)
        differ = (words[i - m : i] != words[j - m : j])[::-1]
        if differ.any():
            return i - int(differ.argmax())
        i, j, step = i - m, j - m, 2 * step
    return 0


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start, then period."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    numbers: dict = {}
    values = tuple([numbers.setdefault(w, len(numbers)) for w in words])
    if len(numbers) == n:
        return []
    ids = np.array(values, np.int64)
    repeated = repeated_windows(ids)
    if not repeated.any():
        return []
    # Windows that are repeated, up to each place: a block counts if all windows in it are.
    sums = np.concatenate([[0], np.cumsum(repeated)])
    period_of: dict[tuple[int, int], int] = {}
    cover_end, cover_period = np.zeros(n, np.int64), np.ones(n, np.int64)
    for block, ranges in sorted(scales(n // 2).items()):
        aligned = np.arange(0, n - max(block, WINDOW) + 1, block)
        inner = max(1, block - WINDOW + 1)
        # A block of a known run of a shorter period occurs at that period's multiples only, as far as the run reaches.
        known = (cover_end[aligned] >= aligned + ranges[-1][1] + block) & (2 * cover_period[aligned] <= min(block, KEY_WORDS))
        aligned = aligned[(sums[aligned + inner] - sums[aligned] == inner) & ~known]
        if not len(aligned):
            continue
        at, q = seeds(occurrences(values, aligned.tolist(), block), ranges)
        same = min(block, KEY_WORDS)
        fresh = (cover_end[at] < at + q + same) | (q % cover_period[at] != 0)
        order = np.lexsort((at[fresh], q[fresh]))
        before, until = 0, 0
        for b, d in zip(at[fresh][order].tolist(), q[fresh][order].tolist(), strict=True):
            if d == before and b < until:
                continue
            until = _forward(ids, b + same, b + d + same)
            start, end, before = _backward(ids, b, b + d), until + d, d
            if end - start >= max(MIN_WORDS, 2 * d) and period_of.get((start, end), n) > d:
                period_of[start, end] = d
                wider = (cover_end[start:end] < end) | ((cover_end[start:end] == end) & (cover_period[start:end] > d))
                cover_end[start:end][wider] = end
                cover_period[start:end][wider] = d
    return sorted((start, end - start, d) for (start, end), d in period_of.items())


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(edges).tolist(), strict=False) if not inside]


def detect(docs: DataFrame) -> DataFrame:
    """The documents with ``__runs`` and ``__collapsed``, the text of the words that are kept."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("__runs", "__collapsed")]
    place = names.index("text")
    schema = docs.select(*map(named, names), F.lit(None).cast(RUNS).alias("__runs"), F.lit(None).cast("string").alias("__collapsed")).schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for text in batch.column(place):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                runs = find_runs(words)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(collapse(words, runs)))
            columns = [*batch.columns, pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "__runs", "__collapsed"])

    return docs.select(*map(named, names)).mapInArrow(apply, schema)
