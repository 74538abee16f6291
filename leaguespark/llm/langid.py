"""Language identification by interpolated Kneser-Ney character models.

Every language has a character model of ``ORDER`` symbols.  A symbol is one byte:
0 for a run of characters that are no letters, 1 to 26 for a to z (lower-cased),
and ``27 + code point mod 229`` for other letters, so an n-gram is a whole number
of at most 32 bits and serves as its own hash.  N-grams are counted over all
labelled training texts, per task first; a language's arrays hold its sorted n-gram
hashes with their discounted probabilities and its sorted contexts with their
back-off weights.  Lower orders use continuation counts, discounts are
n1 / (n1 + 2 n2), and the lowest order is interpolated with the uniform
distribution over the 256 symbols.

A text gets the language with the lowest cross-entropy per symbol (ties: the
smaller language tag).  Rejection is calibrated on the counts themselves: they
give the mean H and variance V of the surprise of a symbol under its own model,
over the whole training corpus; a text of n symbols is rejected when its
cross-entropy exceeds H * (1 + ``SLACK``) + ``SIGMAS`` * sqrt(V / n).

The models have ``ORDER`` symbols at every size.  Continuation counts, discounts and
the table of all orders are Spark aggregations.  The driver and the tasks take that
table by parts: some whole languages, or one language for a range of the two symbols
before the last one, on which all its terms and weights of three or four symbols
hang.  A part is broadcast by itself and has at most about ``PART_CELLS`` n-grams
times languages; surprises are sums, so a task adds them up part by part, over
``TOGETHER`` bytes of texts at once.

Defined cases: a null text or one without letters is ``und`` with score 0 and is
rejected; without any labelled training text every text is ``und``; rows without
a language are not learned from; repeated rows count as often as they stand; other
columns are not read.  lang, source and doc_id take no part in a prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import gathered, packed, release, small_batches, stash

ORDER = 4
#: N-grams times languages of one part of the models.
PART_CELLS = 4_000_000
#: Bytes of texts that go through the parts at once, where there are several.
TOGETHER = 32 << 20
#: One more than the largest pair of symbols.
PAIRS = 1 << 16
SLACK = 0.5
SIGMAS = 6.0
#: Symbols of a text that are looked up at once.
CHUNK = 1 << 18
#: A score is the posterior of the language after this many symbols at most.
SCORE_SYMBOLS = 40


class Symbols:
    """Texts as arrays of symbols."""

    def __init__(self) -> None:
        table = np.zeros(0x110000, np.uint8)
        letters = np.array([c for c in range(0x110000) if chr(c).isalpha()])
        table[letters] = 27 + letters % 229
        table[ord("a") : ord("z") + 1] = np.arange(1, 27)
        self.table = table

    def ngrams(self, text: str, order: int) -> np.ndarray:
        """The n-gram that ends at each symbol, as uint32; empty without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.table[points]
        keep = symbols != 0
        if not keep.any():
            return np.empty(0, np.uint32)
        keep[1:] |= symbols[:-1] != 0
        symbols = symbols[keep]
        padded = np.concatenate([np.zeros(order - 1, np.uint32), symbols[int(symbols[0] == 0) :].astype(np.uint32), np.zeros(int(symbols[-1] != 0), np.uint32)])
        n = len(padded) - order + 1
        grams = padded[:n].copy()
        for k in range(1, order):
            grams <<= 8
            grams |= padded[k : k + n]
        return grams


_symbols: Symbols | None = None


def symbols() -> Symbols:
    global _symbols
    if _symbols is None:
        _symbols = Symbols()
    return _symbols


def count_ngrams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}

        def fold(lang: str) -> None:
            grams, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            if lang in sums:
                both, at = np.unique(np.concatenate([sums[lang][0], grams]), return_inverse=True)
                grams, n = both, np.bincount(at, np.concatenate([sums[lang][1], n])).astype(np.int64)
            sums[lang] = grams, n

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                grams = symbols().ngrams(text.as_py(), order)
                waiting.setdefault(lang, []).append(grams)
            for lang in [k for k, v in waiting.items() if sum(map(len, v)) > 2_000_000]:
                fold(lang)
        for lang in list(waiting):
            fold(lang)
        for lang, (grams, n) in sums.items():
            for i in range(0, len(grams), 50_000):
                part = slice(i, i + 50_000)
                yield pa.record_batch([pa.array([lang] * len(grams[part]), pa.string()), pa.array(grams[part].astype(np.int64)), pa.array(n[part].astype(np.int64))], ["lang", "gram", "n"])

    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("text IS NOT NULL AND lang IS NOT NULL")
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _pair(gram):
    """The two symbols before the last one, of an n-gram of three symbols or more."""
    return (gram >> 8) & (PAIRS - 1)


def all_orders(counts: DataFrame, order: int) -> DataFrame:
    """(lang, k, pair, gram, n): the counts of the full order and the continuation counts of the lower ones; pair is null below three symbols."""
    level, levels = counts.select("lang", "gram", "n"), None
    for k in range(order, 0, -1):
        if k < order:  # in how many longer n-grams a shorter one stands
            level = level.groupBy("lang", F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        pair = F.shiftright("gram", 8).bitwiseAND(PAIRS - 1) if k > 2 else F.lit(None)
        rows = level.select("lang", F.lit(k).alias("k"), pair.cast("int").alias("pair"), "gram", "n")
        levels = rows if levels is None else levels.unionByName(rows)
    return levels


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], default)


class KneserNey:
    """One language, or a part of it: for each order sorted n-gram hashes with discounted probabilities, and contexts with back-off weights."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], discounts: list[float]) -> None:
        """Sorted n-grams with their counts, and the language's discounts, from the full order down to one symbol."""
        self.order, self.levels = len(counts), []
        for k, (grams, n), discount in zip(range(self.order, 0, -1), counts, discounts, strict=True):
            contexts, first, size = np.unique(grams >> 8 if k > 1 else np.zeros_like(grams), return_index=True, return_counts=True)
            sums = np.add.reduceat(n, first)
            weight = discount * size / sums
            self.levels.append((grams, (n - discount) / np.repeat(sums, size), contexts, weight))
        grams, n = counts[0]
        surprise = -np.log(self.prob(grams))
        self.symbols = float(n.sum())
        self.mean = float((surprise * n).sum() / self.symbols)
        self.var = float(((surprise - self.mean) ** 2 * n).sum() / self.symbols)

    def prob(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), 1 / 256)
        for k, (keys, term, contexts, weight) in zip(range(1, self.order + 1), reversed(self.levels), strict=True):
            gram = grams & np.uint32((1 << 8 * k) - 1)
            context = gram >> 8 if k > 1 else np.zeros_like(gram)
            p = _find(keys, term, gram, 0.0) + _find(contexts, weight, context, 1.0) * p
        return p


class Part:
    """Models over the sorted union of their n-grams, for pairs from lo to hi - 1; what no language has seen is backed off."""

    def __init__(self, langs: list[int], models: list[KneserNey], lo: int, hi: int) -> None:
        self.langs, self.models, self.lo, self.hi = langs, models, lo, hi
        self.grams = np.unique(np.concatenate([m.levels[0][0] for m in models]))
        self.logs = [-np.log(m.prob(self.grams)).astype(np.float32) for m in models]

    def surprises(self, grams: np.ndarray) -> np.ndarray:
        """The sum over those n-grams that belong to the part, under each of its languages."""
        total = np.zeros(len(self.langs))
        for i in range(0, len(grams), CHUNK):
            part = grams[i : i + CHUNK]
            if (self.lo, self.hi) != (0, PAIRS):
                pair = _pair(part)
                part = part[(pair >= self.lo) & (pair < self.hi)]
            at = np.searchsorted(self.grams, part)
            at[at == len(self.grams)] = 0
            hit = self.grams[at] == part
            if hit.all():
                total += [log[at].sum(dtype=np.float64) for log in self.logs]
            else:
                at, odd = at[hit], part[~hit]
                total += [log[at].sum(dtype=np.float64) - np.log(m.prob(odd)).sum() for log, m in zip(self.logs, self.models, strict=True)]
        return total


class LanguageModels:
    """All languages, as broadcast parts; the symbols, mean and variance of each are kept here."""

    def __init__(self, order: int, langs: list[str], parts: list[Broadcast], moments: list[tuple[float, float, float]]) -> None:
        self.order, self.langs, self.parts, self.moments = order, langs, parts, moments

    @property
    def models(self) -> list[KneserNey]:
        return [m for shared in self.parts for m in shared.value.models]

    @property
    def grams(self) -> np.ndarray:
        return np.unique(np.concatenate([shared.value.grams for shared in self.parts])) if self.parts else np.empty(0, np.uint32)

    def entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text (as Arrow scalars), and its cross-entropy per symbol under each language."""
        sizes, total = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.langs)))
        for shared in self.parts:
            part = shared.value
            for row, text in enumerate(texts):
                grams = symbols().ngrams(text.as_py() or "", self.order)
                sizes[row] = len(grams)
                total[row, part.langs] += part.surprises(grams)
            if len(self.parts) > 1:
                release(shared)
        return sizes, total / np.maximum(1, sizes)[:, None]

    def decide(self, texts: list) -> list[tuple[str, float, float, bool]]:
        """Language, score, cross-entropy and whether rejected, of each text."""
        return [self._decide(int(n), own) for n, own in zip(*self.entropies(texts), strict=True)]

    def _decide(self, n: int, entropies: np.ndarray) -> tuple[str, float, float, bool]:
        if not n:
            return "und", 0.0, float("nan"), True
        best = int(entropies.argmin())
        score = 1 / np.exp((entropies[best] - entropies) * min(n, SCORE_SYMBOLS)).sum()
        _, mean, var = self.moments[best]
        limit = mean * (1 + SLACK) + SIGMAS * math.sqrt(var / n)
        return self.langs[best], float(score), float(entropies[best]), bool(entropies[best] > limit)


def plan_parts(levels: DataFrame, sizes: dict[str, int]) -> Iterator[tuple[list[str], int, int]]:
    """(languages, lo, hi): whole languages together, or a range of pairs of a large one."""
    together: list[str] = []
    for lang in sorted(sizes):
        if together and (sum(map(sizes.get, together)) + sizes[lang]) * (len(together) + 1) > PART_CELLS:
            yield together, 0, PAIRS
            together = []
        if sizes[lang] <= PART_CELLS:
            together.append(lang)
            continue
        own = levels.filter((F.col("lang") == lang) & F.col("pair").isNotNull())
        lo = held = 0
        for row in own.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).orderBy("pair").collect():  # at most PAIRS rows
            if held and held + row.n > PART_CELLS:
                yield [lang], lo, row.pair
                lo, held = row.pair, 0
            held += row.n
        yield [lang], lo, PAIRS
    if together:
        yield together, 0, PAIRS


def _merged(a: tuple[float, float, float], b: tuple[float, float, float]) -> tuple[float, float, float]:
    """Symbols, mean and variance of two parts of a language as one."""
    n = a[0] + b[0]
    mean = (a[0] * a[1] + b[0] * b[1]) / n
    return n, mean, (a[0] * (a[2] + (a[1] - mean) ** 2) + b[0] * (b[2] + (b[1] - mean) ** 2)) / n


def fit(labelled: DataFrame, order: int = ORDER) -> LanguageModels:
    """Models from all rows of (text, lang)."""
    spark = labelled.sparkSession
    small_batches(spark)
    levels = stash(all_orders(stash(count_ngrams(labelled, order)), order).orderBy("lang", "pair"))  # in order, so that a part reads little else
    sizes: dict[str, int] = {}
    discounts: dict[tuple[str, int], float] = {}
    for row in levels.groupBy("lang", "k").agg(F.count(F.lit(1)).alias("grams"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():
        sizes[row.lang] = sizes.get(row.lang, 0) + (row.grams if row.k in (order, 3) else 0)
        discounts[row.lang, row.k] = row.ones / (row.ones + 2 * row.twos) if row.ones and row.twos else 0.5
    langs, parts = sorted(sizes), []
    moments: dict[str, tuple[float, float, float]] = {}
    for own, lo, hi in plan_parts(levels, sizes):
        rows = levels.filter(F.col("lang").isin(own))
        if (lo, hi) != (0, PAIRS):
            rows = rows.filter(F.col("pair").isNull() | ((F.col("pair") >= lo) & (F.col("pair") < hi)))
        found, models = rows.select("lang", "k", "gram", "n").toArrow(), []
        for lang in own:
            counts = []
            for k in range(order, 0, -1):
                level = found.filter((pc.field("lang") == lang) & (pc.field("k") == k))
                by = np.argsort(grams := level["gram"].to_numpy().astype(np.uint32))
                counts.append((grams[by], level["n"].to_numpy()[by].astype(np.float64)))
            models.append(model := KneserNey(counts, [discounts[lang, k] for k in range(order, 0, -1)]))
            new = (model.symbols, model.mean, model.var)
            moments[lang] = _merged(moments[lang], new) if lang in moments else new
        parts.append(spark.sparkContext.broadcast(Part([langs.index(lang) for lang in own], models, lo, hi)))
        release(parts[-1])
    return LanguageModels(order, langs, parts, [moments[lang] for lang in langs])


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """The documents' columns, and __lang, __score, __entropy and __rejected, in place of columns of these names."""
    spark = docs.sparkSession
    small_batches(spark)
    new = {"__lang": "string", "__score": "double", "__entropy": "double", "__rejected": "boolean"}
    docs = docs.drop(*new)
    names = docs.columns
    schema = docs.limit(0).withColumns({k: F.lit(None).cast(t) for k, t in new.items()}).schema

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = names.index("text")
        for group in gathered(batches, TOGETHER if len(models.parts) > 1 else 0):
            found = iter(models.decide([text for batch in group for text in batch.column(at_text)]))
            for batch in group:
                own = [next(found) for _ in range(batch.num_rows)]
                columns = [pa.array([x[i] for x in own], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *new])

    return docs.mapInArrow(decide, schema)


def keep_identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The documents that the models do not reject, unchanged, whatever their columns are named."""
    held = packed(docs, text=F.col("text").cast("string"))
    return identify(held, fit(labelled)).filter("NOT __rejected").select("row.*")
