"""Quality rules as a ledger of failure bits.

``measure`` reads each text once and takes all measurements.  ``ledger`` evaluates
every rule once over them: rule number i that fails sets bit i of ``__failed``.  The
ledger (ids, measurements, bits) is small and can be kept as a table; a policy is a
version of two masks over its bits, so judging by another policy, or by a policy
without one of its rules, never touches a text again.  ``ablate`` counts the patterns
of bits first (one partial aggregation, at most ``2 ** len(RULES)`` rows) and takes
every policy and every left-out rule from those counts by bitwise tests.

A rule number is never used again for another rule; new rules take the next bit.

Defined cases: a null text has no words and fails the rule of few words only; ratios
are compared as products of whole numbers, so nothing is divided by zero; repeated
rows are judged each on their own; columns of a table whose names start with ``__``
and that this module writes are replaced, all others are kept; an empty table has an
empty ledger, and its ablation has no rows.  Texts are taken whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import named, small_batches

MEASURES = ("words", "word_chars", "symbols", "lines", "dup_lines", "repeat_words", "capitals", "shouts")
#: Words of a window that must not be found twice.
WINDOW = 8
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_MIX = np.uint64(0x9E3779B97F4A7C15)

#: Rules by bit: name and the condition under which a text fails, over the measurements.
RULES = (
    ("few_words", "__words < 20"),
    ("repeated_windows", "100 * __repeat_words > 30 * __words"),
    ("long_words", "__word_chars > 15 * __words"),
    ("symbols", "5 * __symbols > __words"),
    ("dup_lines", "100 * __dup_lines > 30 * __lines"),
    ("shouts", "5 * __shouts > __words"),
    ("capitals", "2 * __capitals > __word_chars"),
)


def mask(*names: str) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[n] for n in set(names))


@dataclass(frozen=True)
class Policy:
    """A text goes if it fails one of the ``hard`` rules or at least ``limit`` of the ``soft`` ones."""

    name: str
    version: int
    hard: int
    soft: int = 0
    limit: int = 1

    def keeps(self, failed: Column, without: int = 0) -> Column:
        hard, soft = self.hard & ~without, self.soft & ~without
        return (failed.bitwiseAND(hard) == 0) & (F.bit_count(failed.bitwiseAND(soft)) < self.limit)


BASE = mask("few_words", "repeated_windows")
POLICIES = (
    Policy("quality", 1, BASE),
    Policy("quality", 2, BASE | mask("symbols", "shouts")),
    Policy("quality", 3, BASE | mask("symbols", "shouts"), mask("long_words", "dup_lines", "capitals"), 2),
)
CURRENT = POLICIES[-1]


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more, the first time included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed = (mixed + ids[i : i + n]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    # Equal hashes only propose windows; their words decide.
    places: dict[tuple[bytes, ...], list[int]] = {}
    for at in np.union1d(order[1:][same], order[:-1][same]).tolist():
        places.setdefault(tuple(words[at : at + WINDOW]), []).append(at)
    inside = np.zeros(len(words) + 1, np.int64)
    for found in places.values():
        if len(found) > 1:
            np.add.at(inside, found, 1)
            np.add.at(inside, [at + WINDOW for at in found], -1)
    return int((np.cumsum(inside) > 0).sum())


def measurements(text: str | None) -> tuple[int, ...]:
    """In the order of MEASURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    share = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    return (len(words), len(text) - share(_SPACE), share(_SYMBOLS), len(lines), len(lines) - len(set(lines)), repeat_words(words), share(_CAPITALS), raw.count(b"!"))


def measure(docs: DataFrame) -> DataFrame:
    """The columns but the text, and the measurements as ``__<measure>``."""
    small_batches(docs.sparkSession)
    new = [f"__{m}" for m in MEASURES]
    names = [c for c in docs.columns if c not in (*new, "text", "__failed")]
    schema = docs.select(*map(named, names)).schema
    for c in new:
        schema = schema.add(c, "long")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measurements(t.as_py()) for t in batch.column(len(names))]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], names=[*names, *new])

    return docs.select(*map(named, names), F.col("text").cast("string")).mapInArrow(apply, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``__failed``, the bits of the rules that fail."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, condition) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("__failed", failed)


def judge(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with ``__kept``."""
    return rows.withColumn("__kept", policy.keeps(F.col("__failed")))


def ablate(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES, by: str | None = None) -> DataFrame:
    """For each policy and each of its rules: rows, rows kept, rows that fail the rule, rows kept without it.

    With ``by`` for each value of a column, null included, as ``group``; ``failed_by_any``
    and ``failed_by_all`` are the bits that some or all rows of the group have.
    """
    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    patterns = rows.groupBy(group.alias("group"), F.col("__failed").alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    cases = [(p, i) for p in policies for i in range(len(RULES)) if (p.hard | p.soft) >> i & 1]
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0)))
    sums = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(RULES[i][0]).alias("rule"), count(p.keeps(F.col("failed"))).alias("kept"), count(F.col("failed").bitwiseAND(1 << i) != 0).alias("failing"), count(p.keeps(F.col("failed"), 1 << i)).alias("kept_without")) for p, i in cases]
    summed = patterns.groupBy("group").agg(F.sum("n").alias("n"), F.bit_or("failed").alias("failed_by_any"), F.bit_and("failed").alias("failed_by_all"), F.array(*sums).alias("cases"))
    return summed.select("group", "n", "failed_by_any", "failed_by_all", F.explode("cases").alias("case")).select("group", "n", "failed_by_any", "failed_by_all", "case.*")
