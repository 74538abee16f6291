"""Document quality by regularised quadratic discriminant analysis.

A text becomes ``len(FEATURES)`` transformed statistics (logarithms of lengths and
ratios of its characters, words and lines).  Each class is a normal distribution
with its own mean and covariance.  Means and covariances come from sums and sums
of products over *all* labelled rows, taken by one Spark aggregation.  After
scaling by the pooled deviations, a class covariance is shrunk towards the pooled
one and towards the identity by ``SHRINK`` (and more with few rows), which keeps
it positive definite; its Cholesky factor is computed once and kept.  The score is

    sigmoid((log density of class 1 - log density of class 0) * TEMPERATURE + log prior odds)

where the Mahalanobis distances come from the factors' inverses, taken once as well.

Defined cases: null and empty texts have all statistics 0 and are scored like any
other; null labels are not learned from; with labels of one class only the score
is that class, without labels 0; repeated rows count as often as they stand;
labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import named, small_batches

SHRINK = 0.02
RIDGE = 0.02
TEMPERATURE = 0.5
FEATURES = ("chars", "word_length", "upper", "digits", "symbols", "marks", "distinct", "repeats", "top_word", "lines", "copied_lines", "ends")

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:!?'\"()-"
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _MARKS)


def statistics_of(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(raw)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    most = Counter(words).most_common(1)[0][1]
    return [
        math.log1p(len(text)),
        math.log(len(text) / n),
        math.sqrt(share(_UPPER)),
        math.sqrt(share(_DIGITS)),
        math.sqrt(share(_SYMBOLS)),
        math.sqrt(share(_MARKS)),
        len(set(words)) / n * math.log1p(n),
        math.sqrt(sum(map(bytes.__eq__, words[1:], words[:-1])) / n),
        math.sqrt(most / n),
        math.sqrt(len(lines) / n),
        math.sqrt(1 - len(set(lines)) / len(lines)),
        math.sqrt(sum(map(raw.count, (b".", b"!", b"?"))) / n),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """The documents' columns but the text, and one column for each statistic, named ``__q_*``, in place of columns of these names."""
    small_batches(docs.sparkSession)
    new = [f"__q_{f}" for f in FEATURES]
    names = [c for c in docs.columns if c not in ("text", *new)]
    schema = docs.limit(0).select(*map(named, names), *[F.lit(None).cast("double").alias(c) for c in new]).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics_of(t.as_py()) for t in batch.column(len(names))]).reshape(-1, len(new))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *[pa.array(rows[:, i]) for i in range(len(new))]], [*names, *new])

    return docs.select(*map(named, names), "text").mapInArrow(measure, schema)


class QuadraticDiscriminant:
    """Class means and Cholesky factors from counts, sums and sums of products."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> None:
        self.classes = sorted(moments)
        if len(self.classes) < 2:
            return
        total = sum(m[0] for m in moments.values())
        center = sum(m[1] for m in moments.values()) / total
        within = sum(m[2] - np.outer(m[1], m[1]) / m[0] for m in moments.values()) / total
        spread = np.diag(sum(m[2] for m in moments.values()) / total - np.outer(center, center))
        self.center, self.scale = center, np.sqrt(np.maximum(spread, 1e-9))
        pooled = within / np.outer(self.scale, self.scale)
        eye, d = np.eye(len(center)), len(center)
        self.means, self.factors, self.logdets, self.priors = [], [], [], []
        for k in self.classes:
            n, sums, products = moments[k]
            own = (products / n - np.outer(sums / n, sums / n)) / np.outer(self.scale, self.scale)
            shrink = max(SHRINK, d / (n + d))
            factor = np.linalg.cholesky((1 - shrink) * own + shrink * pooled + RIDGE * eye)
            self.means.append((sums / n - center) / self.scale)
            self.factors.append(np.linalg.inv(factor))
            self.logdets.append(2 * float(np.log(np.diag(factor)).sum()))
            self.priors.append(math.log(n / total))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if len(self.classes) < 2:
            return np.full(len(rows), float(self.classes == [1]))
        x = (rows - self.center) / self.scale
        logs = [-0.5 * ((((x - m) @ f.T) ** 2).sum(1) + d) for m, f, d in zip(self.means, self.factors, self.logdets, strict=True)]
        z = TEMPERATURE * (logs[1] - logs[0]) + self.priors[1] - self.priors[0]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(measured: DataFrame) -> QuadraticDiscriminant:
    """From rows of the statistics and a column ``label``."""
    names = [f"__q_{f}" for f in FEATURES]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    rows = measured.filter("label IN (0, 1)").groupBy(F.col("label").cast("int").alias("label"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(names)], *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    moments = {}
    for row in found:
        products = np.zeros((len(names), len(names)))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        moments[row.label] = float(row.n), np.array([row[f"s{i}"] for i in range(len(names))]), products
    return QuadraticDiscriminant(moments)


def score(measured: DataFrame, model: QuadraticDiscriminant) -> DataFrame:
    """The columns besides the statistics, and __score, in place of a column of that name."""
    shared = measured.sparkSession.sparkContext.broadcast(model)
    new = [f"__q_{f}" for f in FEATURES]
    names = [c for c in measured.columns if c not in (*new, "__score")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[len(names) :]])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(shared.value.scores(rows))], [*names, "__score"])

    schema = measured.limit(0).select(*map(named, names), F.lit(None).cast("double").alias("__score")).schema
    return measured.select(*map(named, names), *new).mapInArrow(apply, schema)
